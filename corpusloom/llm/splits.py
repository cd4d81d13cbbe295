"""Splits that keep related records together (problem 3).

Components: the keys of a record tie it to all others with the same key. Every key has an anchor, its smallest record number, and
only records with several keys tie anchors together, so the graph whose components are sought is that of the anchors:
alternating large-star and small-star rounds on distinct edges, each cut by a reliable checkpoint, until nothing changes.

Balance: largest differencing. Groups are ordered by weight in each of many buckets (by hash, so that no task holds all groups); a
bucket's groups become tuples of one weight for each bin, and the tuples with the largest spread are combined again and again,
heaviest with lightest. The buckets' tuples, one number for each bucket and bin whatever the number of groups, are then combined in the same way, a fixed
number of buckets at a time, up to one tuple for all. The number of buckets is a parameter, so nothing changes with the size of the data.
Whole bins go to the splits by target proportion.
"""

from __future__ import annotations

import heapq
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.session import cut

#: Values that stand in for a missing key, in key form.
STAND_INS = frozenset("n-a na none null nil unknown tbd tba todo missing undefined anonymous anon various various-authors multiple-authors et-al author untitled unnamed no-author no-name not-available unbekannt inconnu desconocido anonym anonyme anonimo".split())
#: Bins, buckets of groups (a thousand million groups make four million for each bucket, some 200 MB), and buckets that are combined at a time.
BINS, BUCKETS, FAN_IN = 240, 256, 16


def _known(key: Column) -> Column:
    return F.when((key != "") & ~key.isin(*sorted(STAND_INS)), key)


def family_key(value: Column) -> Column:
    """Key of a family; null for null, blank and stand-in values."""
    return _known(T.key_slug(value))


def work_key(value: Column) -> Column:
    """Key of a work; a prefix alone names nothing, so a key of one part without digits is null."""
    key = family_key(value)
    return F.when(key.rlike("-") | key.rlike("[0-9]"), key)


def author_keys(value: Column) -> Column:
    """Keys of the authors named in a field, separated by semicolons; surname-first names are turned."""
    return F.array_distinct(F.filter(F.transform(F.split(value, ";"), lambda a: _known(T.key_slug(T.author_flip(a)))), lambda k: k.isNotNull()))


def record_keys(tasks: DataFrame, seeds: DataFrame, books: DataFrame) -> DataFrame:
    """``rec_no, key`` with one row for each key of each record; records without a key come with a null key, rows without a number not at all.

    A work named by a seed's family is the same key as the book's; a family that is a bare work prefix is none.
    """
    prefixes = books.select(F.regexp_extract(T.key_slug(F.col("work_id")), "^([a-z]+)-?$", 1).alias("prefix")).where("prefix <> ''").distinct()
    families = tasks.select("rec_no", family_key(F.col("family")).alias("key")).unionByName(seeds.select("rec_no", family_key(F.col("family")).alias("key")))
    bare = families.where("key rlike '^[a-z]+$'").select("key").distinct().join(prefixes, F.col("key") == F.col("prefix"), "left_semi").withColumn("bare", F.lit(True))
    families = families.join(bare, "key", "left").select("rec_no", F.when(F.col("bare").isNull(), F.col("key")).alias("key"))
    named = F.array_compact(F.concat(F.array(F.concat(F.lit("w:"), work_key(F.col("work_id")))), F.transform(F.coalesce(author_keys(F.col("author")), F.array().cast("array<string>")), lambda a: F.concat(F.lit("a:"), a))))
    of_books = books.select("rec_no", F.explode_outer(named).alias("key"))
    return families.select("rec_no", F.concat(F.lit("w:"), F.col("key")).alias("key")).unionByName(of_books).where("rec_no is not null")


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (``a, b`` bigint); the root is the component's smallest node.

    Large-star and small-star in turn: both only group edges by a node and take minima, which combine map-side. No
    component is gathered; the number of rounds is logarithmic in its diameter.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = cut(e)
    seen = None
    if e.isEmpty():
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        e = cut(small.where("a <> b").distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def record_groups(keys: DataFrame) -> DataFrame:
    """``rec_no, group_no`` of every record: the smallest record number tied to it by keys, also by way of others."""
    k = cut(keys.distinct())
    anchors = k.where("key is not null").groupBy("key").agg(F.min("rec_no").alias("anchor"))
    anchored = cut(k.where("key is not null").join(anchors, "key").select("rec_no", "anchor").distinct())
    first = anchored.groupBy("rec_no").agg(F.min("anchor").alias("first"), F.count(F.lit(1)).alias("n"))
    ties = anchored.join(first.where("n > 1"), "rec_no").select(F.col("anchor").alias("a"), F.col("first").alias("b"))
    roots = connected(ties)
    placed = first.join(roots, F.col("first") == F.col("node"), "left").select("rec_no", F.coalesce("root", "first").alias("group_no"))
    alone = k.select("rec_no").distinct().join(placed.select("rec_no"), "rec_no", "left_anti").select("rec_no", F.col("rec_no").alias("group_no"))
    return placed.unionByName(alone)


def difference(weights: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each weight, and the sums of the bins: k-way largest differencing on tuples of ``bins`` weights."""
    order = np.argsort(-weights, kind="stable")
    padded = np.full(-(-max(len(weights), 1) // bins) * bins, -1, np.int64)
    padded[: len(weights)] = order
    heap = []
    members: dict[int, np.ndarray] = {}
    for t, slots in enumerate(padded.reshape(-1, bins)):
        w = np.where(slots >= 0, weights[slots], 0) if len(weights) else np.zeros(bins, np.int64)
        heap.append((-(int(w.max()) - int(w.min())), t))
        members[t] = (w, [(slots, np.arange(bins))])
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        (wa, ma), (wb, mb) = members.pop(a), members.pop(b)
        heavy, light = np.argsort(-wa, kind="stable"), np.argsort(wb, kind="stable")
        to = np.empty(bins, np.int64)
        to[light] = heavy  # slot of b -> slot of a
        w = wa.copy()
        w[heavy] += wb[light]
        members[a] = (w, ma + [(s, to[at]) for s, at in mb])
        heapq.heappush(heap, (-(int(w.max()) - int(w.min())), a))
    w, parts = members[heap[0][1]]
    out = np.zeros(len(weights), np.int64)
    for slots, at in parts:
        ok = slots >= 0
        out[slots[ok]] = at[ok]
    return out, w


def _bins(pieces: DataFrame, bins: int) -> DataFrame:
    """``piece, bucket, bin, weight`` of weighted pieces (``piece, weight, bucket``): each bucket balanced by one task."""

    def balance(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["weight", "piece"], ascending=[False, True])
        at, _ = difference(pdf["weight"].to_numpy(np.int64), bins)
        return pd.DataFrame({"piece": pdf["piece"], "bucket": pdf["bucket"], "bin": at.astype(np.int32), "weight": pdf["weight"]})

    return cut(pieces.groupBy("bucket").applyInPandas(balance, "piece bigint, bucket int, bin int, weight bigint"))


def balanced_bins(groups: DataFrame, bins: int = BINS, buckets: int = BUCKETS, fan_in: int = FAN_IN) -> tuple[DataFrame, list[DataFrame], np.ndarray]:
    """Groups (``group_no, weight``) in bins, level by level.

    First ``piece`` (the group), ``bucket`` and ``bin``; then for each level above the same of its pieces, which are the bins of the buckets below
    (number ``bucket * bins + bin``); last the sums of the final bins, the only numbers that reach the driver. The levels above have
    at most ``buckets * bins`` rows, whatever the number of groups.
    """
    at = _bins(groups.select(F.col("group_no").alias("piece"), "weight", F.pmod(F.xxhash64("group_no"), F.lit(buckets)).cast("int").alias("bucket")), bins)
    first, above = at, []
    while buckets > 1:
        buckets = -(-buckets // fan_in)
        sums = at.groupBy("bucket", "bin").agg(F.sum("weight").alias("weight"))
        piece = F.col("bucket").cast("bigint") * bins + F.col("bin")
        at = _bins(sums.select(piece.alias("piece"), "weight", F.expr(f"bucket div {fan_in}").cast("int").alias("bucket")), bins)
        above.append(at)
    sums = np.zeros(bins, np.int64)
    for r in at.groupBy("bin").agg(F.sum("weight").alias("w")).toLocalIterator():
        sums[r["bin"]] = r["w"]
    return first, above, sums


def assign_splits(records: DataFrame, shares: dict[str, float], bins: int = BINS, buckets: int = BUCKETS, fan_in: int = FAN_IN) -> DataFrame:
    """``rec_no, group_no, split`` of records (``rec_no, group_no``): whole groups, in the given shares of the rows."""
    groups = records.groupBy("group_no").agg(F.count(F.lit(1)).alias("weight"))
    first, above, weight = balanced_bins(groups, bins, buckets, fan_in)
    left = {s: p * weight.sum() for s, p in shares.items()}
    rows = []
    for b in np.argsort(-weight, kind="stable"):
        s = max(left, key=lambda x: left[x])
        rows.append((int(b), s))
        left[s] -= weight[b]
    number = (F.col("bucket").cast("bigint") * bins + F.col("bin")).alias("number")
    where = records.sparkSession.createDataFrame(rows, "number bigint, split string")
    for level in reversed(above):
        where = level.select("piece", number).join(F.broadcast(where), "number").select(F.col("piece").alias("number"), "split")
    of_group = first.select(F.col("piece").alias("group_no"), number).join(F.broadcast(where), "number").select("group_no", "split")
    return records.join(of_group, "group_no").select("rec_no", "group_no", "split")
