"""Exact and near duplicates.

Keep-first semantics: a row is a duplicate if an earlier row has the same exact key, or if an earlier row that is no exact duplicate shares an
LSH band with it and their signatures agree in at least ``threshold`` of their positions. Signatures are computed for one
representative of each exact key only, so a group of copies, however large, takes part in no pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import normalise
from corpusloom.session import cut

PERMS, SHINGLE_WORDS, BANDS = 128, 5, 16
PRIME = (1 << 31) - 1


def permutations(perms: int = PERMS, seed: int = 711) -> tuple[list[int], list[int]]:
    """Coefficients of a 31-bit hash family, so that ``a * h + b`` fits a bigint in Spark and in SQL oracles."""
    rng = np.random.default_rng(seed)
    return rng.integers(1, PRIME, perms).tolist(), rng.integers(0, PRIME, perms).tolist()


def conversational_text(messages: Column) -> Column:
    """Thought and content of user and assistant messages, normalised."""
    said = F.filter(messages, lambda m: m["role"].isin("user", "assistant"))
    return normalise(F.array_join(F.transform(said, lambda m: F.concat(F.coalesce(m["thought"], F.lit("")), F.lit(" "), F.coalesce(m["content"], F.lit("")))), " "))


def exact_key(text: Column) -> Column:
    """SHA-256 of a normalised text."""
    return F.sha2(text, 256)


def signatures(rows: DataFrame, key: str, text: str, perms: int = PERMS, words: int = SHINGLE_WORDS) -> DataFrame:
    """``key, sig``: MinHash of the distinct word shingles of a normalised text; null under ``words`` words (exact duplicates only).

    Each distinct shingle of a batch is hashed once; the minima of all texts come from one segmented reduction.
    """
    a, b = (np.array(x, np.int64) for x in permutations(perms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                part = whole.slice(at, 512)
                lists = [w if len(w) >= words else [] for w in ((t or "").split(" ") for t in part.column("text").to_pylist())]
                seen: dict[str, int] = {}
                per = [list({seen.setdefault(" ".join(ws[i : i + words]), len(seen)) for i in range(len(ws) - words + 1)}) if ws else [] for ws in lists]
                h = np.fromiter((int(hashlib.md5(s.encode("utf-8", "surrogatepass")).hexdigest()[:8], 16) % PRIME for s in seen), np.int64, len(seen))
                has = [i for i, p in enumerate(per) if p]
                sig: list[list[int] | None] = [None] * len(per)
                if has:
                    flat = h[np.concatenate([np.array(per[i], np.int64) for i in has])]
                    starts = np.cumsum([0, *(len(per[i]) for i in has[:-1])])
                    out = np.empty((len(has), perms), np.int64)
                    for k in range(perms):
                        out[:, k] = np.minimum.reduceat((a[k] * flat + b[k]) % PRIME, starts)
                    for i, row in zip(has, out):
                        sig[i] = row.tolist()
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(sig, pa.list_(pa.int64()))], names=["key", "sig"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, sig array<bigint>").withColumnRenamed("key", key)


def agreement(x: Column, y: Column, perms: int = PERMS) -> Column:
    """Share of equal signature positions."""
    return F.aggregate(F.zip_with(x, y, lambda p, q: (p == q).cast("int")), F.lit(0), lambda acc, e: acc + e) / F.lit(float(perms))


#: A bucket of more signatures than this is split before its members are paired.
HOT_BUCKET = 64


def _bucket_pairs(banded: DataFrame, perms: int, rows: int, threshold: float, hot: int) -> DataFrame:
    """``a, b`` (a < b) of the representatives that share a bucket and may agree in ``threshold``: of small buckets all pairs, of hot ones those that share part of the rest too.

    Two signatures that agree in the threshold differ in at most ``d`` of the positions outside the band. Cut into more than ``d`` groups, these have one on
    which both agree, so pairing within (bucket, group, its values) loses none, however many signatures a common passage puts into a bucket.
    """
    differ = int((1 - threshold) * perms)
    width = max(1, (perms - rows) // (differ + 1))
    groups = -(-(perms - rows) // width)
    n = banded.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    met = banded.join(n, ["band", "bucket"])
    rest = F.concat(F.slice("sig", F.lit(1), F.col("band") * rows), F.slice("sig", F.col("band") * rows + rows + 1, F.lit(perms)))
    parts = F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda g: F.xxhash64(g, F.slice(rest, g * width + 1, width)))
    keyed = met.where(F.col("_n") <= hot).select("band", "bucket", F.lit(0).cast("bigint").alias("part"), "rep").unionByName(met.where(F.col("_n") > hot).select("band", "bucket", F.explode(parts).alias("part"), "rep"))
    on = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("band", "bucket", "part")]
    pairs = keyed.alias("l").join(keyed.alias("r"), [*on, F.col("l.rep") < F.col("r.rep")])
    return pairs.select(F.col("l.rep").alias("a"), F.col("r.rep").alias("b")).distinct()


def near_pairs(signed: DataFrame, pos: str, threshold: float, bands: int = BANDS, perms: int = PERMS, hot: int = HOT_BUCKET) -> DataFrame:
    """``pos, earlier``: for each signature the smallest earlier position that shares a band and agrees in ``threshold``.

    Equal signatures are one class with its first member as representative: only representatives meet in buckets,
    the other members point to it. Buckets are equi-joined, hot ones in parts (``_bucket_pairs``); the pairs are reduced map-side.
    """
    rows = perms // bands
    s = signed.where("sig is not null").withColumn("cls", F.xxhash64("sig"))
    first = s.groupBy("cls", "sig").agg(F.min(pos).alias("rep"))
    values = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(F.slice(F.col("sig"), i * rows + 1, rows)))
    banded = first.select("rep", "sig", F.posexplode(values).alias("band", "bucket"))
    pairs = _bucket_pairs(banded, perms, rows, threshold, hot)
    sigs = first.select("rep", "sig")
    checked = pairs.join(sigs.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), "a").join(sigs.select(F.col("rep").alias("b"), F.col("sig").alias("sb")), "b").where(agreement(F.col("sa"), F.col("sb"), perms) >= threshold)
    best = checked.groupBy("b").agg(F.min("a").alias("a"))
    members = s.join(first, ["cls", "sig"]).select(F.col(pos), "rep")
    # a later member of a class has its representative before it, which agrees wholly
    return members.join(best, members["rep"] == best["b"], "left").select(F.col(pos), F.least(F.when(F.col(pos) != F.col("rep"), F.col("rep")), F.col("a")).alias("earlier")).where("earlier is not null")


def _keyed(rows: DataFrame, key: str, pos: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their exact key, and the first row of each key."""
    r = rows.select(F.col(key).alias("key"), F.col(pos).alias("pos"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("x", exact_key(F.col("text")))
    return r, r.groupBy("x").agg(F.min("pos").alias("pos"), F.min_by("key", "pos").alias("key"))


def exact_duplicates(rows: DataFrame, key: str, pos: str, text: str) -> DataFrame:
    """``key, duplicate_of`` of each row whose ``text`` an earlier row (by ``pos``, unique) has already; null counts as empty. No signature is computed."""
    r, firsts = _keyed(rows, key, pos, text)
    found = r.select("key", "pos", "x").join(firsts.select("x", F.col("pos").alias("p0"), F.col("key").alias("k0")), "x").where("pos > p0")
    return found.select("key", F.col("k0").alias("duplicate_of")).withColumnRenamed("key", key)


def duplicates(rows: DataFrame, key: str, pos: str, text: str, threshold: float = 0.8) -> DataFrame:
    """``key, duplicate_of, kind`` of each row that duplicates an earlier one (by ``pos``, unique): ``exact`` or ``near``.

    ``text`` must be normalised; null counts as empty, and empty texts are exact duplicates of each other. One row for each duplicate,
    whatever the size of its group. A near duplicate names the earliest row that it resembles.
    """
    r, reps = _keyed(rows, key, pos, text)
    signed = cut(signatures(r.join(reps.select("pos"), "pos", "left_semi"), "pos", "text"))
    near = near_pairs(signed, "pos", threshold)
    names = reps.select("pos", "key")
    n = near.join(names, "pos").join(names.select(F.col("pos").alias("earlier"), F.col("key").alias("duplicate_of")), "earlier").select("key", "duplicate_of", F.lit("near").alias("kind"))
    return exact_duplicates(rows, key, pos, text).withColumnRenamed(key, "key").withColumn("kind", F.lit("exact")).unionByName(n).withColumnRenamed("key", key)


def corpus_union(prior: DataFrame, new: DataFrame, pos: str) -> DataFrame:
    """Prior rows before new ones, so that among duplicates the new ones lose; adds ``origin`` and shifts nothing but the order ``(origin, pos)``."""
    both = prior.withColumn("origin", F.lit(0)).unionByName(new.withColumn("origin", F.lit(1)), allowMissingColumns=True)
    return both.withColumn("order_key", F.struct("origin", pos))


def without(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Rows whose key is no duplicate."""
    return rows.join(found.select(key), key, "left_anti")
