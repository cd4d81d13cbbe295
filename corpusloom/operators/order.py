"""Operators whose result depends on an explicit order: sessions with a cap, strides, caps, keep-first, islands."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import ngrams, words
from corpusloom.session import cut


def numbered(df: DataFrame, order: list[Column | str], out: str = "pos") -> DataFrame:
    """0-based dense position over the whole table in ``order`` (unique), without moving all rows to one task.

    Rows are range-partitioned and sorted; the number of rows before each partition comes from one count for each partition. The
    partitioned rows are cut by a reliable checkpoint, since another run of the range sampling could draw other borders.
    """
    return _placed(df, order, out).drop("_p")


def _placed(df: DataFrame, order: list[Column | str], out: str, keep: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """``numbered`` with the range partition ``_p`` of each row; ``keep`` cuts the partitioned rows."""
    own = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    parts = keep(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", own))
    counts = parts.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return parts.join(F.broadcast(offsets), "_p").withColumn(out, F.col("_i") + F.col("_off")).drop("_i", "_off")


def sessionize(df: DataFrame, keys: list[str], time_us: str, order: list[str], gap_us: int, most: int, keep: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """Adds ``segment`` (0-based in the group): a gap longer than ``gap_us`` or ``most`` messages start a new one. Input order counts, not time.

    The table is placed in order of keys and ``order`` once, so a group with a third of all rows spreads over many range partitions. Each
    partition looks at the last row of the one before (one row each); gaps are counted through all partitions, which names the sessions;
    a row's place in its session gives its segment. The gap to a null time splits.
    """
    rows = _placed(df, [*keys, *order], "_pos", keep)
    here = F.struct(*[F.col(k) for k in keys])
    seen = F.struct(here.alias("g"), F.col(time_us).alias("t"))
    w = Window.partitionBy("_p").orderBy("_pos")
    ends = rows.groupBy("_p").agg(F.max_by(seen, "_pos").alias("_last"))
    ends = ends.select("_p", F.lag("_last").over(Window.orderBy("_p")).alias("_last"))
    rows = rows.join(F.broadcast(ends), "_p").withColumn("_prev", F.coalesce(F.lag(seen).over(w), F.col("_last")))
    new = ~F.coalesce(F.col("_prev.g").eqNullSafe(here) & (F.col(time_us) - F.col("_prev.t") <= gap_us), F.lit(False))
    rows = rows.withColumn("_s", F.sum(new.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    gaps = rows.groupBy("_p").agg(F.max("_s").alias("_g"))
    before = gaps.select("_p", F.coalesce(F.sum("_g").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    rows = rows.join(F.broadcast(before), "_p").withColumn("_s", F.col("_s") + F.col("_b"))
    sessions = rows.groupBy(*keys, "_s").agg(F.min("_pos").alias("_start"), F.ceil(F.count(F.lit(1)) / F.lit(most)).alias("_k"))
    earlier = F.coalesce(F.sum("_k").over(Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sessions = sessions.select(F.col("_s"), "_start", earlier.alias("_seg"))
    out = rows.join(sessions, "_s").withColumn("segment", (F.col("_seg") + F.floor((F.col("_pos") - F.col("_start")) / F.lit(most))).cast("bigint"))
    return out.select(*df.columns, "segment")


def segment_filter(df: DataFrame, keys: list[str], role: Column, text: str, min_messages: int = 2, min_chars: int = 0, min_mean: float = 0.0) -> DataFrame:
    """Segments with enough messages, both roles, enough characters in all and on average: one row each with their sums."""
    size = F.length(F.coalesce(F.col(text), F.lit("")))
    g = df.withColumn("_role", role).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_messages"), F.count_distinct("_role").alias("n_roles"), F.sum(size).alias("n_chars"), F.avg(size).alias("mean_chars"))
    return g.where((F.col("n_messages") >= min_messages) & (F.col("n_roles") >= 2) & (F.col("n_chars") >= min_chars) & (F.col("mean_chars") >= min_mean))


def stride(df: DataFrame, pos: str, n: Column, k: int) -> DataFrame:
    """``k`` rows evenly spread over positions 0..n-1: those at ``int(i * n / k)``; all rows if ``k`` <= 0 or ``k`` >= n.

    A row decides for itself: position p is taken if ceil(p * k / n) maps back to p, so nothing is joined or collected.
    """
    if k <= 0:
        return df
    step = n.cast("double") / F.lit(k)
    i = F.ceil(F.col(pos) / step)
    hit = lambda j: (j >= 0) & (j < k) & (F.floor(j * step) == F.col(pos))
    return df.where((n <= k) | hit(i) | hit(i - 1) | hit(i + 1))


def stride_all(df: DataFrame, order: list[str], k: int) -> DataFrame:
    """``stride`` over a whole table in ``order``; the row count is a one-row aggregate."""
    p = numbered(df, order)
    n = p.agg(F.count(F.lit(1)).alias("_n"))
    return stride(p.join(F.broadcast(n)), "pos", F.col("_n"), k).drop("_n")


def python_round(x: Column) -> Column:
    """Half-even rounding to an integer."""
    return F.bround(x, 0).cast("bigint")


def stratified_stride(df: DataFrame, order: list[str], held: Column, k: int) -> DataFrame:
    """``k`` rows with the held-out stratum in proportion (at least one, at most k - 1 of them), each stratum by stride, in input order."""
    p = numbered(df, order).withColumn("_held", held)
    total = p.agg(F.count(F.lit(1)).alias("_n"), F.count_if("_held").alias("_h"))
    p = p.join(F.broadcast(total))
    local = F.row_number().over(Window.partitionBy("_held", F.floor(F.col("pos") / 65536)).orderBy("pos"))
    blocks = p.groupBy("_held", F.floor(F.col("pos") / 65536).alias("_b")).agg(F.count(F.lit(1)).alias("_c"))
    before = blocks.select("_held", "_b", F.coalesce(F.sum("_c").over(Window.partitionBy("_held").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    p = p.withColumn("_local", local).withColumn("_b", F.floor(F.col("pos") / 65536)).join(before, ["_held", "_b"]).withColumn("_r", F.col("_local") + F.col("_before") - 1)
    want = F.when(F.col("_h") == 0, 0).otherwise(F.least(F.greatest(F.lit(1), python_round(F.lit(k) * F.col("_h") / F.col("_n"))), F.lit(max(k - 1, 1)), F.col("_h")))
    size = F.when(F.col("_held"), F.col("_h")).otherwise(F.col("_n") - F.col("_h"))
    take = F.when(F.col("_held"), want).otherwise(F.lit(k) - want)
    step = size.cast("double") / take
    i = F.ceil(F.col("_r") / step)
    hit = lambda j: (j >= 0) & (j < take) & (F.floor(j * step) == F.col("_r"))
    picked = p.where((take > 0) & ((size <= take) | hit(i) | hit(i - 1) | hit(i + 1))) if k > 0 else p
    return picked.drop("_held", "_n", "_h", "_local", "_b", "_before", "_r")


def dominance_cap(counts: DataFrame, share: float) -> DataFrame:
    """``n`` of each thread clamped to a share of the total, again and again until nothing changes; adds ``cap``.

    The fixed point is found on the sorted counts alone: with the t largest threads clamped to L, L = max(1, floor(share * (rest + t * L))).
    The counts are cut once; a round is one aggregate over them, of one row.
    """
    counts = cut(counts)
    capped = counts.withColumn("cap", F.col("n"))
    limit = None
    while True:
        total, most = (x or 0 for x in capped.agg(F.sum("cap"), F.max("cap")).first())
        now = max(1, int(total * share))
        if most <= now or now == limit:
            return capped
        limit = now
        capped = counts.withColumn("cap", F.least(F.col("n"), F.lit(limit)))


def group_cap(df: DataFrame, group: str, order: list[str], cap: int, limit: int | None = None) -> DataFrame:
    """The first ``cap`` rows of each group in order, then the first ``limit`` rows of all."""
    kept = df.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_r") <= cap).drop("_r")
    return kept if limit is None else first_rows(kept, order, limit)


def first_rows(df: DataFrame, order: list[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows in ``order`` (unique), by their position: no task gathers them, however large ``n`` is."""
    return numbered(df, order, "_first").where(F.col("_first") < n).drop("_first")


def keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key: a map-side combined minimum, no window over a hot key."""
    cols = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(F.col(key).alias("_k")).agg(F.min_by(cols, order).alias("r")).select("r.*")


def gram_overlap(a: Column, b: Column, n: int = 4) -> Column:
    """Overlap coefficient of the distinct word n-grams of two texts; 0 if one has fewer than ``n`` words."""
    x, y = words(F.coalesce(a, F.lit(""))), words(F.coalesce(b, F.lit("")))
    gx, gy = ngrams(x, n), ngrams(y, n)
    return F.when((F.size(x) < n) | (F.size(y) < n), F.lit(0.0)).otherwise(F.size(F.array_intersect(gx, gy)) / F.least(F.size(gx), F.size(gy)))


def degenerate_loop(messages: Column, n: int = 4, limit: float = 0.6) -> Column:
    """Whether the last two assistant turns of a record repeat each other."""
    said = F.transform(F.filter(messages, lambda m: m["role"] == "assistant"), lambda m: F.coalesce(m["content"], F.lit("")))
    return (F.size(said) >= 2) & (gram_overlap(F.try_element_at(said, F.lit(-1)), F.try_element_at(said, F.lit(-2)), n) >= limit)
