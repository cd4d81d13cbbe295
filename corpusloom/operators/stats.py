"""Counters, rates, scores and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import cut, small_side

#: Stems of words of inner life, counted per thousand words.
MENTAL_WORDS = (
    r"\b(?:thought|thinks?|thinking|felt|feels?|feeling|wondered|wonder|realiz|realis|remember|knew|believ|imagin|hoped?|feared?|wished?|doubt|suspect|consider|"
    r"sensed?|ached?|longed|dreaded|resent|worry|worried|understood|recogniz|decided|ponder|mused|regret|ashamed|guilt|yearn|grief|angry|anxious)\w*"
)


def gate_counts(records: DataFrame) -> DataFrame:
    """``lane, total, verified, judged, kept, dropped`` by lane, and over all lanes with null lane."""
    g = F.col("gate_state")
    flags = records.select(
        F.col("provenance.lane").alias("lane"),
        F.coalesce(g["verified"], F.lit(False)).alias("v"),
        F.coalesce(g["judge"]["passed"], F.lit(False)).alias("j"),
        F.coalesce(g["dropped"], F.lit(False)).alias("d"),
    )
    return flags.rollup("lane").agg(F.count(F.lit(1)).alias("total"), F.count_if("v").alias("verified"), F.count_if(F.col("v") & F.col("j")).alias("judged"), F.count_if(~F.col("d")).alias("kept"), F.count_if("d").alias("dropped"))


def keep_rates(counts: DataFrame) -> DataFrame:
    """``verify_rate`` and ``judge_rate`` of counters; 0 where there is nothing to divide by."""
    return counts.select("lane", F.coalesce(F.try_divide("verified", "total"), F.lit(0.0)).alias("verify_rate"), F.coalesce(F.try_divide("judged", "verified"), F.lit(0.0)).alias("judge_rate"))


def drop_reasons(records: DataFrame) -> DataFrame:
    """Dropped records by lane and reason."""
    return records.where("gate_state.dropped").groupBy(F.col("provenance.lane").alias("lane"), F.coalesce("gate_state.drop_reason", F.lit("error")).alias("drop_reason")).agg(F.count(F.lit(1)).alias("n"))


def template_stats(records: DataFrame, order: str) -> DataFrame:
    """Rollouts, verified and kept of each template (else ``lane_<l>:<family>``); the last row of a record id counts."""
    key = F.coalesce("provenance.template_id", F.concat(F.lit("lane_"), F.col("provenance.lane"), F.lit(":"), F.col("provenance.family")))
    row = F.struct(key.alias("template"), F.coalesce("gate_state.verified", F.lit(False)).alias("verified"), F.coalesce("gate_state.dropped", F.lit(False)).alias("dropped"))
    last = records.groupBy(F.col("provenance.record_id").alias("id")).agg(F.max_by(row, order).alias("r")).select("r.*")
    return last.groupBy("template").agg(F.count(F.lit(1)).alias("rollouts"), F.count_if("verified").alias("verified"), F.count_if(~F.col("dropped")).alias("kept"))


def band_violations(stats: DataFrame, bands: DataFrame) -> DataFrame:
    """Templates whose pass rate lies outside their band (``template, low, high``)."""
    return stats.join(bands, "template").withColumn("pass_rate", F.try_divide("verified", "rollouts")).where("pass_rate is null or not pass_rate between low and high")


def weighted_judge(scores: DataFrame, rubric: DataFrame, threshold: float) -> DataFrame:
    """``id, overall, passed, n_missing`` of axis scores (``id, axis, score``) under a rubric (``axis, weight, minimum``).

    Scores are clamped to 1..5, unknown axes ignored. Passing needs the unrounded mean at the threshold and every axis at its minimum; a missing axis fails.
    ``overall`` is rounded to three places.
    """
    ids = scores.select("id").distinct()
    grid = scores.join(small_side(rubric), "axis").withColumn("s", F.greatest(F.lit(1.0), F.least(F.lit(5.0), F.col("score"))))
    n_axes = rubric.count()
    g = grid.groupBy("id").agg((F.sum(F.col("s") * F.col("weight")) / F.sum("weight")).alias("mean"), F.bool_and(F.coalesce(F.col("s") >= F.col("minimum"), F.lit(True))).alias("floors"), F.count(F.lit(1)).alias("n"))
    g = ids.join(g, "id", "left")
    missing = F.lit(n_axes) - F.coalesce("n", F.lit(0))
    return g.select("id", F.round("mean", 3).alias("overall"), F.coalesce((missing == 0) & F.col("floors") & (F.col("mean") >= threshold), F.lit(False)).alias("passed"), missing.cast("bigint").alias("n_missing"))


def percentiles_nearest(values: DataFrame, value: str, points: tuple[int, ...] = (10, 25, 50, 75, 90)) -> DataFrame:
    """``p, value`` with the value at rank ``min(n - 1, p * n div 100)``.

    Values are counted first; the running count goes over distinct values in sorted blocks, so nothing is collected into an array.
    """
    counts = values.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    ranked = cut(counts.repartitionByRange("v").withColumn("_p", F.spark_partition_id()))
    inside = Window.partitionBy("_p").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = ranked.withColumn("_run", F.sum("c").over(inside))
    parts = ranked.groupBy("_p").agg(F.max("_run").alias("_n"))
    before = parts.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    spans = ranked.join(F.broadcast(before), "_p").withColumn("hi", F.col("_run") + F.col("_before")).withColumn("lo", F.col("hi") - F.col("c"))
    at = spans.select("*", F.explode(F.array(*[F.lit(p) for p in points])).alias("p")).withColumn("r", F.least(F.col("_all") - 1, F.floor(F.col("p") * F.col("_all") / 100)))
    return at.where("r >= lo and r < hi").select("p", F.col("v").alias("value"))


def interiority(text: Column, words: str = MENTAL_WORDS, least: int = 500, chars: int | None = None) -> Column:
    """Hits of the word list per thousand words of a text; 0 under 500 words. ``chars`` limits it to a window at the start."""
    head = text if chars is None else F.substring(text, 1, chars)
    n = F.regexp_count(head, F.lit("[A-Za-z']+"))
    return F.when(F.coalesce(n, F.lit(0)) < least, F.lit(0.0)).otherwise(F.regexp_count(head, F.lit(f"(?iU){words}")) * 1000.0 / n)


def usage_totals(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Tokens and cost by teacher and lane; a teacher without a price costs nothing."""
    u = usage.join(small_side(prices), "teacher", "left")
    cost = (F.col("tokens_in") * F.coalesce("price_in", F.lit(0.0)) + F.col("tokens_out") * F.coalesce("price_out", F.lit(0.0))) / 1e6
    return u.groupBy("teacher", "lane").agg(F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), F.sum(cost).alias("cost"))


def spend_totals(totals: DataFrame, digits: int = 4) -> DataFrame:
    """``teacher, tokens_in, tokens_out, cost`` over all lanes, the cost rounded half to even."""
    return totals.groupBy("teacher").agg(F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), F.bround(F.sum("cost"), digits).alias("cost"))


def mix_report(corpora: DataFrame, corpus: str, text: str) -> DataFrame:
    """Records, approximate tokens (characters / 4) and token share of each corpus."""
    g = corpora.groupBy(corpus).agg(F.count(F.lit(1)).alias("records"), (F.sum(F.length(F.coalesce(F.col(text), F.lit("")))) / 4).alias("tokens"))
    total = g.agg(F.sum("tokens").alias("_all"))
    return g.join(F.broadcast(total)).withColumn("share", F.try_divide("tokens", "_all")).drop("_all")


def most_common_member(threads: DataFrame, thread: str, member: str) -> DataFrame:
    """The member of most threads; fails if the first place is tied."""
    n = threads.select(thread, member).where(F.col(member).isNotNull()).distinct().groupBy(member).agg(F.count(F.lit(1)).alias("n_threads"))
    top = n.agg(F.max("n_threads").alias("n_threads"))
    first = n.join(F.broadcast(top), "n_threads")
    one = first.agg(F.count(F.lit(1)).alias("_c"), F.min(member).alias(member), F.min("n_threads").alias("n_threads"))
    return one.select(F.when(F.col("_c") > 1, F.raise_error(F.lit("first place is tied")).cast("string")).otherwise(F.col(member).cast("string")).alias(member), "n_threads")


def longest_of_groups(rows: DataFrame, group: str, text: str, order: str, at_least: int = 5, keep: int = 4, cut: int = 600) -> DataFrame:
    """Groups with at least so many rows, with their longest texts cut short; most rows first, ties by first appearance."""
    r = rows.where(F.col(text).isNotNull())
    sized = r.select(group, order, F.length(text).alias("_l"), F.substring(text, 1, cut).alias("_t"))
    top = sized.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("_l"), order))).where(F.col("_r") <= keep)
    texts = top.groupBy(group).agg(F.transform(F.sort_array(F.collect_list(F.struct("_r", "_t"))), lambda x: x["_t"]).alias("texts"))
    n = r.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_seen")).where(F.col("n") >= at_least)
    return n.join(texts, group)


def prefix_counts(keys: DataFrame, key: str, part: int = 1) -> DataFrame:
    """Rows by a dash-separated part of a key."""
    return keys.groupBy(F.get(F.split(F.col(key), "-"), part).alias("part")).agg(F.count(F.lit(1)).alias("n"))


def shares_of(counts: DataFrame, n: str, total: Column) -> DataFrame:
    """Adds each count's share of a total."""
    return counts.withColumn("share", F.try_divide(F.col(n), total))


def stats_lines(stats: DataFrame) -> DataFrame:
    """``template, line``: fixed-width report lines of template statistics."""
    rate = F.coalesce(F.try_divide("verified", "rollouts"), F.lit(0.0))
    return stats.select("template", F.format_string("%-40s %8d %8d %8d %6.2f", "template", "rollouts", "verified", "kept", rate).alias("line"))
