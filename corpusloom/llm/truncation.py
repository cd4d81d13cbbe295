"""Texts cut off by field limits or mid-transfer (problem 10).

Limits: for each source the lengths of its distinct texts without terminal punctuation are counted, in characters and in bytes. A length
that holds far more of them than its neighbourhood leads one to expect is a limit, and the texts at it are cut; a source may have several.
The test is a likelihood ratio against the neighbourhood, so it means the same in small and large sources. Texts that the source
ended with a mark of omission were cut back to a word first, so for them the window below a limit is tested.

Endings: a transfer may stop anywhere, which no length shows, and changed copies of cut texts lie at no limit either. Beside the limits, an
unterminated text is cut if its last words hardly ever end a line or sentence where they stand elsewhere in the corpus (rates of ``endings``) and its last line is
not that of enough other texts. ``at_limit`` keeps the two apart. Exact copies of a cut text are cut too.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.endings import END, END_SHARE, LINE, LINE_SHARE, OTHER_LINES, end_key, ending, enough, evidence, line_key, sketch, vote_counts
from corpusloom.session import cut

#: Lengths on either side with which a length is compared, and the log likelihood ratio (beside the log of the number of lengths tested) that makes it a spike.
AROUND, SPIKE_EVIDENCE = 64, 9.0
#: Texts with a mark of omission end up to so many characters below a limit; the wider neighbourhood is so many times that.
MARK_WINDOW, WIDE = 24, 20


def _features(docs: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """One pass over the texts: a row for each text, with the keys of its last words if they are to be judged."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            ends = [ending(t) if t and t.strip() else ("whole", False, "") for t in texts]
            is_open = [e[0] == "open" for e in ends]
            nothing = (None, None)
            keys = [(end_key(e[2]) or nothing) if o else nothing for e, o in zip(ends, is_open)]
            lines = [(line_key(e[2]) or nothing) if o else nothing for e, o in zip(ends, is_open)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("key"),
                    b.column("source"),
                    b.column("h"),
                    pa.array([len(t) if t else 0 for t in texts], pa.int32()),
                    pa.array([len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts], pa.int32()),
                    pa.array([e[0] for e in ends], pa.string()),
                    pa.array([e[1] for e in ends], pa.bool_()),
                    pa.array([k[0] for k in keys], pa.int64()),
                    pa.array([k[1] for k in keys], pa.int32()),
                    pa.array([k[0] for k in lines], pa.int64()),
                    pa.array([k[1] for k in lines], pa.int32()),
                    pa.array([sketch(e[2]) if k[0] is not None else None for e, k in zip(ends, lines)], pa.list_(pa.int64())),
                ],
                names=["key", "source", "h", "chars", "bytes", "kind", "marked", "end_key", "end_slot", "line_key", "line_slot", "sketch"],
            )

    cols = docs.select(F.col(key).alias("key"), F.coalesce(F.col(source), F.lit("")).alias("source"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    return cols.mapInArrow(run, f"key {kind}, source string, h bigint, chars int, bytes int, kind string, marked boolean, end_key bigint, end_slot int, line_key bigint, line_slot int, sketch array<bigint>")


def length_limits(rows: DataFrame) -> DataFrame:
    """``source, measure, marked, size, n``: lengths at a limit, with the number of distinct unterminated texts there.

    Without a mark a limit is one length; with a mark, every length up to ``MARK_WINDOW`` below a length that ends a dense window.
    A histogram has one row for each length that occurs, so a source with a third of all rows stays small.
    """
    size = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("size")) for m in ("chars", "bytes")])).alias("l")
    lengths = rows.where("chars > 0 and kind <> 'whole'").select("source", "marked", "h", size)
    counts = lengths.groupBy("source", "marked", "l.measure", "l.size", "h").agg(F.lit(1).alias("one")).groupBy("source", "marked", "measure", "size").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("source", "marked", "measure")
    w = group.orderBy("size")
    within = lambda a, b: F.coalesce(F.sum("n").over(w.rangeBetween(a, b)), F.lit(0))
    tested = F.log(F.count(F.lit(1)).over(group).cast("double"))

    def spike(n, around, lengths: int, beside: int):
        """Log likelihood ratio of ``n`` texts in ``lengths`` lengths against the rate of the ``beside`` lengths around, one text added."""
        rate = (around - n + 1) * F.lit(lengths / beside)
        return F.when(n > rate, n * F.log(n / rate) - n + rate).otherwise(0.0)

    below = within(-MARK_WINDOW, 0)
    plain = spike(F.col("n"), within(-AROUND, AROUND), 1, 2 * AROUND) >= SPIKE_EVIDENCE + tested
    dense = spike(below, within(-WIDE * MARK_WINDOW, WIDE * MARK_WINDOW), MARK_WINDOW, 2 * WIDE * MARK_WINDOW) >= SPIKE_EVIDENCE + tested
    ends = within(1, MARK_WINDOW) * 10 <= below
    found = counts.select("*", F.when(F.col("marked"), dense & ends).otherwise(plain).alias("limit"))
    near = F.when(F.col("marked"), F.max("limit").over(w.rangeBetween(0, MARK_WINDOW))).otherwise(F.col("limit"))
    return found.select("source", "measure", "marked", "size", "n", near.alias("near")).where("near").drop("near")


def truncated_texts(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``key, source, cut, at_limit`` of every row.

    Null, empty and blank texts are not cut; a null source counts as a source of its own (empty name). Repeated rows are judged alike.
    An empty table gives no rows; other columns are ignored.
    """
    rows = cut(_features(docs, key, source, text))
    limits = cut(length_limits(rows))
    at = [limits.where(F.col("measure") == m).select("source", "marked", F.col("size").alias(m), F.lit(True).alias(f"at_{m}")) for m in ("chars", "bytes")]
    placed = rows.where("kind <> 'whole'").join(at[0], ["source", "marked", "chars"], "left").join(at[1], ["source", "marked", "bytes"], "left")
    placed = cut(placed.withColumn("at_limit", F.coalesce("at_chars", "at_bytes", F.lit(False))).drop("at_chars", "at_bytes"))
    asked = placed.where("kind = 'open' and not at_limit")
    votes = cut(vote_counts(asked.where("line_key is not null"), "line_key", OTHER_LINES))
    repeated = rows.where("chars > 0").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    shared = asked.join(votes.select("line_key"), "line_key", "left_semi")
    keys = asked.select(F.col("end_key").alias("key"), F.col("end_slot").alias("slot")).unionByName(shared.select(F.col("line_key").alias("key"), F.col("line_slot").alias("slot")))
    rates = cut(evidence(docs.select(F.col(text).alias("text")), keys, (END, LINE), repeated))
    ends = rates.select(F.col("key").alias("end_key"), "n_ends", F.col("n_goes_on").alias("end_on"))
    lines = votes.join(rates.select(F.col("key").alias("line_key"), F.col("n_goes_on").alias("line_on")), "line_key", "left")
    judged = placed.join(ends, "end_key", "left").join(lines, "line_key", "left")
    known = enough(F.col("n_ends"), F.col("end_on"), 0, END_SHARE) | enough(F.col("votes"), F.col("line_on"), OTHER_LINES, LINE_SHARE)
    is_cut = F.col("at_limit") | (F.col("kind") == "inside") | ~known
    hits = judged.where(is_cut).groupBy("h").agg(F.max("at_limit").alias("at_limit"))
    out = rows.join(hits.withColumn("cut", F.lit(True)), "h", "left")
    return out.select(F.col("key").alias(key), "source", F.coalesce("cut", F.lit(False)).alias("cut"), F.coalesce("at_limit", F.lit(False)).alias("at_limit"))
