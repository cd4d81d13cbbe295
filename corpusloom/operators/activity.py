"""Sessions of activity by occupancy bitmaps and morphological closing.

Plan: events -> one cell per (entity, occupied tick) with count, first and last exact time
(map-side combined, so an entity with a third of all rows costs at most its occupied ticks) ->
one bitmap per (entity, block of ticks) -> closing by doubling shifts inside the block -> runs ->
counts joined and endpoints trimmed to the exact times -> only the first and last run of a block,
which may go on in its neighbour, are stitched over the block borders.

A tick is 1/240 of the gap. Occupied ticks less than 240 apart are closer than the gap and those more
than 240 apart are farther; where they are exactly 240 apart the exact times of the two cells decide,
so the result is exact at microseconds although the bitmap is not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TICKS_PER_GAP = 240
TICKS_PER_BLOCK = 1440

_RUNS = "entity string, start_us bigint, end_us bigint, n_events bigint, edge boolean"


def close_by_doubling(bits: np.ndarray, reach: int) -> np.ndarray:
    """Dilate each row to the right by ``reach`` ticks with O(log reach) shifts; occupied ticks up to ``reach`` + 1 apart join."""
    out, done = bits.copy(), 0
    while done < reach:
        step = min(done + 1, reach - done)
        out[:, step:] |= out[:, :-step].copy()
        done += step
    return out


def block_runs(entity, tick, n, first, last, row_len, gap_us: int, per_gap: int, per_block: int):
    """Runs of many blocks at once. Flat cell arrays, ``row_len`` cells for each block; ticks are relative to the block."""
    rows = np.repeat(np.arange(len(row_len)), row_len)
    bits = np.zeros((len(row_len), per_block + per_gap), dtype=bool)
    bits[rows, tick] = True
    closed = close_by_doubling(bits, per_gap - 1)
    starts = closed.copy()
    starts[:, 1:] &= ~closed[:, :-1]
    label = np.cumsum(starts, axis=1, dtype=np.int32)[rows, tick]
    same = np.zeros(len(rows), dtype=bool)
    same[1:] = (rows[1:] == rows[:-1]) & (label[1:] == label[:-1])
    exact = np.zeros(len(rows), dtype=bool)
    exact[1:] = (tick[1:] - tick[:-1] == per_gap) & (first[1:] - last[:-1] > gap_us)
    begin = np.flatnonzero(~same | exact)
    end = np.append(begin[1:], len(rows)) - 1
    first_of_row = np.append(True, rows[begin][1:] != rows[begin][:-1])
    last_of_row = np.append(rows[begin][1:] != rows[begin][:-1], True)
    edge = (first_of_row & (tick[begin] <= per_gap)) | (last_of_row & (tick[end] + per_gap >= per_block))
    return rows[begin], first[begin], last[end], np.add.reduceat(n, begin), edge


def activity_sessions(events: DataFrame, entity: str, time_us: str, gap_us: int, ticks_per_gap: int = TICKS_PER_GAP, ticks_per_block: int = TICKS_PER_BLOCK) -> DataFrame:
    """Sessions ``entity, start_us, end_us, n_events`` separated by more than ``gap_us`` without an event.

    A gap of exactly ``gap_us`` does not split. Rows with a null entity or time are left out; an
    empty input gives no sessions; tied times count as separate events; other columns are ignored.
    ``gap_us`` must be a multiple of ``ticks_per_gap`` and a block at least as long as the gap.
    """
    if gap_us <= 0 or gap_us % ticks_per_gap or ticks_per_block <= ticks_per_gap:
        raise ValueError("gap_us must be a positive multiple of ticks_per_gap, and a block longer than the gap")
    tick_us = gap_us // ticks_per_gap
    e = events.select(F.col(entity).cast("string").alias("entity"), F.col(time_us).cast("bigint").alias("t")).where("entity is not null and t is not null")
    cells = e.groupBy("entity", F.expr(f"(t - pmod(t, {tick_us}L)) div {tick_us}L").alias("tick")).agg(
        F.count(F.lit(1)).alias("n"), F.min("t").alias("first"), F.max("t").alias("last")
    )
    cells = cells.withColumn("rel", F.expr(f"cast(pmod(tick, {ticks_per_block}L) as int)")).withColumn("block", F.expr(f"(tick - pmod(tick, {ticks_per_block}L)) div {ticks_per_block}L"))
    # at most ticks_per_block cells in an array
    blocks = cells.groupBy("entity", "block").agg(F.sort_array(F.collect_list(F.struct("rel", "n", "first", "last"))).alias("cells"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                b = whole.slice(at, 4096)
                lists = b.column("cells")
                flat = lists.flatten()
                col = lambda k: flat.field(k).to_numpy(zero_copy_only=False)  # noqa: B023, E731
                row, s, t, n, edge = block_runs(
                    None, col("rel").astype(np.int64), col("n"), col("first"), col("last"), lists.value_lengths().to_numpy(zero_copy_only=False), gap_us, ticks_per_gap, ticks_per_block
                )
                yield pa.RecordBatch.from_arrays([b.column("entity").take(pa.array(row)), pa.array(s), pa.array(t), pa.array(n), pa.array(edge)], names=["entity", "start_us", "end_us", "n_events", "edge"])

    found = blocks.select("entity", "cells").mapInArrow(runs, _RUNS)
    by_time = Window.partitionBy("entity").orderBy("start_us")
    # edge runs: at most two of a block, so their number is bounded by the time span, not by the rows
    edges = found.where("edge").withColumn("new", F.coalesce((F.col("start_us") - F.lag("end_us").over(by_time) > gap_us).cast("int"), F.lit(1)))
    stitched = edges.withColumn("k", F.sum("new").over(by_time)).groupBy("entity", "k").agg(F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), F.sum("n_events").alias("n_events"))
    return found.where("not edge").select("entity", "start_us", "end_us", "n_events").unionByName(stitched.select("entity", "start_us", "end_us", "n_events"))
