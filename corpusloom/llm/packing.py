"""Filling containers of fixed capacity with whole items (problem 9).

Bulk-synchronous best fit, decreasing. The items are range-sorted by size, so that an item's rank in its size class follows from its place in its
partition and one count for each partition and class. Items of one size are interchangeable, and sizes are integers up
to the capacity, so the successor sweeps over items and gaps work on classes: at most ``capacity`` classes of items and as many
of gaps, whatever the number of items. Classes of items go from large to small; each class is matched to the
smallest gaps that hold it (successor search), takes as many of them as it has items, conflicts are resolved by rank, the gaps shrink, and what is
left over is matched again, or opens containers. Every match puts an interval of ranks into an interval of containers.

The sweeps themselves run on the driver: a class table of at most ``capacity`` rows is no work to distribute. A class leaves at most two more
intervals of gaps than it found, so there are at most ``2 * capacity`` intervals at any time, and a class matches an interval at most
(its gap / the size) times, so the plan is bounded by the capacity alone, never by the number of items. The items are looked up in the plan
where they lie, without any further shuffle.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import cut


def best_fit_plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Matches ``(size, first rank, number, first container, offset in the container)`` and the number of containers."""
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # intervals of containers (first, number) by gap
    open_gaps: list[int] = []  # sorted gaps that have containers
    plan, containers = [], 0

    def put(gap: int, first: int, n: int) -> None:
        if not gaps[gap]:
            bisect.insort(open_gaps, gap)
        heapq.heappush(gaps[gap], (first, n))

    for size in sorted((s for s in counts if s > 0), reverse=True):
        left, rank = counts[size], 0
        while left:
            k = bisect.bisect_left(open_gaps, size)
            if k == len(open_gaps):
                n = -(-left // (capacity // size))
                put(capacity, containers, n)
                containers += n
                continue
            gap = open_gaps[k]
            first, n = heapq.heappop(gaps[gap])
            used = min(n, left)
            if used < n:
                heapq.heappush(gaps[gap], (first + used, n - used))
            if not gaps[gap]:
                open_gaps.remove(gap)
            plan.append((size, rank, used, first, capacity - gap))
            if gap > size:
                put(gap - size, first, used)
            rank, left = rank + used, left - used
    return plan, containers


def fill_containers(sizes: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """``key, piece_no, item_start, piece_size, container_no, container_start`` of every piece of every item.

    An item larger than the capacity is split into full containers and one rest, which is packed like an item; no other
    is split. Items without size (null, 0 or less) need no room: they come out as one piece of size 0 with null container.
    ``key`` should be unique; repeated keys are packed as separate items, in any order among themselves.
    An empty table gives no rows.
    """
    kind = sizes.schema[key].dataType.simpleString()
    base = sizes.select(F.col(key).alias("key"), F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("bigint").alias("n"))
    items = base.select("key", "n", (F.col("n") % capacity).cast("int").alias("rest"), F.expr(f"n div {capacity}").alias("full"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the partition, the place in it, and the full containers before."""
        part, at, fulls = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            own = b.column("full").to_numpy(zero_copy_only=False)
            before = fulls + np.cumsum(own) - own
            m = b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(m, part, np.int32)), pa.array(np.arange(at, at + m)), pa.array(before)], names=[*b.schema.names, "part", "i", "f"])
            at, fulls = at + m, fulls + int(own.sum())

    # the size pass and the range sort are cut, since another run of the range sampling could draw other borders
    items = cut(items)
    spread = items.where("n > 0").repartitionByRange("rest", "key").sortWithinPartitions("rest", "key")
    placed = cut(spread.mapInArrow(number, f"key {kind}, n bigint, rest int, full bigint, part int, i bigint, f bigint"))
    # partitions hold ranges of sizes, so there is at most one row more than classes and partitions together
    tally = placed.groupBy("part", "rest").agg(F.count(F.lit(1)).alias("m"), F.min("i").alias("first"), F.sum("full").alias("fulls")).toPandas().sort_values(["part", "rest"])
    counts = tally.groupby("rest")["m"].sum()
    plan, packed = best_fit_plan({int(s): int(c) for s, c in counts.items()}, capacity)
    tally["offset"] = tally.groupby("rest")["m"].cumsum() - tally["m"] - tally["first"]
    fulls = tally.groupby("part")["fulls"].sum()
    p = np.array(sorted(plan), np.int64).reshape(-1, 5)
    book = sizes.sparkSession.sparkContext.broadcast(
        {
            "at": p[:, 0] << 40 | p[:, 1], "rank": p[:, 1], "container": p[:, 3], "start": p[:, 4],
            "class": tally["part"].to_numpy(np.int64) << 32 | tally["rest"].to_numpy(np.int64), "offset": tally["offset"].to_numpy(np.int64),
            "part": fulls.index.to_numpy(np.int64), "full_at": (packed + fulls.cumsum() - fulls).to_numpy(np.int64),
        }
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = book.value
        for batch in batches:
            n, rest, full, part, i, f = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "rest", "full", "part", "i", "f"))
            part, rest = part.astype(np.int64), rest.astype(np.int64)
            rank = i + b["offset"][np.searchsorted(b["class"], part << 32 | rest)]
            pieces = full + (rest > 0)
            row = np.repeat(np.arange(len(n)), pieces)
            no = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            is_tail = no == full[row]
            if len(b["at"]):
                at = np.searchsorted(b["at"], rest[row] << 40 | rank[row], "right") - 1
                own = b["container"][at] + rank[row] - b["rank"][at]
                start = np.where(is_tail, b["start"][at], 0)
            else:
                own, start = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
            whole = b["full_at"][np.searchsorted(b["part"], part[row])] + f[row] + no
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(row)), *(pa.array(c.astype(np.int64)) for c in (no, no * capacity, np.where(is_tail, rest[row], capacity), np.where(is_tail, own, whole), start))],
                names=["key", "piece_no", "item_start", "piece_size", "container_no", "container_start"],
            )

    out = placed.mapInArrow(place, f"key {kind}, piece_no bigint, item_start bigint, piece_size bigint, container_no bigint, container_start bigint")
    zero, nothing = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    empty = items.where("n = 0").select("key", zero.alias("piece_no"), zero.alias("item_start"), zero.alias("piece_size"), nothing.alias("container_no"), nothing.alias("container_start"))
    return out.unionByName(empty).withColumnRenamed("key", key)
