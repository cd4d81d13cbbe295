"""Named text files in a folder, written by the tasks through the folder's own file system."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import ensure_checkpoint_dir


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint folder of the session."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def write_named(files: DataFrame, root: str) -> int:
    """Writes ``path`` (below ``root``) and ``body`` (text or bytes) of each row as a file; returns their number. A file is whole or not there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")
        n = 0
        for b in batches:
            for path, body in zip(b.column("path").to_pylist(), b.column("body").to_pylist()):
                target = f"{base}/{path}"
                system.create_dir(target.rsplit("/", 1)[0], recursive=True)
                beside = f"{target}.{uuid.uuid4().hex}.tmp"
                with system.open_output_stream(beside) as out:
                    out.write(body)
                system.move(beside, target)
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    rows = files.select("path", F.col("body").cast("binary").alias("body")).mapInArrow(run, "n bigint")
    return rows.agg(F.sum("n")).first()[0] or 0


def json_lines(rows: DataFrame, group: str, order: list[str], line: Column) -> DataFrame:
    """``group, body``: the lines of each group in order, one after the other."""
    g = rows.groupBy(group).agg(F.sort_array(F.collect_list(F.struct(*order, line.alias("_line")))).alias("_lines"))
    return g.select(group, F.concat(F.array_join(F.transform("_lines", lambda x: x["_line"]), "\n"), F.lit("\n")).alias("body"))


def write_ordered(rows: DataFrame, order: list[str], line: Column, root: str) -> None:
    """The lines of one stream in ``order``, in compressed files whose names count on: a task sorts and writes one range of them, so no row or task holds them all."""
    rows.repartitionByRange(*order).sortWithinPartitions(*order, line).select(line.alias("value")).write.option("compression", "gzip").text(root)
