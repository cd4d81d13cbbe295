"""JSON-lines scans with explicit ordinals, and atomic sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators.order import numbered
from corpusloom.schema import RECORD_DDL
from corpusloom.session import cut


def read_typed(spark: SparkSession, path: str | list[str], ddl: str = RECORD_DDL) -> DataFrame:
    """Typed rows of JSON lines; blank lines are skipped, the first bad row fails the job."""
    return spark.read.schema(ddl).option("mode", "FAILFAST").json(path)


def read_lenient(spark: SparkSession, path: str | list[str], ddl: str) -> DataFrame:
    """Typed rows with corrupt lines kept apart in ``_corrupt_record``, so that they can be counted before they are dropped."""
    return spark.read.schema(f"{ddl}, _corrupt_record string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def good_rows(lenient: DataFrame) -> DataFrame:
    """The rows of a lenient scan that parsed."""
    return lenient.where("_corrupt_record is null").drop("_corrupt_record")


def read_raw(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, raw`` of every non-blank line, verbatim."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("raw")).where("trim(raw) <> ''")


def read_ordered(spark: SparkSession, path: str | list[str], ordinal: str | None = None) -> DataFrame:
    """``file, line_no, raw`` of the non-blank lines: the order on which order-sensitive operators rely.

    Files are read in splits by many tasks. A line's number is its place in its split plus the lines of earlier splits of its file,
    which come from a table of one row for each split. ``ordinal`` names a further column: a number that grows by file name, then line.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"), F.col("value").alias("raw"))
    splits = lines.groupBy("file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    own = F.col("_id") - F.col("_first")
    extra = []
    if ordinal is not None:
        splits = splits.withColumn("_all", F.coalesce(F.sum("_n").over(Window.orderBy("file", "_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        extra = [(own + F.col("_all")).alias(ordinal)]
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return lines.join(F.broadcast(splits), ["file", "_block"]).select("file", (own + F.col("_before")).alias("line_no"), *extra, "raw").where("trim(raw) <> ''")


def read_run(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file_rank, line_no, raw`` of the lines of a run's files, which count in the order of their names: the record order on which deduplication relies."""
    lines = read_ordered(spark, path)
    ranks = numbered(lines.select("file").distinct(), ["file"], "file_rank")
    return lines.join(ranks, "file").select("file_rank", "line_no", "raw")


def parsed(ordered: DataFrame, ddl: str, required: list[str] = ()) -> DataFrame:
    """Adds the fields of ``raw``; a line that misses a required field, or is no JSON, fails with its file and line."""
    # the mode is the default; with an option the optimizer does not read the line again for each field
    j = ordered.withColumn("j", F.from_json("raw", ddl, {"mode": "PERMISSIVE"}))
    lacks: Column = F.col("j").isNull()
    for name in required:
        lacks = lacks | F.col("j")[name].isNull()
    where = F.concat(F.col("file"), F.lit(":"), (F.col("line_no") + 1).cast("string"), F.lit(f": missing one of {', '.join(required) or 'the fields'}"))
    checked = F.when(lacks, F.raise_error(where).cast("boolean")).otherwise(F.lit(True))
    return j.where(checked).select(*ordered.columns, "j.*")


def write_jsonl(df: DataFrame, path: str) -> int:
    """Overwrites ``path`` through the output committer, which makes it visible as a whole; returns the number of rows."""
    from pyspark.sql import Observation

    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(path)
    return int(seen.get["n"])


def append_jsonl(df: DataFrame, path: str) -> None:
    """Appends rows."""
    df.write.mode("append").json(path)


class RunStore:
    """Paths of a run: ``raw/``, ``gated/{kept,rejected}``, ``rendered/*``."""

    def __init__(self, root: str, run_id: str):
        self.base = f"{root.rstrip('/')}/{run_id}"

    def raw(self, lane: str) -> str:
        return f"{self.base}/raw/lane_{lane}"

    def gated(self, side: str) -> str:
        return f"{self.base}/gated/{side}"

    def rendered(self, name: str) -> str:
        return f"{self.base}/rendered/{name}"

    def fresh(self, overwrite: bool = False) -> None:
        """Refuses a run that exists already, unless told otherwise."""
        if not overwrite and path_exists(SparkSession.active(), self.base):
            raise FileExistsError(self.base)


def cached_replies(spark: SparkSession, path: str, ddl: str = "request_key string, text string") -> DataFrame:
    """The response table; empty where none was written yet."""
    return spark.read.schema(ddl).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], ddl)


def put_replies(replies: DataFrame, path: str) -> None:
    """Appends replies to the response table; blank texts are never stored."""
    replies.where("trim(text) <> ''").write.mode("append").parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its own file system (local, HDFS, object store); any other failure is raised."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def stage(spark: SparkSession, path: str, wanted: DataFrame, key: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A stage table: rows of ``build`` for each ``key, fingerprint`` of ``wanted``, asked only where they were not built before.

    ``build`` gets the missing rows of ``wanted`` and gives rows with ``key``. A run writes its rows under its own number first and then a
    note of the keys that it has done, so a run that broke off leaves nothing that is read, and a key without rows is not asked again.
    """
    rows, notes = f"{path.rstrip('/')}/rows", f"{path.rstrip('/')}/done"
    wanted = cut(wanted)
    asked = wanted.select(key, "fingerprint").distinct()
    done = spark.read.parquet(notes) if path_exists(spark, notes) else None
    missing = wanted if done is None else wanted.join(done.select(key, "fingerprint"), [key, "fingerprint"], "left_anti")
    if not missing.isEmpty():
        run = F.lit(uuid.uuid4().hex)
        marks = missing.select(key, "fingerprint").distinct()
        build(missing).join(marks, key).withColumn("run", run).write.mode("append").parquet(rows)
        marks.withColumn("run", run).write.mode("append").parquet(notes)
    done = spark.read.parquet(notes).join(asked, [key, "fingerprint"]).dropDuplicates([key, "fingerprint"])
    return spark.read.parquet(rows).join(done, [key, "fingerprint", "run"], "left_semi").drop("fingerprint", "run")
