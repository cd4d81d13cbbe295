"""Session helpers: reliable lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side larger than this (optimizer estimate, bytes) is never broadcast by us.
BROADCAST_LIMIT_BYTES = 8 << 20


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by ``spark.checkpoint.dir``; only a session without one (tests) gets a local folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="corpusloom-ckpt-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    sc.setCheckpointDir(named)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder and drop its lineage. Survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``cut`` in columns: a Parquet folder in the checkpoint folder, a fraction of the disk where sorted rows repeat their keys. No column may be void."""
    ensure_checkpoint_dir(df.sparkSession)
    folder = f"{df.sparkSession.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def small_side(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast ``df`` only if the optimizer's own size estimate is within ``limit``; else leave it to a shuffle join."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(str(size)) <= limit else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet test tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
