"""Checkpoints, size-checked broadcasts and explode."""

from pyspark.sql import functions as F

from corpusloom import session
from corpusloom.functions.text import explode_once


def test_cut_keeps_rows_and_drops_lineage(spark):
    df = session.cut(spark.range(100).withColumn("x", F.col("id") * 2))
    assert df.count() == 100 and "Scan ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()


def test_small_side_is_checked(spark):
    small, big = spark.range(10), spark.range(10_000_000)
    assert "broadcast" in session.small_side(small)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in session.small_side(big, 1 << 20)._jdf.queryExecution().logical().toString().lower()


def test_explode_once(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id int, xs array<string>")
    assert [(r["id"], r["p"], r["x"]) for r in explode_once(df, F.col("xs"), "x", "p").collect()] == [(1, 0, "a"), (1, 1, "b")]
