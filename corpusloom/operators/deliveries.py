"""Repeated deliveries of chat messages and skew-safe ranking inside groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions.timestamps import instant_us


def keyed_messages(chat: DataFrame) -> DataFrame:
    """``row_id, source, conversation_id, sender_key, ts_us, text`` and a content fingerprint of each message.

    The fingerprint is two independent 64-bit hashes and the length, so that grouping on equal texts
    never shuffles the texts. A null text has null length and equals only null texts.
    """
    return chat.select(
        "row_id",
        "source",
        "conversation_id",
        T.sender_key(F.col("sender")).alias("sender_key"),
        instant_us(F.col("ts")).alias("ts_us"),
        "text",
        F.xxhash64("text").alias("_h1"),
        F.xxhash64(F.lit(7), F.col("text")).alias("_h2"),
        F.length("text").alias("_len"),
    )


def drop_repeated(keyed: DataFrame) -> DataFrame:
    """Keep the smallest ``row_id`` of rows equal in conversation, sender, instant and text.

    Rows without sender or readable time are never repeated. The grouping key is fine-grained, so a conversation or sender that
    holds a third of the rows spreads over all tasks; the aggregate combines map-side and carries no text. Only keys that
    occur more than once, a few percent, are joined back.
    """
    key = ["conversation_id", "sender_key", "ts_us", "_h1", "_h2", "_size"]
    rows = keyed.withColumn("_size", F.coalesce("_len", F.lit(-1)))
    repeated = rows.where("sender_key is not null and ts_us is not null").groupBy(*key).agg(F.min("row_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return rows.join(repeated, key, "left").where("_first is null or row_id = _first").select("row_id", "source", "conversation_id", "sender_key", "ts_us", "text")


def rank_in_group(df: DataFrame, keys: list[str], block: Column, order: list[str], out: str) -> DataFrame:
    """1-based rank inside each group without gathering a group in one task.

    ``block`` is a coarse prefix of the order (for times: the hour). Rows are ranked inside
    (group, block); the number of rows in earlier blocks is added from the block counts, one row per block.
    """
    rows = df.withColumn("_block", block)
    local = rows.withColumn("_local", F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(*order)))
    counts = rows.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return local.join(offsets, [*keys, "_block"]).withColumn(out, (F.col("_local") + F.col("_before")).cast("bigint")).drop("_block", "_local", "_before")
