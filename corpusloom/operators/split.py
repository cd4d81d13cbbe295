"""Train and eval splits by key, hash buckets and hash picks, and the guards against leaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.hashing import hash_int

RANK_BUCKETS = 4096


class HoldoutViolation(RuntimeError):
    """A held-out family or template reached training data, or a family is partly held out."""


def hash_holdout(family: Column, per_mille: int = 100) -> Column:
    """Deterministic holdout by family: the salted hash's bucket of 1,000 lies under ``per_mille``."""
    return hash_int(F.concat(F.lit("holdout:"), family), 8) % 1000 < per_mille


def hash_pick(prefix: str, key: Column, n: int) -> Column:
    """Index 0..n-1 of a variant by hash of the key."""
    return hash_int(F.concat(F.lit(prefix), key), 8) % n


def instance_key(sibling_group: Column, template: Column, detail: Column) -> Column:
    """The sibling group, else 12 hex digits of the hash of template and detail."""
    own = F.substring(F.sha2(F.concat(F.lit('{"detail":'), F.coalesce(detail, F.lit("null")), F.lit(',"template":'), F.coalesce(F.concat(F.lit('"'), template, F.lit('"')), F.lit("null")), F.lit("}")), 256), 1, 12)
    return F.when(F.coalesce(sibling_group, F.lit("")) != "", sibling_group).otherwise(own)


def exact_sample(keys: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Exactly ``int(n * fraction)`` of the distinct keys: those with the smallest seeded hashes.

    No global sort: hashes fall into 4,096 buckets; whole buckets under the cut are taken, and only the bucket that holds the cut is ranked.
    """
    k = keys.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256))
    k = k.withColumn("_b", F.conv(F.substring("_h", 1, 3), 16, 10).cast("int"))
    sizes = k.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    total = sizes.agg(F.floor(F.sum("_n") * F.lit(fraction)).alias("_k"))
    plan = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).join(F.broadcast(total)).where("_before < _k")
    rows = k.join(F.broadcast(plan), "_b")
    whole = rows.where("_before + _n <= _k").select(key)
    edge = rows.where("_before + _n > _k").withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy("_h", key))).where("_before + _r <= _k").select(key)
    return whole.unionByName(edge)


def split_train_eval(records: DataFrame, key: str, holdout: str, fraction: float, seed: int) -> DataFrame:
    """Adds ``is_eval``: held-out records, and those whose key is in the exact sample of the keys that are not held out."""
    picked = exact_sample(records.where(~F.coalesce(F.col(holdout), F.lit(False))), key, fraction, seed).withColumn("_p", F.lit(True))
    joined = records.join(picked, key, "left")
    return joined.withColumn("is_eval", F.coalesce(F.col(holdout), F.lit(False)) | F.coalesce("_p", F.lit(False))).drop("_p")


def mixed_families(records: DataFrame, family: str, holdout: str) -> DataFrame:
    """Families of which some records are held out and some are not."""
    flag = F.coalesce(F.col(holdout), F.lit(False))
    return records.groupBy(family).agg(F.count_if(flag).alias("n_holdout"), F.count_if(~flag).alias("n_train")).where("n_holdout > 0 and n_train > 0")


def leaked(records: DataFrame, holdout: str, is_eval: str = "is_eval") -> DataFrame:
    """Held-out records that reached the training side."""
    return records.where(F.col(holdout) & ~F.col(is_eval))


def guard(records: DataFrame, family: str, holdout: str, is_eval: str = "is_eval") -> None:
    """Raises before anything is written if a family is mixed or a held-out record is in train."""
    bad = mixed_families(records, family, holdout).limit(5).collect()
    if bad:
        raise HoldoutViolation(f"mixed families: {[r[family] for r in bad]}")
    if not leaked(records, holdout, is_eval).isEmpty():
        raise HoldoutViolation("held-out records in train")
