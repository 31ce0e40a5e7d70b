"""Set algebra over episode keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_set(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).alias("key")).where("key is not null").distinct()


def overlap_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: left_keys, right_keys, both, only_left, only_right, either, share_only_left in per cent (one decimal)."""
    sides = key_set(left, key).withColumn("l", F.lit(1)).join(key_set(right, key).withColumn("r", F.lit(1)), "key", "full")
    both = F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull())
    out = sides.agg(F.count("l").alias("left_keys"), F.count("r").alias("right_keys"), both.alias("both"), F.count("*").alias("either"))
    only = F.col("left_keys") - F.col("both")
    share = F.coalesce(F.round(only * 100.0 / F.nullif(F.col("left_keys"), F.lit(0)), 1), F.lit(0.0))
    return out.select("left_keys", "right_keys", "both", only.alias("only_left"), (F.col("right_keys") - F.col("both")).alias("only_right"), "either", share.alias("share_only_left"))


def union_keys(*frames: DataFrame, key: str) -> DataFrame:
    out = key_set(frames[0], key)
    for f in frames[1:]:
        out = out.union(key_set(f, key))
    return out.distinct()


def common_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return key_set(left, key).intersect(key_set(right, key))


def other_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of the left side alone."""
    return key_set(left, key).subtract(key_set(right, key))


def not_done(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key an earlier run has not finished."""
    return df.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
