"""The test tables as episodes, steps and annotations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepweave.operators.keys import composite_key, normalized_path, ordinal
from stepweave.session import ship
from stepweave.sources.annotations import entries_of_bodies, flat_episodes, flat_steps


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def event_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Events as steps of their user; a purchase is annotated with what it was of."""
    bought = F.when(F.col("event_type") == "purchase", F.get_json_object("props", "$.k"))
    return table(spark, sf, "events").select(
        "user_id", ordinal(["user_id"], [F.col("ts")], "step_index"), "event_id", "event_type", "value", bought.alias("task")
    )


def demo_episodes(spark: SparkSession, sf: str) -> DataFrame:
    """Each delivered episode once, with the key on which annotations meet it."""
    meta = F.col("episode_metadata")
    raw = table(spark, sf, "episodes").groupBy("episode_key").agg(
        F.min(F.struct(meta["file_path"].alias("file_path"), meta["episode_id"].alias("episode_id"), "split", "n_steps", "schema_version")).alias("e")
    ).select("episode_key", "e.*")
    number = F.when(F.col("episode_id") != -1, F.col("episode_id"))
    return raw.withColumn("path_key", normalized_path(F.col("file_path"))).withColumn("join_key", composite_key(F.col("file_path"), number))


def demo_steps(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Each delivered step once, with the named columns (NULL-safe smallest where copies differ)."""
    cols = {
        "action": F.col("action"), "state": F.col("observation.state"), "state_3d": F.col("ecot_features.state_3d"), "gripper_position": F.col("ecot_features.gripper_position"),
        "move_primitive": F.col("ecot_features.move_primitive"), "caption": F.col("ecot_features.caption"), "bboxes": F.col("ecot_features.bboxes"),
    }
    picked = [cols.get(c, F.col(c)).alias(c) for c in columns]
    return table(spark, sf, "steps").groupBy("episode_key", "step_index").agg(F.min(F.struct(*picked)).alias("s")).select("episode_key", "step_index", "s.*")


def annotation_episodes(spark: SparkSession, sf: str) -> DataFrame:
    """Episodes of the nested bodies, each body once."""
    bodies = table(spark, sf, "embodied_features_bridge").groupBy("raw_id").agg(F.min(F.struct("file_path", "body")).alias("b")).select("raw_id", "b.*")
    return flat_episodes(entries_of_bodies(bodies))


def annotation_steps(spark: SparkSession, sf: str) -> DataFrame:
    return flat_steps(annotation_episodes(spark, sf))
