"""The one instruction of each episode, as the text operators take it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_content(text: Column) -> Column:
    """Whether a text holds a letter or a digit; NULL texts do not."""
    return F.coalesce(text.rlike(r"[\p{L}\p{N}]"), F.lit(False))


def first_instruction(steps: DataFrame) -> DataFrame:
    """(episode_key, text): the instruction on the first step that has a non-blank one.

    Repeated steps give one row; of different texts on the same first step the
    alphabetically first counts. Steps without key or index, and texts without
    a letter or digit, take no part. One pre-aggregated shuffle.
    """
    return (
        steps.where(has_content(F.col("language_instruction")) & F.col("episode_key").isNotNull() & F.col("step_index").isNotNull())
        .groupBy("episode_key")
        .agg(F.min(F.struct("step_index", F.col("language_instruction").alias("text"))).alias("at"))
        .select("episode_key", F.col("at.text").alias("text"))
    )
