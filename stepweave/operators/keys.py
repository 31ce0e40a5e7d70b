"""Keys on which annotations and demonstrations meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepweave.functions.text import or_default


def normalized_path(path: Column) -> Column:
    """Forward slashes, none at the start."""
    return F.regexp_replace(F.translate(path, "\\", "/"), "^/+", "")


def composite_key(path: Column, number: Column) -> Column:
    """``path_number``; NULL where either is unknown, which then never matches."""
    return F.concat(normalized_path(path), F.lit("_"), number.cast("string"))


def path_key(source_file: Column, episode_id: Column) -> Column:
    """The normalized source file, else the episode id."""
    return normalized_path(or_default(source_file, episode_id))


def default_episode_id(source_file: Column, index: Column) -> Column:
    """The source file, else a numbered name."""
    return F.coalesce(F.nullif(source_file, F.lit("")), F.format_string("bridge_ep_%06d", index))


def last_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the last in ``order`` (which should leave no ties).

    Rows are reduced to one per key and task before the shuffle; a hot key is
    no burden. NULL keys form a group of their own.
    """
    packed = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], F.struct(*df.columns).alias("_row"))
    return df.groupBy(*keys).agg(F.max(packed).alias("_best")).select("_best._row.*")


def ordinal(partition: list[str], order: list[Column], name: str = "ordinal") -> Column:
    """0-based place within a partition."""
    return (F.row_number().over(Window.partitionBy(*partition).orderBy(*order)) - 1).alias(name)
