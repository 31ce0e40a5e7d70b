"""Which frames of an episode are taken."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepweave.functions.arrays import step_distance

KEYFRAME_THRESHOLD = 0.05


def uniform_frames(count: Column, n: int) -> Column:
    """``n`` evenly spaced indices of ``count`` frames, rounded half to even; all if there are no more."""
    spaced = F.transform(F.sequence(F.lit(0), F.lit(max(n, 2) - 1)), lambda i: F.bround(i * ((count - 1) / F.lit(max(n - 1, 1)))).cast("int"))
    return F.when(count <= 0, F.array().cast("array<int>")).when(count <= n, all_frames(count)).otherwise(F.array(F.lit(0)) if n == 1 else spaced)


def spaced_frames(count: Column, n: int) -> Column:
    """``n`` evenly spaced indices, cut to whole numbers, as viewers take them."""
    cut = F.transform(F.sequence(F.lit(0), F.lit(max(n, 2) - 1)), lambda i: F.floor(i * ((count - 1) / F.lit(max(n - 1, 1)))).cast("int"))
    return F.when(count <= 0, F.array().cast("array<int>")).otherwise(F.array(F.lit(0)) if n == 1 else cut)


def all_frames(count: Column) -> Column:
    return F.when(count > 0, F.sequence(F.lit(0), count.cast("int") - 1)).otherwise(F.array().cast("array<int>"))


def is_transition(action: Column, before: Column, threshold: float = KEYFRAME_THRESHOLD) -> Column:
    """Whether gripper or position change by more than ``threshold``; NaN and missing values never do."""
    grip = F.abs(F.get(action, 6) - F.get(before, 6)).cast("double")
    moved = step_distance(action, before)
    over = lambda c: F.coalesce((c > threshold) & ~F.isnan(c), F.lit(False))
    return over(grip) | over(moved)


def thinned(selected: Column, most: int) -> Column:
    """At most ``most`` of the indices: every place ``round(i * len / most)``, half to even."""
    n = F.size(selected)
    picked = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.get(selected, F.bround(i * (n / F.lit(most))).cast("int")))
    return F.when(n > most, F.array_compact(picked)).otherwise(selected)


def keyframes(steps: DataFrame, key: str, order: str, action: str = "action", threshold: float = KEYFRAME_THRESHOLD, most: int | None = None) -> DataFrame:
    """key, n_steps, frames: the first, the last, and those at which the action changes."""
    w = Window.partitionBy(key).orderBy(order)
    place = F.row_number().over(w) - 1
    hit = is_transition(F.col(action), F.lag(action).over(w), threshold)
    chosen = steps.select(key, place.alias("pos"), hit.alias("hit"), F.lead(F.lit(1)).over(w).isNull().alias("end"))
    taken = F.array_sort(F.collect_list(F.when(F.col("hit") | F.col("end") | (F.col("pos") == 0), F.col("pos"))))
    out = chosen.groupBy(key).agg(F.count("*").alias("n_steps"), taken.alias("frames"))
    return out if most is None else out.withColumn("frames", thinned(F.col("frames"), most))


def select_frames(steps: DataFrame, key: str, order: str, strategy: str = "uniform", n: int = 8, threshold: float = KEYFRAME_THRESHOLD) -> DataFrame:
    """key, n_steps, frames by strategy: uniform, keyframe or all."""
    if strategy == "keyframe":
        return keyframes(steps, key, order, threshold=threshold, most=n)
    counts = steps.groupBy(key).agg(F.count("*").alias("n_steps"))
    if strategy == "uniform":
        return counts.withColumn("frames", uniform_frames(F.col("n_steps"), n))
    if strategy == "all":
        return counts.withColumn("frames", all_frames(F.col("n_steps")))
    raise ValueError(f"frame sampling strategy {strategy!r}; one of uniform, keyframe, all")


def nth_row(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The row at 0-based place ``n`` of a total order; none beyond the end. Sorts ranges in parallel and skips, gathering one row."""
    return df.orderBy(*order).offset(n).limit(1)
