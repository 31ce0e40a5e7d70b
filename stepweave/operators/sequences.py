"""Aggregates and windows over step sequences: coverage, phases, paths, matrices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepweave.functions.text import filled
from stepweave.schemas import COMPLETE_FIELDS, TRACE_FIELDS


def is_complete(trace: Column, fields: tuple[str, ...] = COMPLETE_FIELDS) -> Column:
    """Whether all of the fields hold something."""
    out = F.lit(True)
    for f in fields:
        out &= filled(trace[f])
    return out


def is_empty(trace: Column, fields: tuple[str, ...] = TRACE_FIELDS) -> Column:
    out = F.lit(True)
    for f in fields:
        out &= ~filled(trace[f])
    return out


def filled_fields(trace: Column, fields: tuple[str, ...] = TRACE_FIELDS) -> Column:
    """Names of the fields that hold something, in their order."""
    return F.array_compact(F.array(*[F.when(filled(trace[f]), F.lit(f)) for f in fields]))


def active_modalities(present: dict[str, Column], extra: Column | None = None) -> Column:
    """Names of the modalities that are there, then the keys of ``extra``."""
    names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in present.items()]))
    return names if extra is None else F.concat(names, F.coalesce(F.map_keys(extra), F.array().cast("array<string>")))


def reasoning_text(subtask: Column, move: Column, gripper: Column) -> Column:
    """Labelled lines of what is filled, NULL for nothing."""
    line = lambda label, c: F.when(filled(c), F.concat(F.lit(label), c))
    return F.nullif(F.concat_ws("\n", line("Subtask: ", subtask), line("Move: ", move), line("Gripper: ", gripper)), F.lit(""))


def gripper_label(value: Column) -> Column:
    """CLOSE above one half, else OPEN; NULL stays."""
    return F.when(value > 0.5, "CLOSE").when(value.isNotNull(), "OPEN")


def coverage(df: DataFrame, keys: list[str], trace: str) -> DataFrame:
    """Per key: steps, annotated, coverage (0 for none)."""
    return df.groupBy(*keys).agg(F.count("*").alias("steps"), F.count(trace).alias("annotated"), F.coalesce(F.count(trace) / F.count("*"), F.lit(0.0)).alias("coverage"))


def trace_quality(df: DataFrame, trace: str, fields: tuple[str, ...] = COMPLETE_FIELDS) -> DataFrame:
    """One row: total, annotated, coverage, complete, completeness_rate; rates of nothing are 0."""
    n, have, full = F.count("*"), F.count(trace), F.count_if(F.col(trace).isNotNull() & is_complete(F.col(trace), fields))
    share = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    return df.agg(n.alias("total"), have.alias("annotated"), share(have, n).alias("coverage"), full.alias("complete"), share(full, have).alias("completeness_rate"))


def transitions(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Rows at which ``value > 0.5`` flips; NULL counts as not above."""
    w = Window.partitionBy(key).orderBy(order)
    on = F.coalesce(F.col(value) > 0.5, F.lit(False))
    return df.withColumn("_on", on).withColumn("_was", F.lag("_on").over(w)).where("_was <> _on").select(key, order, F.col("_on").alias("closed"))


def phases(df: DataFrame, key: str, order: str, on: Column) -> DataFrame:
    """key, phase, on, start, end (exclusive place), n: contiguous stretches in which ``on`` does not change."""
    w = Window.partitionBy(key).orderBy(order)
    base = df.select(key, (F.row_number().over(w) - 1).alias("pos"), F.coalesce(on, F.lit(False)).alias("on"))
    flip = F.coalesce((F.lag("on").over(Window.partitionBy(key).orderBy("pos")) != F.col("on")).cast("int"), F.lit(0))
    marked = base.withColumn("_flip", flip).withColumn("phase", F.sum("_flip").over(Window.partitionBy(key).orderBy("pos")))
    return marked.groupBy(key, "phase", "on").agg(F.min("pos").alias("start"), (F.max("pos") + 1).alias("end"), F.count("*").alias("n"))


def cumulative_path(df: DataFrame, key: str, order: str, vector: str, dims: int = 3) -> DataFrame:
    """Running sums of the first entries of a vector, as columns p0, p1, ...; missing entries add nothing."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select(key, order, *[F.sum(F.coalesce(F.get(vector, k), F.lit(0.0)).cast("double")).over(w).alias(f"p{k}") for k in range(dims)])


def context(df: DataFrame, key: str, order: str, value: str, n: int = 3) -> DataFrame:
    """The values of the ``n`` rows before each row, oldest first."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(-n, -1)
    return df.select(key, order, F.collect_list(value).over(w).alias("context"))


def stacked(df: DataFrame, key: str, order: str, value: str, name: str) -> DataFrame:
    """Per key the values in order, as one array. A row per entity: meant for episodes, which are short."""
    return df.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]).alias(name))


def presence_matrix(df: DataFrame, key: str, trace: str, fields: tuple[str, ...]) -> DataFrame:
    """Per key how many steps have each field filled beyond white space."""
    there = lambda f: F.count_if(F.coalesce(F.trim(F.col(trace)[f]) != "", F.lit(False)))
    return df.groupBy(key).agg(*[there(f).alias(f"n_{f}") for f in fields])


def first_filled(df: DataFrame, key: str, order: str, value: str, name: str) -> DataFrame:
    """Per key the first value in order that is filled; keys without any have NULL."""
    good = filled(F.col(value))
    return df.groupBy(key).agg(F.min(F.when(good, F.struct(order, value))).alias("_m")).select(key, F.col(f"_m.{value}").alias(name))


def usage_totals(df: DataFrame, by: list[str], usage: str = "usage") -> DataFrame:
    """Token usage by group; a missing total is the sum of its parts."""
    part = lambda f: F.coalesce(F.col(f"{usage}.{f}"), F.lit(0))
    total = F.coalesce(F.col(f"{usage}.total_tokens"), part("prompt_tokens") + part("completion_tokens"))
    return df.groupBy(*by).agg(
        F.count("*").alias("results"), F.sum(part("prompt_tokens")).alias("prompt_tokens"), F.sum(part("completion_tokens")).alias("completion_tokens"), F.sum(total).alias("total_tokens")
    )


def split_rollup(df: DataFrame, split: str, with_reasoning: Column) -> DataFrame:
    """Per split, and as a row Total: written, with_reasoning, without_reasoning."""
    counts = [F.count("*").alias("written"), F.count_if(with_reasoning).alias("with_reasoning"), F.count_if(~with_reasoning).alias("without_reasoning")]
    rolled = df.rollup(split).agg(F.grouping(split).alias("_g"), *counts)
    return rolled.withColumn(split, F.when(F.col("_g") == 1, F.lit("Total")).otherwise(F.col(split))).drop("_g")
