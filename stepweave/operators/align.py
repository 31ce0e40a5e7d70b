"""Sparse annotations on dense step sequences: matching, aligning, filling, confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepweave.functions.text import clean_field
from stepweave.operators.skew import small_side
from stepweave.schemas import STRATEGIES, TRACE_FIELDS

DIRECT, PROPAGATED, ABSENT = 1.0, 0.7, 0.0
#: The three fields that the strict variant of cleaning leaves empty.
STRICT_DROPS = ("plan", "subtask_reason", "move_reason")


def check_strategy(strategy: str) -> str:
    if strategy not in STRATEGIES:
        raise ValueError(f"alignment strategy {strategy!r}; one of {', '.join(STRATEGIES)}")
    return strategy


def filled_along(value: Column, strategy: str, partition: list[str], order: list[str]) -> Column:
    """``value`` carried along a sequence.

    nearest: the last one so far, and the first one before it; broadcast: the
    first one everywhere, also over others; exact: as it is. The frame for the
    head is the whole partition: one running to its end would cost the square
    of its length.
    """
    check_strategy(strategy)
    along = Window.partitionBy(*partition).orderBy(*order)
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if strategy == "exact":
        return value
    first = F.first(value, ignorenulls=True).over(whole)
    if strategy == "broadcast":
        return F.coalesce(first, value)
    return F.coalesce(F.last(value, ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)), first)


def confidence(direct: Column, trace: Column) -> Column:
    """1.0 on a step that has an annotation of its own, 0.7 where one was carried to, else 0.0."""
    return F.when(direct, F.lit(DIRECT)).when(trace.isNotNull(), F.lit(PROPAGATED)).otherwise(F.lit(ABSENT))


def confidence_band(value: Column) -> Column:
    """direct from 0.95, propagated from 0.4, else none."""
    return F.when(value >= 0.95, "direct").when(value >= 0.4, "propagated").otherwise("none")


def clean_trace(trace: Column, fields: tuple[str, ...] = TRACE_FIELDS, strict: bool = False) -> Column:
    """Every text field cleaned; a NULL trace stays NULL, one without any text stays a trace."""
    cleaned = [(F.lit(None).cast("string") if strict and f in STRICT_DROPS else clean_field(trace[f])).alias(f) for f in fields]
    return F.when(trace.isNotNull(), F.struct(*cleaned))


def aligned(
    steps: DataFrame, annotations: DataFrame, keys: list[str], order: str, trace: str, strategy: str = "nearest", extra: dict[str, Column] | None = None
) -> DataFrame:
    """``steps`` with ``trace``, ``direct`` and ``alignment_confidence``, one row per step.

    ``annotations`` has the keys, the order column, the trace and other
    columns, none of which ``steps`` has; it must hold one row per step.
    ``extra`` gives defaults for its other columns on steps without annotation.
    Annotations of steps that do not exist are left out, as are those with a
    NULL key or order; steps with a NULL order keep no annotation.

    Both tables are stacked rather than joined: an annotation sorts right
    before its step, so that lookup and filling are windows over one exchange
    and one sort on the keys.
    """
    check_strategy(strategy)
    own = [c for c in annotations.columns if c not in (*keys, order)]
    rest = [c for c in steps.columns if c not in (*keys, order)]
    kinds = {f.name: f.dataType for f in annotations.schema} | {f.name: f.dataType for f in steps.schema}
    null = lambda c: F.lit(None).cast(kinds[c]).alias(c)
    base = [F.col(c).cast(kinds[c]).alias(c) for c in (*keys, order)]
    above = annotations.select(*base, *[null(c) for c in rest], *[F.col(c) for c in own], F.lit(0).alias("_step"))
    below = steps.select(*base, *rest, *[null(c) for c in own], F.lit(1).alias("_step"))
    w = Window.partitionBy(*keys).orderBy(order, "_step")
    noted = (F.lag("_step").over(w) == 0) & (F.lag(order).over(w) == F.col(order)) & (F.col("_step") == 1)
    for k in keys:
        noted &= F.col(k).isNotNull()
    found = F.lag(F.struct(*own)).over(w)
    placed = above.unionByName(below).withColumn("_own", F.when(noted, found))
    value = F.col(f"_own.{trace}")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.first(value, ignorenulls=True).over(whole)
    carried = {
        "exact": value,
        "broadcast": F.coalesce(first, value),
        "nearest": F.coalesce(F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)), first),
    }[strategy]
    filled = placed.withColumn("_trace", carried).where("_step = 1")
    other = [F.coalesce(F.col(f"_own.{c}"), extra[c]).alias(c) if extra and c in extra else F.col(f"_own.{c}").alias(c) for c in own if c != trace]
    out = filled.select(*keys, order, *rest, *other, F.col("_trace").alias(trace), value.isNotNull().alias("direct"))
    return out.withColumn("alignment_confidence", confidence(F.col("direct"), F.col(trace)))


def filled(df: DataFrame, keys: list[str], order: str, trace: str, strategy: str = "nearest") -> DataFrame:
    """As :func:`aligned` where each step carries its annotation (or NULL) already: one exchange, one sort."""
    carried = filled_along(F.col(trace), strategy, keys, [order])
    marked = df.withColumn("direct", F.col(trace).isNotNull()).withColumn(trace, carried)
    return marked.withColumn("alignment_confidence", confidence(F.col("direct"), F.col(trace)))


def matched_inner(demos: DataFrame, annotations: DataFrame, key: str = "join_key") -> DataFrame:
    """Demonstrations that have annotations; rows without key never match. The annotation side is broadcast only if it is small."""
    return demos.where(F.col(key).isNotNull()).join(small_side(annotations.where(F.col(key).isNotNull())), key)


def matched_all(demos: DataFrame, annotations: DataFrame, key: str = "join_key") -> DataFrame:
    """All demonstrations, with annotations where there are any."""
    return demos.join(annotations.where(F.col(key).isNotNull()), key, "left")


def unmatched(demos: DataFrame, annotations: DataFrame, key: str = "join_key") -> DataFrame:
    """Demonstrations without annotations, those without key among them."""
    return demos.join(annotations.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def matched_or_path(annotations: DataFrame, demos: DataFrame, key: str, path: str, payload: list[str], order: list[Column]) -> DataFrame:
    """Annotations with the demonstration of their key, else with the last one of their path.

    Both frames have ``key`` and ``path``; ``payload`` are the demonstration's
    columns, ``order`` tells which of several counts. Annotations without
    either are left out.
    """
    packed = F.max(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *payload))
    by_key = demos.where(F.col(key).isNotNull()).groupBy(key).agg(packed.alias("_k"))
    by_path = demos.where(F.col(path).isNotNull()).groupBy(path).agg(packed.alias("_p"))
    joined = annotations.join(by_key, key, "left").join(by_path, path, "left").withColumn("_d", F.coalesce("_k", "_p"))
    how = F.when(F.col("_k").isNotNull(), "key").otherwise("path").alias("matched_by")
    return joined.where("_d is not null").select(*annotations.columns, *[F.col(f"_d.{c}").alias(c) for c in payload], how)


def match_counts(demos: DataFrame, annotations: DataFrame, key: str = "join_key") -> DataFrame:
    """One row: demonstrations, matched, unmatched, match_rate (rounded half to even)."""
    known = annotations.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_hit", F.lit(True))
    n, hit = F.count("*"), F.count("_hit")
    return demos.join(known, key, "left").agg(
        n.alias("demonstrations"), hit.alias("matched"), (n - hit).alias("unmatched"), F.coalesce(F.bround(hit / F.nullif(n, F.lit(0)), 4), F.lit(0.0)).alias("match_rate")
    )


def dense_steps(episodes: DataFrame, count: str, name: str = "step_index") -> DataFrame:
    """One row per step 0..count-1; none for a count that is NULL or below 1."""
    return episodes.where(F.col(count) > 0).withColumn(name, F.explode(F.sequence(F.lit(0), F.col(count).cast("int") - 1)))


def flags(keys: list[str], order: str, first: Column | None = None, last: Column | None = None) -> tuple[Column, Column]:
    """(is_first, is_last) by place; stored flags are kept where they are given."""
    w = Window.partitionBy(*keys).orderBy(order)
    at_start = F.row_number().over(w) == 1
    at_end = F.lead(F.lit(1)).over(w).isNull()
    return (at_start if first is None else at_start | F.coalesce(first, F.lit(False))), (at_end if last is None else at_end | F.coalesce(last, F.lit(False)))


def alignment_metadata(aligned_steps: DataFrame, annotations: DataFrame, keys: list[str], trace: str, strategy: str, schema_version: str = "1.0") -> DataFrame:
    """Per episode: strategy, steps on both sides, annotated steps (also those beyond the sequence), coverage, schema_version."""
    right = annotations.groupBy(*keys).agg(F.count("*").alias("num_steps_ecot"), F.count(trace).alias("num_annotated_steps"))
    left = aligned_steps.groupBy(*keys).agg(F.count("*").alias("num_steps_bridge"), F.count(trace).alias("_with"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return left.join(right, keys, "left").select(
        *keys, F.lit(check_strategy(strategy)).alias("strategy"), zero("num_steps_ecot").alias("num_steps_ecot"), "num_steps_bridge",
        F.col("num_steps_bridge").alias("num_aligned_steps"), zero("num_annotated_steps").alias("num_annotated_steps"),
        (F.col("_with") / F.col("num_steps_bridge")).alias("coverage"), F.lit(schema_version).alias("schema_version"),
    )
