"""Rules that episodes must keep, as one plan with one shuffle per table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepweave.functions.arrays import all_zero
from stepweave.functions.text import filled, percent
from stepweave.schemas import ACTION_SIZE, STRATEGIES


@dataclass(frozen=True)
class Rules:
    min_steps: int = 1
    min_coverage: float = 0.0
    require_images: bool = False
    max_zero_share: float = 0.5


def _listed(*messages: Column) -> Column:
    return F.array_compact(F.array(*messages))


def step_checks(steps: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Per episode what its steps show; ``steps`` has key, step_index, is_first, is_last, action, has_trace, has_image.

    Columns: n_steps, step_errors (a message per wrong step, by place),
    n_first, n_last, first_at, last_at, zero_share, coverage, any_image.
    ``order`` is the stored order, a total one.
    """
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1
    size = F.coalesce(F.size("action"), F.lit(0))
    s = steps.withColumn("pos", place)
    wrong_index = F.when(
        ~F.col("step_index").eqNullSafe(F.col("pos")),
        F.concat(F.lit("step_index mismatch at position "), F.col("pos").cast("string"), F.lit(": expected "), F.col("pos").cast("string"), F.lit(", got "),
                 F.coalesce(F.col("step_index").cast("string"), F.lit("None")), F.lit(".")),
    )
    wrong_size = F.when(
        size != ACTION_SIZE, F.concat(F.lit("Step "), F.col("pos").cast("string"), F.lit(": action shape is ("), size.cast("string"), F.lit(",), expected (7,)."))
    )
    per_step = F.struct("pos", wrong_index.alias("index_error"), wrong_size.alias("size_error"))
    rows = F.array_sort(F.collect_list(F.when(wrong_index.isNotNull() | wrong_size.isNotNull(), per_step)))
    out = s.groupBy(key).agg(
        F.count("*").alias("n_steps"), rows.alias("_bad"), F.count_if("is_first").alias("n_first"), F.count_if("is_last").alias("n_last"),
        F.min(F.when(F.col("is_first"), F.col("pos"))).alias("first_at"), F.max(F.when(F.col("is_last"), F.col("step_index"))).alias("last_at"),
        F.avg(F.coalesce(all_zero(F.col("action")), F.lit(False)).cast("double")).alias("zero_share"), F.avg(F.col("has_trace").cast("double")).alias("coverage"),
        F.coalesce(F.bool_or("has_image"), F.lit(False)).alias("any_image"),
    )
    only = lambda f: F.array_compact(F.transform("_bad", lambda x: x[f]))
    return out.withColumn("index_errors", only("index_error")).withColumn("size_errors", only("size_error")).drop("_bad")


def validated(episodes: DataFrame, steps: DataFrame, key: str, order: list[str], rules: Rules = Rules()) -> DataFrame:
    """Per episode: errors, warnings, passed, zero_action_fraction, reasoning_coverage.

    ``episodes`` has key, episode_id, schema_version, task_description,
    strategy, declared_steps. Episodes without steps get no step rules.
    """
    e = episodes.join(step_checks(steps, key, order), key, "left").withColumn("n_steps", F.coalesce("n_steps", F.lit(0)))
    some = F.col("n_steps") > 0
    text = lambda c: F.col(c).cast("string")

    def flag(name: str, at: Column, target: Column, where: str) -> Column:
        n = F.col(f"n_{name}")
        return F.when(some & (n != 1), F.concat(F.lit(f"Expected exactly 1 is_{name} step, found "), n.cast("string"), F.lit("."))).when(
            some & (at != target), F.lit(f"is_{name} is not on {where}.")
        )

    errors = F.concat(
        _listed(
            F.when(~filled(F.col("episode_id")), F.lit("episode_id is empty.")),
            F.when(F.col("n_steps") < rules.min_steps, F.concat(F.lit("Episode has "), text("n_steps"), F.lit(f" steps; minimum is {rules.min_steps}."))),
        ),
        F.coalesce("index_errors", F.array().cast("array<string>")),
        _listed(flag("first", F.col("first_at"), F.lit(0), "step 0"), flag("last", F.col("last_at"), F.col("n_steps") - 1, "the last step")),
        F.coalesce("size_errors", F.array().cast("array<string>")),
    )
    warnings = _listed(
        F.when(~filled(F.col("schema_version")), F.lit("schema_version is not set.")),
        F.when(some & (F.col("zero_share") > rules.max_zero_share), F.concat(percent(F.col("zero_share")), F.lit(" of actions are all-zeros — possible data issue."))),
        F.when(
            (F.col("declared_steps") > 0) & (F.col("declared_steps") != F.col("n_steps")),
            F.concat(F.lit("Step count "), text("n_steps"), F.lit(" differs from the declared "), text("declared_steps"), F.lit(".")),
        ),
        F.when(~F.coalesce(F.col("strategy").isin(*STRATEGIES), F.lit(False)), F.concat(F.lit("Unknown alignment strategy: "), F.coalesce("strategy", F.lit("None")), F.lit("."))),
        F.when(~filled(F.col("task_description")), F.lit("task_description is empty.")),
        F.when(F.coalesce("coverage", F.lit(0.0)) < rules.min_coverage, F.lit(f"Reasoning coverage is below {rules.min_coverage}.")),
        F.when(F.lit(rules.require_images) & ~F.coalesce("any_image", F.lit(False)), F.lit("No step has an image.")),
    )
    return e.select(
        key, errors.alias("errors"), warnings.alias("warnings"), (F.size(errors) == 0).alias("passed"), F.col("zero_share").alias("zero_action_fraction"),
        F.coalesce("coverage", F.lit(0.0)).alias("reasoning_coverage"),
    )


def report(checked: DataFrame) -> DataFrame:
    """One row: total, passed, failed, with_warnings, pass_rate, summary."""
    n, ok = F.count("*"), F.count_if("passed")
    rate = F.coalesce(ok / F.nullif(n, F.lit(0)), F.lit(0.0))
    summary = F.concat(ok.cast("string"), F.lit("/"), n.cast("string"), F.lit(" episodes passed ("), percent(rate), F.lit(")"))
    return checked.agg(n.alias("total"), ok.alias("passed"), (n - ok).alias("failed"), F.count_if(F.size("warnings") > 0).alias("with_warnings"), rate.alias("pass_rate"), summary.alias("summary"))


def failed(checked: DataFrame) -> DataFrame:
    return checked.where("not passed")


def only_passed(rows: DataFrame, checked: DataFrame, key: str) -> DataFrame:
    """Rows of episodes that passed."""
    return rows.join(checked.where("passed").select(key), key, "left_semi")
