"""The data behind figures, previews and summaries; drawing is left to whoever has a plotting library."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepweave.functions import arrays, text
from stepweave.operators import sampling, sequences
from stepweave.schemas import STATE_PARTS


def has_image(data: Column, path: Column | None = None) -> Column:
    """Whether a frame is in memory or has a path."""
    return data.isNotNull() if path is None else data.isNotNull() | path.isNotNull()


def enriched_observation(columns: list[str]) -> Column:
    """An observation with the four cameras under their names, and depth and scene marked as not there."""
    names = ("image", "image_secondary", "image_tertiary", "image_quaternary")
    images = [(F.col(f"image_{k}") if f"image_{k}" in columns else F.lit(None).cast("binary")).alias(n) for k, n in enumerate(names)]
    state = F.col("state") if "state" in columns else F.lit(None).cast("array<float>")
    return F.struct(*images, state.alias("state"), F.struct(F.lit(False).alias("valid")).alias("depth_map"), F.struct(F.lit(False).alias("valid")).alias("scene_graph"))


def provenance(annotation: Column, demonstration: Column, backend: Column, model: Column, version: str = "1.0") -> Column:
    """Where an episode comes from."""
    return F.struct(
        annotation.alias("annotation_source"), demonstration.alias("demonstration_source"), backend.alias("generation_backend"), model.alias("generation_model"), F.lit(version).alias("schema_version")
    )


def annotated_steps(steps: DataFrame, trace: str = "reasoning") -> DataFrame:
    return steps.where(F.col(trace).isNotNull())


def high_confidence_steps(steps: DataFrame, threshold: float = 0.9) -> DataFrame:
    return steps.where(F.col("alignment_confidence") >= threshold)


def step_at(steps: DataFrame, key: str, wanted: object, step: int) -> DataFrame:
    """One step of one episode; fails if the episode has no such step. The filter reaches the scan."""
    found = steps.where((F.col(key) == F.lit(wanted)) & (F.col("step_index") == step)).limit(1)
    if found.isEmpty():
        raise IndexError(f"episode {wanted!r} has no step {step}")
    return found


def frame_strip(steps: DataFrame, key: str, n: int, image: str | None = None) -> DataFrame:
    """``n`` evenly spaced steps per episode, as viewers show them; with ``image`` only steps that have one count."""
    have = steps.where(F.col(image).isNotNull()) if image else steps
    counts = have.groupBy(key).agg(F.count("*").cast("int").alias("_n"))
    place = F.row_number().over(Window.partitionBy(key).orderBy("step_index")) - 1
    numbered = have.withColumn("_pos", place).join(counts, key)
    return numbered.where(F.array_contains(sampling.spaced_frames(F.col("_n"), n), F.col("_pos"))).drop("_n", "_pos")


def gripper_view(steps: DataFrame, key: str, gripper: Column) -> tuple[DataFrame, DataFrame]:
    """(steps with value and label, phases of open and closed)."""
    named = steps.select(key, "step_index", gripper.alias("value"), sequences.gripper_label(gripper).alias("label"))
    return named, sequences.phases(named, key, "step_index", F.col("value") > 0.5)


def state_view(steps: DataFrame, key: str, state: str = "state", names: tuple[str, ...] = STATE_PARTS) -> DataFrame:
    """Non-NULL states as one column per part."""
    return steps.where(F.col(state).isNotNull()).select(key, "step_index", *[F.get(state, i).alias(n) for i, n in enumerate(names)])


def action_view(steps: DataFrame, key: str, action: str = "action") -> DataFrame:
    p = arrays.action_parts(F.col(action))
    return steps.select(key, "step_index", p["xyz"].alias("xyz"), p["rpy"].alias("rpy"), p["gripper"].alias("gripper"))


def episode_summary(steps: DataFrame, key: str, trace: str = "reasoning") -> DataFrame:
    """Per episode: steps, with_reasoning, share, mean_confidence."""
    have = F.count_if(F.col(trace).isNotNull())
    return steps.groupBy(key).agg(F.count("*").alias("steps"), have.alias("with_reasoning"), (have / F.count("*")).alias("share"), F.avg("alignment_confidence").alias("mean_confidence"))


def file_counts(episodes: DataFrame, path: str, order: str) -> DataFrame:
    """Episodes per file and the first of each."""
    return episodes.groupBy(path).agg(F.count("*").alias("episodes"), F.min(order).alias("first_episode"))


def key_stats(episodes: DataFrame, path: str, n: int = 5) -> DataFrame:
    """One row: how many files and episodes there are, and the first ``n`` file names."""
    names = episodes.groupBy(path).agg(F.count("*").alias("k"))
    sample = [r[0] for r in names.where(F.col(path).isNotNull()).orderBy(path).limit(n).collect()]
    return names.agg(F.count("*").alias("files"), F.coalesce(F.sum("k"), F.lit(0)).alias("episodes"), F.lit(sample).cast("array<string>").alias("sample"))


def preview(steps: DataFrame, width: int = 35, columns: tuple[str, ...] = ("task_reasoning", "subtask_reasoning", "move_reasoning")) -> DataFrame:
    """Steps with the beginnings of their traces, for printing."""
    return steps.select("step_index", *[text.head(F.col("reasoning")[c], width).alias(c) for c in columns])


def shuffled(df: DataFrame, seed: int = 42) -> DataFrame:
    return df.orderBy(F.rand(seed))


def zipped(left: Column, right: Column) -> Column:
    """Two arrays by place, as long as the shorter one."""
    n = F.least(F.size(left), F.size(right))
    return F.slice(F.arrays_zip(left, right), 1, n)


def numbered_rows(df: DataFrame, order: list[str], by: list[str] | None = None) -> DataFrame:
    """0-based running number within ``by``. Without ``by`` numbers follow the order over all rows by ranges, not in one task."""
    if by:
        return df.withColumn("number", F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before"))  # a row per partition
    inside = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return ranged.withColumn("_i", inside).join(F.broadcast(before), "_p").withColumn("number", F.col("_before") + F.col("_i") - 1).drop("_p", "_i", "_before")


def flat_export(nested: DataFrame) -> DataFrame:
    """Exported episodes read back as one flat row per step."""
    s = nested.select("*", F.posexplode("steps").alias("step_index", "s")).drop("steps")
    names = [f.name for f in nested.schema["steps"].dataType.elementType if f.dataType.typeName() != "struct"]
    inner = [F.col(f"s.{n}").alias(n) for n in names]
    reasoning = [F.nullif(F.col(f"s.reasoning.{n}"), F.lit("")).alias(f"reasoning_{n}") for n in ("task", "plan", "subtask", "subtask_reason", "move", "move_reason")]
    keep = [c for c in nested.columns if c != "steps"]
    return s.select(*keep, "step_index", *inner, *reasoning, F.col("s.observation.state").alias("state"), F.col("s.ecot_features.move_primitive").alias("move_primitive"))
