"""Curated episodes as lines of JSON, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepweave.operators.align import DIRECT
from stepweave.schemas import ALIGNMENT_METADATA, PROVENANCE, TRACE_FIELDS
from stepweave.sources.files import read_jsonl

_TRACE = T.StructType([T.StructField(f, T.StringType()) for f in TRACE_FIELDS])
_STEP = T.StructType(
    [
        T.StructField("step_index", T.IntegerType()), T.StructField("action", T.ArrayType(T.DoubleType())), T.StructField("reasoning", _TRACE),
        T.StructField("is_first", T.BooleanType()), T.StructField("is_last", T.BooleanType()), T.StructField("source_dataset", T.StringType()),
        T.StructField("alignment_confidence", T.DoubleType()), T.StructField("image_path", T.StringType()), T.StructField("state", T.ArrayType(T.DoubleType())),
    ]
)
LINE = T.StructType(
    [
        T.StructField("schema_version", T.StringType()), T.StructField("episode_id", T.StringType()), T.StructField("task_description", T.StringType()),
        T.StructField("alignment_metadata", ALIGNMENT_METADATA), T.StructField("provenance", PROVENANCE), T.StructField("steps", T.ArrayType(_STEP)),
    ]
)


def _of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


_S, _I, _B, _D, _V = T.StringType(), T.IntegerType(), T.BooleanType(), T.DoubleType(), T.ArrayType(T.DoubleType())
_FULL_TRACE = _of(**dict.fromkeys(TRACE_FIELDS, _S), extra=T.MapType(_S, _S))
_ANNOTATED = _of(step_index=_I, action=_V, reasoning=_FULL_TRACE, is_first=_B, is_last=_B, image_path=_S)
_SEEN = _of(step_index=_I, image_0_path=_S, image_1_path=_S, state=_V)
_DEMONSTRATED = _of(step_index=_I, action=_V, language_instruction=_S, is_first=_B, is_last=_B, is_terminal=_B, reward=_D, discount=_D, observation=_SEEN)
# The fields that each kind of object has as JSON; what else a row holds (raw replies, embeddings, images) is left out.
SHAPES = {
    "trace": _FULL_TRACE,
    "annotation_step": _ANNOTATED,
    "annotation_episode": _of(episode_id=_S, language_instruction=_S, source_dataset=_S, metadata=T.MapType(_S, _S), steps=T.ArrayType(_ANNOTATED)),
    "demo_step": _DEMONSTRATED,
    "demo_episode": _of(episode_id=_S, language_instruction=_S, source_file=_S, metadata=T.MapType(_S, _S), steps=T.ArrayType(_DEMONSTRATED)),
    "alignment_metadata": _of(
        strategy=_S, ecot_episode_id=_S, bridge_episode_id=_S, num_steps_ecot=_I, num_steps_bridge=_I, num_aligned_steps=_I, num_annotated_steps=_I, reasoning_coverage=_D, alignment_notes=_S
    ),
    "depth_map": _of(valid=_B, data_path=_S, sensor_type=_S, scale_factor=_D),
    "scene_graph": _of(
        valid=_B, nodes=T.ArrayType(_of(node_id=_S, label=_S, bbox=_V, confidence=_D, attributes=T.MapType(_S, _S))),
        edges=T.ArrayType(_of(source_id=_S, target_id=_S, relation=_S, confidence=_D)), source_model=_S,
    ),
}


def _fitted(value: Column, kind: T.DataType, wanted: T.DataType) -> Column:
    """A value with the fields of ``wanted`` alone, NULL for those it has not."""
    if isinstance(wanted, T.StructType) and isinstance(kind, T.StructType):
        have = {f.name: f.dataType for f in kind}
        parts = [(_fitted(value[f.name], have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(wanted, T.ArrayType) and isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _fitted(x, kind.elementType, wanted.elementType))
    return value.cast(wanted)


def object_lines(rows: DataFrame, kind: str) -> DataFrame:
    """One JSON text per row for an object of a kind of SHAPES, NULL fields kept; columns beyond the kind's are left out."""
    have = {f.name: f.dataType for f in rows.schema}
    parts = [(_fitted(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in SHAPES[kind]]
    return rows.select(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}).alias("value"))


def objects_of(lines: DataFrame, kind: str, text: str = "value") -> DataFrame:
    """The objects that lines hold; missing fields are NULL, a trace may bring its raw reply, a broken line fails."""
    shape = T.StructType([*SHAPES[kind], T.StructField("raw_response", _S)]) if kind == "trace" else SHAPES[kind]
    return lines.where(F.trim(text) != "").select(F.from_json(text, shape, {"mode": "FAILFAST"}).alias("row")).select("row.*")


def episode_lines(episodes: DataFrame, steps: DataFrame) -> DataFrame:
    """Rows of :data:`LINE`: ``episodes`` has its columns but steps, ``steps`` episode_id and those of a step."""
    packed = F.struct(*[(F.col(f.name) if f.name in steps.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in _STEP])
    lists = steps.groupBy("episode_id").agg(F.array_sort(F.collect_list(packed), lambda a, b: F.when(a.step_index < b.step_index, -1).when(a.step_index > b.step_index, 1).otherwise(0)).alias("steps"))
    joined = episodes.join(lists, "episode_id", "left")
    return joined.select(*[(F.col(f.name) if f.name in joined.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in LINE])


def read_episodes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(episodes, steps) of a file of lines, defaults filled in: confidence 1.0, zero actions, empty lists."""
    lines = read_jsonl(spark, path, LINE)
    zeros = F.array_repeat(F.lit(0.0), 7)
    steps = lines.select("episode_id", F.explode("steps").alias("s")).select("episode_id", "s.*")
    steps = steps.withColumn("alignment_confidence", F.coalesce("alignment_confidence", F.lit(DIRECT))).withColumn("action", F.when(F.size("action") > 0, F.col("action")).otherwise(zeros))
    return lines.drop("steps"), steps
