"""Schemas of episodes, steps, annotations, requests and exports."""

from __future__ import annotations

from pyspark.sql import types as T

#: The text fields of a trace in their order; six of them are exported under short names.
TRACE_FIELDS = (
    "task_reasoning", "plan", "subtask_reasoning", "subtask_reason", "move_reasoning", "move_reason",
    "gripper_reasoning", "attribute_reasoning", "spatial_reasoning",
)
SHORT_NAMES = {"task": "task_reasoning", "plan": "plan", "subtask": "subtask_reasoning", "subtask_reason": "subtask_reason", "move": "move_reasoning", "move_reason": "move_reason"}
COMPLETE_FIELDS = TRACE_FIELDS[:6]
#: Fields that a model is asked for.
REPLY_FIELDS = ("task_reasoning", "subtask_reasoning", "move_reasoning", "gripper_reasoning", "attribute_reasoning", "spatial_reasoning")
ACTION_PARTS = ("delta_x", "delta_y", "delta_z", "delta_roll", "delta_pitch", "delta_yaw", "gripper")
STATE_PARTS = ("x", "y", "z", "roll", "pitch", "yaw", "gripper")
EMBEDDING_SIZE, ACTION_SIZE, STATE_3D_SIZE, IMAGE_SIDE = 512, 7, 3, 256
STRATEGIES = ("exact", "nearest", "broadcast")


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


_S, _I, _B, _D, _F = T.StringType(), T.IntegerType(), T.BooleanType(), T.DoubleType(), T.FloatType()
_FLOATS = T.ArrayType(_F)

TRACE = _struct(**dict.fromkeys(TRACE_FIELDS, _S), raw_response=_S, extra=T.MapType(_S, _S))
ANNOTATION_STEP = _struct(
    join_key=_S, step_index=_I, reasoning=TRACE, is_first=_B, is_last=_B, move_primitive=_S, gripper_position=_FLOATS, bboxes=_S, state_3d=_FLOATS
)
ANNOTATION_EPISODE = _struct(
    episode_id=_S, file_path=_S, source_episode_id=_S, join_key=_S, language_instruction=_S, n_steps=_I, caption=_S, source_dataset=_S,
    generation_backend=_S, generation_model=_S,
)
OBSERVATION = _struct(
    image_0=T.BinaryType(), image_1=T.BinaryType(), image_2=T.BinaryType(), image_3=T.BinaryType(), state=_FLOATS
)
DEMO_STEP = _struct(
    episode_id=_S, step_index=_I, observation=OBSERVATION, action=_FLOATS, language_instruction=_S, language_embedding=_FLOATS,
    is_first=_B, is_last=_B, is_terminal=_B, reward=_D, discount=_D,
)
DEMO_EPISODE = _struct(
    episode_id=_S, source_file=_S, episode_num=_I, join_key=_S, language_instruction=_S, split=_S,
    has_image_0=_B, has_image_1=_B, has_image_2=_B, has_image_3=_B, has_language=_B,
)
ALIGNMENT_METADATA = _struct(
    strategy=_S, num_steps_ecot=_I, num_steps_bridge=_I, num_aligned_steps=_I, num_annotated_steps=_I, coverage=_D
)
PROVENANCE = _struct(annotation_source=_S, demonstration_source=_S, generation_backend=_S, generation_model=_S, schema_version=_S)
DEPTH_MAP = _struct(valid=_B, data_path=_S, sensor_type=_S, scale_factor=_D)
SCENE_GRAPH = _struct(
    valid=_B,
    nodes=T.ArrayType(_struct(node_id=_S, label=_S, bbox=T.ArrayType(_D), confidence=_D, attributes=T.MapType(_S, _S))),
    edges=T.ArrayType(_struct(source=_S, target=_S, relation=_S, confidence=_D)),
)
SHORT_TRACE = _struct(**dict.fromkeys(SHORT_NAMES, _S))
EXPORT_FEATURES = _struct(caption=_S, move_primitive=_S, gripper_position=_FLOATS, bboxes=_S, state_3d=_FLOATS)
EXPORT_STEP = _struct(
    observation=OBSERVATION, action=_FLOATS, language_instruction=_S, language_embedding=_FLOATS, is_first=_B, is_last=_B, is_terminal=_B,
    reward=_F, discount=_F, reasoning=SHORT_TRACE, ecot_features=EXPORT_FEATURES, alignment_confidence=_F,
)
EXPORT_EPISODE = _struct(
    episode_metadata=_struct(file_path=_S, episode_id=_I, has_image_0=_B, has_image_1=_B, has_image_2=_B, has_image_3=_B, has_language=_B),
    steps=T.ArrayType(EXPORT_STEP),
)
PROMPT = _struct(text=_S, images=T.ArrayType(T.BinaryType()), system_prompt=_S, metadata=T.MapType(_S, _S))
TOKEN_USAGE = _struct(prompt_tokens=_I, completion_tokens=_I, total_tokens=_I)
GENERATION_RESULT = _struct(text=_S, model=_S, finish_reason=_S, usage=TOKEN_USAGE, metadata=T.MapType(_S, _S))
