"""Model replies: lenient JSON, field aliases, traces per frame."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepweave.schemas import REPLY_FIELDS

# Names under which a reply may give each field, the first that is filled counts.
ALIASES = {
    "task_reasoning": ("task_reasoning", "task", "overall_task", "goal"),
    "subtask_reasoning": ("subtask_reasoning", "subtask", "current_goal", "sub_task"),
    "move_reasoning": ("move_reasoning", "movement", "motion", "arm_movement"),
    "gripper_reasoning": ("gripper_reasoning", "gripper", "gripper_action"),
    "attribute_reasoning": ("attribute_reasoning", "attributes", "object_attributes"),
    "spatial_reasoning": ("spatial_reasoning", "spatial", "spatial_relationships"),
}
PARSED = T.ArrayType(
    T.StructType([T.StructField("step_index", T.IntegerType()), *[T.StructField(f, T.StringType()) for f in REPLY_FIELDS], T.StructField("raw_response", T.StringType())])
)


def lenient_json(text: str | None):
    """The JSON value that a reply holds: as it is, without fences, with commas mended, or its first block; None if there is none."""
    if not text:
        return None
    bare = re.sub(r"\s*```\s*\Z", "", re.sub(r"\A\s*```(?:json)?\s*", "", text)).strip()  # fences within values stay
    mend = lambda s: re.sub(r",\s*([}\]])", r"\1", s)
    attempts = [text, bare, mend(bare)]
    block = re.search(r"\[[\s\S]*?\]", bare) or re.search(r"\{[\s\S]*?\}", bare)
    if block:
        attempts.append(mend(block.group()))
    for a in attempts:
        try:
            return json.loads(a)
        except (ValueError, RecursionError):
            continue
    return None


def field_of(item: dict, name: str) -> str | None:
    """The first alias whose value is a text that isn't blank, stripped."""
    found = (item.get(a) for a in ALIASES[name])
    return next((v.strip() for v in found if isinstance(v, str) and v.strip()), None)


def _frame(value) -> int | None:
    try:
        return int(value)
    except (TypeError, ValueError):
        return None


def parse_episode(text: str | None, frames: Sequence[int]) -> list[tuple]:
    """(step, six fields, raw) for every frame of an episode's reply, ordered by step.

    An item belongs to the frame it names, else to the frame of its place;
    items beyond the frames are left out. Frames without item, and all frames
    of a reply that is no JSON, get an empty trace with the raw reply, which is
    a trace all the same. A frame named twice gives two rows; the later counts.
    """
    raw = text or ""
    blank = lambda step: (step, *[None] * len(REPLY_FIELDS), raw)
    value = lenient_json(text)
    items = [value] if isinstance(value, dict) else value if isinstance(value, list) else []
    out, seen = [], set()
    for place, item in enumerate(items):
        if not isinstance(item, dict):
            continue
        named = _frame(item.get("frame_index"))
        step = named if named in frames else frames[place] if place < len(frames) else None
        if step is None:
            continue
        seen.add(step)
        out.append((step, *[field_of(item, f) for f in REPLY_FIELDS], raw))
    out += [blank(f) for f in frames if f not in seen]
    return sorted(out, key=lambda r: r[0])


def parse_step(text: str | None) -> tuple:
    """The six fields and the raw reply of an answer about one step; the first item of a list counts."""
    value = lenient_json(text)
    item = value[0] if isinstance(value, list) and value else value
    fields = [field_of(item, f) for f in REPLY_FIELDS] if isinstance(item, dict) else [None] * len(REPLY_FIELDS)
    return (*fields, text or "")


def parsed_reply(text: Column, frames: Column, latest: bool = True) -> Column:
    """:func:`parse_episode` over columns, as an array of structs; batches travel by Arrow.

    With ``latest`` each step occurs once: where a reply names it twice, the last counts.
    """

    @F.pandas_udf(PARSED)
    def run(texts: pd.Series, frame_lists: pd.Series) -> pd.Series:
        names = PARSED.elementType.fieldNames()
        out = []
        for t, f in zip(texts, frame_lists):
            rows = parse_episode(t, [int(x) for x in f] if f is not None else [])
            out.append([dict(zip(names, r)) for r in ({r[0]: r for r in rows}.values() if latest else rows)])
        return pd.Series(out)

    return run(text, frames)


def parsed_step(text: Column) -> Column:
    """:func:`parse_step` over a column, as a struct."""
    names = [*REPLY_FIELDS, "raw_response"]

    @F.pandas_udf(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse_step(t) for t in texts], columns=names)

    return run(text)


def missing_frames(frames: Column, named: Column) -> Column:
    """Frames that no item names, in their order."""
    return F.array_except(frames, named)
