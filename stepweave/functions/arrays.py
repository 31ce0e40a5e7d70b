"""Vector expressions over arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stepweave.schemas import ACTION_PARTS, EMBEDDING_SIZE, STATE_3D_SIZE

ZERO_TOLERANCE = 1e-8


def padded(vector: Column, size: int, kind: str = "float") -> Column:
    """Exactly ``size`` entries: cut, or filled with zeros; all zeros for NULL."""
    zeros = F.array_repeat(F.lit(0.0).cast(kind), size)
    return F.coalesce(F.slice(F.concat(vector.cast(f"array<{kind}>"), zeros), 1, size), zeros)


def pad7(vector: Column) -> Column:
    return padded(vector, 7)


def pad_embedding(vector: Column) -> Column:
    return padded(vector, EMBEDDING_SIZE)


def pad_state_3d(vector: Column) -> Column:
    return padded(vector, STATE_3D_SIZE)


def cut2(vector: Column) -> Column:
    """At most two entries, not filled up; empty for NULL."""
    return F.coalesce(F.slice(vector.cast("array<float>"), 1, 2), F.array().cast("array<float>"))


def norm(vector: Column) -> Column:
    """Euclidean length; 0 for NULL and empty vectors."""
    square = F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return F.coalesce(F.sqrt(square), F.lit(0.0))


def all_zero(vector: Column) -> Column:
    """Whether every entry is within the tolerance of 0; NaN never is."""
    return F.forall(vector, lambda x: F.abs(x) <= ZERO_TOLERANCE)


def same(a: Column, b: Column) -> Column:
    """Equal, NULL equal to NULL and NaN to NaN."""
    return a.eqNullSafe(b)


def named_action(vector: Column) -> Column:
    """A struct with the seven parts of an action; fails if there are not seven."""
    checked = F.when(F.size(vector) == 7, vector).otherwise(F.raise_error(F.lit("an action has seven entries")).cast("array<float>"))
    return F.struct(*[F.get(checked, i).alias(n) for i, n in enumerate(ACTION_PARTS)])


def action_vector(action: Column) -> Column:
    """The seven parts of an action struct as a vector."""
    return F.array(*[action[n].cast("float") for n in ACTION_PARTS])


def action_parts(vector: Column) -> Column:
    """xyz, rpy and gripper of an action."""
    return F.struct(F.slice(vector, 1, 3).alias("xyz"), F.slice(vector, 4, 3).alias("rpy"), F.get(vector, 6).alias("gripper"))


def step_distance(a: Column, b: Column, upto: int = 3) -> Column:
    """Euclidean distance of the first entries of two vectors, entry differences taken in their own type."""
    diff = F.zip_with(F.slice(a, 1, upto), F.slice(b, 1, upto), lambda x, y: (x - y).cast("double"))
    return F.sqrt(F.aggregate(diff, F.lit(0.0), lambda s, d: s + d * d))
