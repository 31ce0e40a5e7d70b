"""Joins that stay balanced when one key holds a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepweave.session import stored

#: Largest number of rows, and of bytes in them, that this library broadcasts on its own account.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 32_000_000


def _width(df: DataFrame) -> Column:
    """Bytes of a row, or more."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    nested = [f.name for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    wide = [F.coalesce(F.octet_length(c), F.lit(0)) for c in texts] + [F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) for c in nested]
    return sum(wide, F.lit(16 * len(df.columns)).cast("long"))


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows and BROADCAST_BYTES in them, else unchanged.

    The size is measured, so ``df`` should be cheap to read (a written table
    or a small aggregate); beyond it the planner shuffles both sides.
    """
    rows, size = df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(_width(df)), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and size <= BROADCAST_BYTES else df


def join_heads(
    rows: DataFrame,
    heads: DataFrame,
    keys: list[str],
    size_col: str,
    spread_by: str,
    hot_rows: int = 200_000,
    fanout: int = 64,
) -> DataFrame:
    """Inner join of ``rows`` with one head per key, hot keys spread over ``fanout`` tasks.

    ``heads`` must be a written table with the number of rows of each key in
    ``size_col``. Keys of more than ``hot_rows`` rows get a salt, taken from a
    hash of the column ``spread_by``; their heads are repeated once per salt.
    At most ``rows/hot_rows`` keys can be hot; they are broadcast only while
    their counted number stays within :data:`BROADCAST_ROWS`.
    """
    hot = heads.where(F.col(size_col) > hot_rows).select(*keys, F.lit(True).alias("_hot"))
    n_hot = hot.count()
    if not n_hot:
        return rows.join(heads, keys)
    hot = F.broadcast(hot) if n_hot <= BROADCAST_ROWS else hot
    zero = F.lit(0).cast("long")
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread_by), F.lit(fanout).cast("long"))).otherwise(zero)
    salted = rows.join(hot, keys, "left").withColumn("_salt", salt)
    salts = F.when(F.col(size_col) > hot_rows, F.sequence(zero, F.lit(fanout - 1).cast("long"))).otherwise(F.array(zero))
    spread = heads.withColumn("_salt", F.explode(salts))
    return salted.join(spread, [*keys, "_salt"]).drop("_salt", "_hot")


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], spread_by: str, hot_rows: int = 200_000, may_broadcast: bool = True) -> DataFrame:
    """Left join of ``rows`` with a ``table`` that has each key at most once; no key is too hot, no side too large.

    A table of few rows is broadcast, unless its rows may be long (``may_broadcast``). Else the keys of ``rows`` are counted
    first, their rows of the table looked up, and hot keys spread
    (:func:`join_heads`). ``table`` should be cheap to count. Rows with a NULL
    key keep NULLs.
    """
    small = small_side(table) if may_broadcast else table
    if small is not table:
        return rows.join(small, keys, "left")
    count = "_rows_of_key"
    there = F.lit(True)
    for k in keys:
        there = there & F.col(k).isNotNull()
    heads = stored(rows.where(there).groupBy(*keys).agg(F.count("*").alias(count)).join(table, keys, "left"), "heads")
    met = join_heads(rows.where(there), heads, keys, count, spread_by, hot_rows).drop(count)
    return met.unionByName(rows.where(~there), allowMissingColumns=True)
