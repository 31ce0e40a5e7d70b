"""Incremental forms of the curation: appended files, finished episodes, traces carried forward as state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from stepweave.operators.setops import not_done


def read_appended(spark: SparkSession, path: str, schema, files_per_trigger: int = 64) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def process_new(stream: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, key: str, checkpoint: str, rows_differ: bool = False):
    """Runs ``work`` on rows whose key is not in ``out`` yet and appends what it gives; repeated batches change nothing.

    A key has one row, of which any copy counts; with ``rows_differ`` it may have
    several, such as steps, that all count and arrive together.

    Returns the started query, which ends when all files at hand are done.
    """

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        try:
            done = spark.read.parquet(out).select(key)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            done = df.select(key).limit(0)  # nothing is written yet
        fresh = not_done(df.distinct() if rows_differ else df.dropDuplicates([key]), done, key)
        work(fresh).write.mode("append").parquet(out)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def carried_forward(stream: DataFrame, key: str, order: str, value: str, last: str | None = None) -> DataFrame:
    """key, order, value: each row with the last value so far of its key, held as state between batches.

    Rows before a key's first value wait in the state and come with it: what
    fills the head is not known earlier. With ``last`` (a flag of the last row)
    a key's state ends there, and a head without any value is given out as it
    is. Rows must arrive in order within their key; late ones get the present value.
    """
    kt, ot = stream.schema[key].dataType.simpleString(), stream.schema[order].dataType.simpleString()
    rows = stream.select(key, order, value, (F.col(last) if last else F.lit(False)).alias("_last"))

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        current, waiting = state.get if state.exists else (None, [])
        waiting = list(waiting or [])
        out, ended = [], False
        for pdf in frames:
            for o, v, end in sorted(zip(pdf[order], pdf[value], pdf["_last"]), key=lambda r: r[0]):
                if v is not None:
                    out += [(k[0], w, v) for w in waiting]
                    current, waiting = v, []
                if current is None:
                    waiting.append(int(o))
                else:
                    out.append((k[0], o, current))
                ended |= bool(end)
        if ended:
            out += [(k[0], w, None) for w in waiting]
            if state.exists:
                state.remove()
        else:
            state.update((current, waiting))
        yield pd.DataFrame(out, columns=[key, order, value])

    return rows.groupBy(key).applyInPandasWithState(
        step, f"{key} {kt}, {order} {ot}, {value} string", "current string, waiting array<bigint>", "append", GroupStateTimeout.NoTimeout
    )


def windowed_counts(stream: DataFrame, ts: str, by: list[str], size: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Rows per window and group; windows close when ``late`` has passed."""
    w = F.window(ts, size)
    return stream.withWatermark(ts, late).groupBy(w.alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *by, "n")
