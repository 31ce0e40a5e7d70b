"""Readers of demonstrations: one contract for Parquet tables, TFRecord folders and HDF5 files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepweave.sources import tfrecord
from stepweave.sources.files import data_files, version_dir


class EpisodeReader:
    """Lazy episodes and steps; everything is a plan until an action runs it."""

    def __init__(self, episodes: DataFrame, steps: DataFrame, order: list[str] | None = None, max_episodes: int | None = None) -> None:
        order = order or ["episode_id"]
        self.episodes = episodes.orderBy(*order).limit(max_episodes) if max_episodes is not None else episodes
        self.steps = steps.join(self.episodes.select("episode_id"), "episode_id", "left_semi") if max_episodes is not None else steps
        self.order = order

    def take(self, n: int) -> DataFrame:
        """The first ``n`` episodes in order; none for n below 1."""
        return self.episodes.orderBy(*self.order).limit(max(0, n))

    def __len__(self) -> int:
        return self.episodes.count()

    def info(self) -> dict:
        return {"episodes": len(self), "columns": self.episodes.columns, "step_columns": self.steps.columns}

    def load(self, wanted: str) -> DataFrame:
        """The episode of that id or source file; the filter reaches the scan."""
        same = F.col("episode_id") == wanted
        if "source_file" in self.episodes.columns:
            same |= F.col("source_file") == wanted
        return self.episodes.where(same).limit(1)

    def ids(self) -> DataFrame:
        return self.episodes.select("episode_id")


def read_tfrecords(spark: SparkSession, base: str, split: str = "train", max_episodes: int | None = None) -> EpisodeReader:
    """Demonstrations of a versioned dataset folder; with a limit, records are taken in file order."""
    tfrecord.register(spark)
    folder = version_dir(base)
    source = spark.read.format("tfrecord").option("split", split)
    counts = spark.read.format("tfrecord").option("split", split).option("heads", "true").load(folder).select("file", "place")
    return EpisodeReader(*tfrecord.demonstrations(tfrecord.numbered(source.load(folder), counts)), order=["record_number", "episode_id"], max_episodes=max_episodes)


def splits_of(base: str) -> list[str]:
    """Names of the splits of a versioned dataset folder."""
    names = [n for n in (p.rsplit("/", 1)[-1] for p in data_files(version_dir(base), "")) if ".tfrecord" in n]
    return sorted({n.split(".tfrecord")[0].rsplit("-", 1)[-1] for n in names}) or ["train"]


def of_files(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(episodes, steps) of rows that hold one file each: path, language_instruction, actions, state, images0, images1.

    A file has as many steps as actions, else as first images. Its name without
    ending is the episode's id; steps default to action zeros, reward 0 and
    discount 1.
    """
    size = lambda c: F.coalesce(F.nullif(F.size(c), F.lit(-1)), F.lit(0))
    n = F.when(size("actions") > 0, size("actions")).otherwise(size("images0"))
    named = rows.withColumn("episode_id", F.regexp_extract("path", r"([^/\\]*?)(?:\.[^./\\]*)?$", 1)).withColumn("n_steps", n)
    episodes = named.select("episode_id", F.col("path").alias("source_file"), F.lit(None).cast("int").alias("episode_num"), "language_instruction", "n_steps")
    i = F.col("step_index")
    steps = named.where("n_steps > 0").withColumn("step_index", F.explode(F.sequence(F.lit(0), F.col("n_steps") - 1))).select(
        "episode_id", F.lit(None).cast("int").alias("episode_num"), "step_index", *[F.get(f"images{k}", i).alias(f"image_{k}") for k in (0, 1)],
        *[F.lit(None).cast("binary").alias(f"image_{k}") for k in (2, 3)], F.get("state", i).alias("state"),
        F.coalesce(F.get("actions", i), F.array_repeat(F.lit(0.0).cast("float"), 7)).alias("action"), "language_instruction", F.lit(None).cast("array<float>").alias("language_embedding"),
        (i == 0).alias("is_first"), (i == F.col("n_steps") - 1).alias("is_last"), F.lit(False).alias("is_terminal"), F.lit(0.0).alias("reward"), F.lit(1.0).alias("discount"),
    )
    return episodes, steps


def read_hdf5(spark: SparkSession, base: str, max_episodes: int | None = None) -> EpisodeReader:
    """Demonstrations of a folder with one HDF5 file per episode, in file order. Needs h5py on the executors."""
    try:
        import h5py  # noqa: F401
    except ImportError as e:
        raise NotImplementedError("reading HDF5 needs the package h5py") from e

    def load(batches):
        import io

        import h5py
        import numpy as np
        import pandas as pd

        for pdf in batches:
            out = []
            for path, content in zip(pdf.path, pdf.content):
                with h5py.File(io.BytesIO(content)) as f:
                    attrs = {**f.attrs}
                    text = attrs.get("lang", attrs.get("language_instruction", ""))
                    seen = f["obs"] if "obs" in f else f
                    vectors = lambda of, k: [np.asarray(r, np.float32).ravel().tolist() for r in of[k]] if k in of else []
                    images = lambda k: [np.asarray(r, np.uint8).tobytes() for r in seen[k]] if k in seen else []
                    out.append((path, text.decode() if isinstance(text, bytes) else str(text), vectors(f, "actions"), vectors(seen, "state"), images("images0"), images("images1")))
            yield pd.DataFrame(out, columns=["path", "language_instruction", "actions", "state", "images0", "images1"])

    files = data_files(base, ".hdf5", ".h5")
    ddl = "path string, language_instruction string, actions array<array<float>>, state array<array<float>>, images0 array<binary>, images1 array<binary>"
    rows = spark.read.format("binaryFile").load(files).select("path", "content").mapInPandas(load, ddl)
    return EpisodeReader(*of_files(rows), order=["source_file"], max_episodes=max_episodes)
