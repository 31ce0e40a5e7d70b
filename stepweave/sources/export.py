"""Sinks: nested episodes as Parquet by variant and split, JSON lines, TFRecord, images, reports."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepweave.functions.arrays import cut2, pad7, pad_embedding, pad_state_3d
from stepweave.functions.images import write_png
from stepweave.functions.text import safe_path_part
from stepweave.schemas import SHORT_NAMES
from stepweave.sources import tfrecord

VARIANTS = ("matched", "reasoning_only", "full")


def short_trace(trace: Column) -> Column:
    """The six exported fields under their short names, empty where missing."""
    return F.struct(*[F.coalesce(trace[long], F.lit("")).alias(short) for short, long in SHORT_NAMES.items()])


def has_reasoning(trace: Column) -> Column:
    """Whether any of the six exported fields holds something (stricter than a trace being there)."""
    out = F.lit(False)
    for long in SHORT_NAMES.values():
        out |= F.coalesce(trace[long] != "", F.lit(False))
    return out


def export_step(columns: list[str]) -> Column:
    """The exported struct of a step row; what the row has not gets its default."""
    c = lambda name, default: F.coalesce(F.col(name), default) if name in columns else default
    null = lambda t: F.lit(None).cast(t)
    text = F.lit("")
    images = [c(f"image_{k}", null("binary")).alias(f"image_{k}") for k in range(4)]
    return F.struct(
        F.struct(*images, pad7(c("state", null("array<float>"))).alias("state")).alias("observation"), pad7(c("action", null("array<float>"))).alias("action"),
        c("language_instruction", text).alias("language_instruction"), pad_embedding(c("language_embedding", null("array<float>"))).alias("language_embedding"),
        *[c(k, F.lit(False)).alias(k) for k in ("is_first", "is_last", "is_terminal")],
        c("reward", F.lit(0.0)).cast("float").alias("reward"), c("discount", F.lit(1.0)).cast("float").alias("discount"),
        short_trace(F.col("reasoning")).alias("reasoning"),
        F.struct(
            c("caption", text).alias("caption"), c("move_primitive", text).alias("move_primitive"), cut2(c("gripper_position", null("array<float>"))).alias("gripper_position"),
            c("bboxes", text).alias("bboxes"), pad_state_3d(c("state_3d", null("array<float>"))).alias("state_3d"),
        ).alias("ecot_features"),
        c("alignment_confidence", F.lit(0.0)).cast("float").alias("alignment_confidence"),
    )


def nested_episodes(steps: DataFrame, key: str, order: str, episode: dict[str, Column]) -> DataFrame:
    """One nested row per episode: key, the columns of ``episode`` (first value each), has_reasoning, steps in order.

    An episode is gathered into one row, which is what the format asks for;
    images belong in columns that are joined at this point, not before.
    """
    packed = F.struct(order, export_step(steps.columns).alias("s"))
    firsts = [F.min_by(c, F.col(order)).alias(n) for n, c in episode.items()]
    return steps.groupBy(key).agg(
        *firsts, F.bool_or(has_reasoning(F.col("reasoning"))).alias("has_reasoning"), F.transform(F.array_sort(F.collect_list(packed)), lambda x: x.s).alias("steps")
    )


def variant_rows(episodes: DataFrame, variants: tuple[str, ...] = ("matched", "reasoning_only")) -> DataFrame:
    """A row per variant that an episode belongs to."""
    for v in variants:
        if v not in VARIANTS:
            raise ValueError(f"variant {v!r}; one of {', '.join(VARIANTS)}")
    belongs = F.array_compact(F.array(*[F.when(F.lit(True) if v != "reasoning_only" else F.col("has_reasoning"), F.lit(v)) for v in variants]))
    return episodes.withColumn("variant", F.explode(belongs))


def write_parquet(episodes: DataFrame, path: str, variants: tuple[str, ...] = ("matched", "reasoning_only"), mode: str = "overwrite") -> None:
    """Nested episodes in folders by variant and split."""
    variant_rows(episodes, variants).write.mode(mode).partitionBy("variant", "split").parquet(path)


def export_stats(episodes: DataFrame, split: str = "split") -> DataFrame:
    """One row: total, with_reasoning, without_reasoning, match_rate (4 places, half to even), splits."""
    n, w = F.count("*"), F.count_if("has_reasoning")
    rate = F.coalesce(F.bround(w / F.nullif(n, F.lit(0)), 4), F.lit(0.0))
    return episodes.agg(n.alias("total"), w.alias("with_reasoning"), (n - w).alias("without_reasoning"), rate.alias("match_rate"), F.array_sort(F.collect_set(split)).alias("splits"))


def json_lines(episodes: DataFrame) -> DataFrame:
    """One JSON text per row, with NULL fields kept."""
    return episodes.select(F.to_json(F.struct(*episodes.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_jsonl(episodes: DataFrame, path: str, mode: str = "append") -> None:
    json_lines(episodes).write.mode(mode).text(path)


def image_path(path: str, key: Column, step: Column, image: Column) -> Column:
    """Where :func:`write_images` puts the image of a step; NULL without one."""
    return F.when(F.length(image) > 0, F.concat(F.lit(path.rstrip("/") + "/"), safe_path_part(key), F.format_string("/step_%05d.png", step)))


def write_images(steps: DataFrame, path: str, key: str = "episode_id", image: str = "image_0") -> DataFrame:
    """Writes step_00000.png per step below a folder per episode and gives key, step_index, image_path.

    ``path`` must be a folder that all executors share; existing files stay.
    Rows without image are skipped. Images are PNG already or raw (side, side, 3).
    """

    def save(batches):
        for pdf in batches:
            paths = []
            for folder, step, data in zip(pdf._folder, pdf.step_index, pdf[image]):
                target = os.path.join(path, folder, f"step_{int(step):05d}.png")
                if not os.path.exists(target):
                    os.makedirs(os.path.dirname(target), exist_ok=True)
                    write_png(target, bytes(data))
                paths.append(target)
            yield pdf[[key, "step_index"]].assign(image_path=paths)

    have = steps.where(F.col(image).isNotNull()).select(key, "step_index", safe_path_part(F.col(key)).alias("_folder"), image)
    return have.mapInPandas(save, f"{key} string, step_index int, image_path string")


def example_features(episodes: DataFrame, key: str = "episode_id") -> DataFrame:
    """The feature map of each nested episode: every field of its steps, flattened over the steps, and what describes the episode.

    Vectors have the sizes of the format, missing ones zeros; images are given
    for the cameras that have any, missing ones of these as empty bytes.
    """
    at = F.col("steps")
    nothing = {"bytes": F.lit(None).cast("array<binary>"), "floats": F.lit(None).cast("array<float>"), "ints": F.lit(None).cast("array<bigint>")}
    one = lambda kind, value: F.struct(*[(value if k == kind else v).alias(k) for k, v in nothing.items()])
    texts = lambda get: one("bytes", F.transform(at, lambda s: F.encode(F.coalesce(get(s), F.lit("")), "UTF-8")))
    flags = lambda get: one("ints", F.transform(at, lambda s: F.coalesce(get(s), F.lit(False)).cast("bigint")))
    numbers = lambda get: one("floats", F.transform(at, lambda s: get(s).cast("float")))

    def vectors(get, size: int) -> Column:
        zeros = F.array_repeat(F.lit(0.0).cast("float"), size)
        return one("floats", F.flatten(F.transform(at, lambda s: F.slice(F.concat(F.coalesce(get(s), zeros), zeros), 1, size))))

    field = lambda *path: lambda s: s[path[0]] if len(path) == 1 else s[path[0]][path[1]]
    named = {
        "steps/observation/state": vectors(lambda s: s["observation"]["state"], 7), "steps/action": vectors(lambda s: s["action"], 7),
        "steps/language_instruction": texts(lambda s: s["language_instruction"]), "steps/language_embedding": vectors(lambda s: s["language_embedding"], 512),
        **{f"steps/{k}": flags(field(k)) for k in ("is_first", "is_last", "is_terminal")},
        **{f"steps/{k}": numbers(field(k)) for k in ("reward", "discount", "alignment_confidence")},
        **{f"steps/reasoning/{k}": texts(field("reasoning", k)) for k in SHORT_NAMES},
        **{f"steps/ecot_features/{k}": texts(field("ecot_features", k)) for k in ("caption", "move_primitive", "bboxes")},
        "steps/ecot_features/gripper_position": vectors(lambda s: s["ecot_features"]["gripper_position"], 2),
        "steps/ecot_features/state_3d": vectors(lambda s: s["ecot_features"]["state_3d"], 3),
    }
    path = F.col("source_file") if "source_file" in episodes.columns else F.col(key).cast("string")
    number = F.col("episode_num") if "episode_num" in episodes.columns else F.lit(None)
    named["episode_metadata/file_path"] = one("bytes", F.array(F.encode(F.coalesce(path, F.lit("")), "UTF-8")))
    named["episode_metadata/episode_id"] = one("ints", F.array(F.coalesce(number.cast("bigint"), F.lit(-1).cast("bigint"))))
    named["episode_metadata/has_language"] = one("ints", F.array(F.exists(at, lambda s: F.coalesce(s["language_instruction"] != "", F.lit(False))).cast("bigint")))
    entries = [F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in named.items()]
    for k in range(4):
        image = field("observation", f"image_{k}")
        seen = F.exists(F.transform(at, image), lambda x: F.coalesce(F.length(x) > 0, F.lit(False)))
        images = one("bytes", F.transform(F.transform(at, image), lambda x: F.coalesce(x, F.lit(b""))))
        entries.append(F.struct(F.lit(f"episode_metadata/has_image_{k}").alias("key"), one("ints", F.array(seen.cast("bigint"))).alias("value")))
        entries.append(F.when(seen, F.struct(F.lit(f"steps/observation/image_{k}").alias("key"), images.alias("value"))))
    return episodes.select(F.map_from_entries(F.array_compact(F.array(*entries))).alias("features"))


def write_tfrecord(episodes: DataFrame, path: str, key: str = "episode_id", name: str = "data") -> None:
    """Nested episodes as one tf.Example each, in files by split (train where the episodes name none)."""
    tfrecord.register(episodes.sparkSession)
    splits = [r[0] for r in episodes.select("split").distinct().collect()] if "split" in episodes.columns else [None]
    for split in splits:
        own = episodes.where(F.col("split").eqNullSafe(F.lit(split))) if "split" in episodes.columns else episodes
        example_features(own, key).write.format("tfrecord").option("name", f"{name}-{split or 'train'}").mode("append").save(path)


def write_summary(row: dict, path: str) -> None:
    """A one-row result as a JSON file."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(row, f, ensure_ascii=False, indent=2, default=str)


def write_validation(checked: DataFrame, totals: DataFrame, path: str) -> int:
    """The report with all failures as JSON, written as they arrive and never held together; the number of failed episodes."""
    head = totals.first().asDict()
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(json.dumps(head, ensure_ascii=False, indent=2, default=str)[:-2] + ',\n  "failures": [')
        for i, r in enumerate(checked.where("not passed").toLocalIterator(prefetchPartitions=True)):
            f.write((",\n    " if i else "\n    ") + json.dumps(r.asDict(recursive=True), ensure_ascii=False, default=str))
        f.write("\n  ]\n}\n")
    return int(head["failed"])


def exporter(fmt: str):
    """The writer of a format: parquet (nested, by variant), jsonl, tfrecord."""
    known = {"parquet": write_parquet, "rlds": write_parquet, "jsonl": write_jsonl, "tfrecord": write_tfrecord}
    if fmt == "hdf5":
        raise NotImplementedError("writing HDF5 is not offered")
    if fmt not in known:
        raise ValueError(f"export format {fmt!r}; one of {', '.join(sorted(known))}")
    return known[fmt]
