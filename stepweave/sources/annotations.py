"""Nested annotation files as episodes and dense steps."""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stepweave.functions.text import or_default
from stepweave.operators.keys import composite_key
from stepweave.schemas import SHORT_NAMES, TRACE_FIELDS
from stepweave.session import new_folder
from stepweave.sources.files import file_system, find_json

#: A larger annotation file is split into lines before it is parsed.
SPLIT_BYTES = 64_000_000


def _get(value: Column, path: str, kind: str) -> Column:
    """A part of a variant; NULL where it is missing or of another kind."""
    return F.try_variant_get(value, path, kind)


def _is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def trace_of(reasoning: Column) -> Column:
    """A trace from the six short fields, missing ones empty; NULL for what is no object or has none of them."""
    short = {k: _get(reasoning, f"$.{k}", "string") for k in SHORT_NAMES}
    text = {SHORT_NAMES[k]: F.coalesce(v, F.lit("")) for k, v in short.items()}
    fields = [text.get(f, F.lit(None).cast("string")).alias(f) for f in TRACE_FIELDS]
    return F.when(_is_object(reasoning) & F.coalesce(*short.values()).isNotNull(), F.struct(*fields))


def step_count(declared: Column, reasoning: Column) -> Column:
    """The declared number of steps, else that of reasoning entries, else 1; 0 counts as not declared."""
    return F.coalesce(F.nullif(declared, F.lit(0)), F.nullif(F.size(reasoning), F.lit(0)), F.lit(1))


def flat_episodes(entries: DataFrame, source: str = "embodied_features_bridge") -> DataFrame:
    """One row per episode of ``entries`` (file_path, source_episode_id, entry); entries that are no object are skipped."""
    e = F.col("entry")
    eps = entries.where(_is_object(e)).withColumn("reasoning_map", F.coalesce(_get(e, "$.reasoning", "map<string,variant>"), F.create_map().cast("map<string,variant>")))
    return eps.select(
        F.concat("file_path", F.lit("_"), "source_episode_id").alias("episode_id"), "file_path", "source_episode_id",
        composite_key(F.col("file_path"), F.col("source_episode_id")).alias("join_key"),
        F.coalesce(_get(e, "$.metadata.language_instruction", "string"), F.lit("")).alias("language_instruction"),
        step_count(_get(e, "$.metadata.n_steps", "int"), F.col("reasoning_map")).alias("n_steps"),
        F.coalesce(_get(e, "$.metadata.caption", "string"), F.lit("")).alias("caption"), F.lit(source).alias("source_dataset"), "entry", "reasoning_map",
    )


def flat_steps(episodes: DataFrame) -> DataFrame:
    """Dense steps 0..n_steps-1 of :func:`flat_episodes`; features by place, reasoning by its key."""
    e, i = F.col("entry"), F.col("step_index")
    listed = lambda name: _get(e, f"$.features.{name}", "array<variant>")
    gripper = F.when(F.size(listed("gripper_position")) > 0, listed("gripper_position")).otherwise(listed("gripper_positions"))
    wide = episodes.select(
        "episode_id", "join_key", "n_steps", "reasoning_map", listed("move_primitive").alias("moves"), gripper.alias("grips"), listed("bboxes").alias("boxes"), listed("state_3d").alias("states")
    )
    steps = wide.where("n_steps > 0").withColumn("step_index", F.explode(F.sequence(F.lit(0), F.col("n_steps") - 1)))
    return steps.select(
        "episode_id", "join_key", "step_index", trace_of(F.try_element_at("reasoning_map", i.cast("string"))).alias("reasoning"),
        (i == 0).alias("is_first"), (i == F.col("n_steps") - 1).alias("is_last"), _get(F.get("moves", i), "$", "string").alias("move_primitive"),
        F.slice(_get(F.get("grips", i), "$", "array<float>"), 1, 2).alias("gripper_position"), F.to_json(F.get("boxes", i)).alias("bboxes"),
        F.slice(_get(F.get("states", i), "$", "array<float>"), 1, 3).alias("state_3d"),
    )


def _children(value: Column, *names: str) -> Column:
    return F.explode(_get(value, "$", "map<string,variant>")).alias(*names)


def entries_of_bodies(bodies: DataFrame, path: str = "file_path", body: str = "body") -> DataFrame:
    """Entries of bodies that map episode id to entry; a body that isn't valid JSON gives none."""
    parsed = bodies.select(F.coalesce(F.col(path), F.lit("")).alias("file_path"), F.try_parse_json(body).alias("_v")).where(_is_object(F.col("_v")))
    return parsed.select("file_path", _children(F.col("_v"), "source_episode_id", "entry"))


def entries_of_file(documents: DataFrame, text: str = "value") -> DataFrame:
    """Entries of documents that map file path to episode id to entry; what is no object is skipped."""
    files = documents.select(F.try_parse_json(text).alias("_v")).where(_is_object(F.col("_v"))).select(_children(F.col("_v"), "file_path", "_e"))
    return files.where(_is_object(F.col("_e"))).select("file_path", _children(F.col("_e"), "source_episode_id", "entry"))


_OUTSIDE, _INSIDE = re.compile(r'["{}\[\],]'), re.compile(r'["\\]')


def split_entries(chunks: Iterable[str]) -> Iterator[tuple[str, str, str]]:
    """(file path, episode id, entry as JSON text) of a document that maps path to id to entry, read chunk by chunk.

    Only the entry at hand is held. Values on the two upper levels that are no
    object give nothing; a document that breaks off gives what came before.
    """
    opened: list[str] = []  # brackets that are open
    keys = ["", ""]
    held: list[str] = []  # what was read of the key or entry at hand
    holding = None
    key_next = quoted = escaped = False
    for chunk in chunks:
        at = start = 0
        while at < len(chunk):
            if escaped:
                at, escaped = at + 1, False
                continue
            m = (_INSIDE if quoted else _OUTSIDE).search(chunk, at)
            if m is None:
                break
            ch, at = m.group(), m.end()
            if quoted:
                escaped, quoted = ch == "\\", ch == "\\"
                if not quoted and holding == "key":
                    keys[len(opened) - 1] = json.loads("".join([*held, chunk[start:at]]), strict=False)
                    held, holding, key_next = [], None, False
            elif ch == '"':
                quoted = True
                if key_next:
                    holding, start = "key", m.start()
            elif ch in "{[":
                opened.append(ch)
                upper = holding is None and all(x == "{" for x in opened)
                key_next = upper and len(opened) < 3
                if upper and len(opened) == 3:
                    holding, start = "entry", m.start()
            elif ch == ",":
                key_next = holding is None and 0 < len(opened) < 3 and all(x == "{" for x in opened)
            else:
                if holding == "entry" and len(opened) == 3:
                    yield keys[0], keys[1], "".join([*held, chunk[start:at]])
                    held, holding = [], None
                opened, key_next = opened[:-1], False
        if holding:
            held.append(chunk[start:])


def split_file(path: str, out: str, lines_per_part: int = 20_000, chunk: int = 1 << 22) -> int:
    """Writes the entries of one huge annotation file as parts of JSON lines, which many tasks can read; the number of entries.

    One pass over the file, in memory for one entry and one chunk.
    """
    source, inner = file_system(path)
    target, folder = file_system(out)
    target.create_dir(folder, recursive=True)
    n, part = 0, None
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    with source.open_input_stream(inner) as f:
        pieces = iter(lambda: f.read(chunk), b"")
        for file_path, episode, entry in split_entries(decoder.decode(p) for p in pieces):
            if n % lines_per_part == 0:
                if part is not None:
                    part.close()
                part = target.open_output_stream(f"{folder}/part-{n // lines_per_part:05d}.jsonl")
            line = json.dumps({"file_path": file_path, "source_episode_id": episode, "entry": entry}, ensure_ascii=False)
            part.write(line.encode() + b"\n")
            n += 1
    if part is not None:
        part.close()
    return n


def entries_of_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """Entries of lines that :func:`split_file` has written."""
    row = F.from_json(text, "file_path string, source_episode_id string, entry string")
    rows = lines.select(row.alias("r")).select("r.file_path", "r.source_episode_id", F.try_parse_json("r.entry").alias("entry"))
    return rows.where("file_path is not null and source_episode_id is not null")


def row_numbers(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` of files with their place in reading order, dense from 0: partitions are counted first, and no row moves."""
    place = F.monotonically_increasing_id()
    numbered = rows.withColumn("_at", place)
    part = F.shiftright("_at", 33)
    counts = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # One row a partition of the scan.
    before = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.col("_at") - F.shiftleft(F.col("_part"), 33)
    return numbered.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + inside).drop("_at", "_part", "_before")


def entries_of_rows(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a dataset with one row per episode, Parquet or JSON lines: file path and id are both the row's number."""
    if path.rstrip("/").endswith((".jsonl", ".json", ".ndjson")):
        rows = spark.read.text(path).where(F.trim("value") != "").select(F.try_parse_json("value").alias("entry"))
    else:
        table = spark.read.parquet(path)
        rows = table.select(F.to_variant_object(F.struct(*table.columns)).alias("entry"))
    numbered = row_numbers(rows, "_row")
    return numbered.select(F.col("_row").cast("string").alias("file_path"), F.col("_row").cast("string").alias("source_episode_id"), "entry")


def read_annotations(spark: SparkSession, path: str, require_reasoning: bool = False, max_episodes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(episodes, steps) of an annotation file or of the first one in a folder.

    With ``require_reasoning`` only episodes with at least one trace count,
    also towards ``max_episodes`` (in order of path and id). A file of more than
    SPLIT_BYTES, or one that ends in .jsonl, is read as lines, split before
    (:func:`split_file`) into the shared folder; a smaller one is one document.
    """
    if path.endswith(".jsonl"):
        entries = entries_of_lines(spark.read.text(path))
    else:
        found = find_json(path)
        where, inner = file_system(found)
        if where.get_file_info(inner).size > SPLIT_BYTES:
            parts = new_folder(spark, "annotation_lines")
            split_file(found, parts)
            entries = entries_of_lines(spark.read.text(parts))
        else:
            entries = entries_of_file(spark.read.text(found, wholetext=True))
    episodes = flat_episodes(entries)
    if require_reasoning:
        episodes = episodes.where(F.exists(F.map_values("reasoning_map"), lambda r: trace_of(r).isNotNull()))
    if max_episodes is not None:
        episodes = episodes.orderBy("file_path", "source_episode_id").limit(max_episodes)
    return episodes.drop("entry", "reasoning_map"), flat_steps(episodes)


def task_text(demonstration: Column, annotation: Column) -> Column:
    """The demonstration's instruction, else the annotation's; empty ones fall through."""
    return F.coalesce(or_default(demonstration, annotation), F.lit(""))
