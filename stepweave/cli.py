"""Commands: curate, generate, validate, count, show.

    python -m stepweave.cli curate --config curate.yaml
    python -m stepweave.cli validate episodes.jsonl --report report.json
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import functions as F

from stepweave import config
from stepweave.functions import images
from stepweave.operators import align, setops, validate
from stepweave.operators.keys import composite_key
from stepweave.operators.sequences import split_rollup
from stepweave.plans import backends, generation
from stepweave.schemas import ALIGNMENT_METADATA, PROVENANCE
from stepweave.session import build_session, stored
from stepweave.sources import export, lines
from stepweave.sources.annotations import read_annotations
from stepweave.sources.demonstrations import EpisodeReader, read_hdf5, read_tfrecords, splits_of
from stepweave.sources.files import finished_ids, listed

log = logging.getLogger("stepweave")


def setup_logging(level: str = "INFO", file: str | None = None) -> None:
    """Messages of this package alone, to the console and perhaps a file."""
    log.setLevel(level.upper())
    for h in list(log.handlers):
        log.removeHandler(h)
    for h in [logging.StreamHandler()] + ([logging.FileHandler(file)] if file else []):
        h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
        log.addHandler(h)
    log.propagate = False


def _read_split(spark, c: config.DemonstrationConfig, split: str) -> EpisodeReader:
    """The demonstrations of one split, as the settings ask for them."""
    most = None if c.shuffle else c.max_episodes
    if c.source == "hdf5":
        reader = read_hdf5(spark, c.local_path, most)
    elif c.source == "parquet":
        episodes = spark.read.parquet(f"{c.local_path}/episodes")
        if "split" in episodes.columns:
            episodes = episodes.where(F.col("split") == split)
        reader = EpisodeReader(episodes, spark.read.parquet(f"{c.local_path}/steps").join(episodes.select("episode_id"), "episode_id", "left_semi"), max_episodes=most)
    else:
        reader = read_tfrecords(spark, c.local_path, split, most)
    if c.shuffle:
        mixed = [F.xxhash64(F.lit(c.shuffle_seed), "episode_id"), F.col("episode_id")]
        reader = EpisodeReader(reader.episodes, reader.steps, mixed, c.max_episodes)
    steps = reader.steps if c.include_secondary_camera or "image_1" not in reader.steps.columns else reader.steps.withColumn("image_1", F.lit(None).cast("binary"))
    if c.image_size is not None:
        for k in (k for k in steps.columns if k.startswith("image_")):
            steps = steps.withColumn(k, images.sized(F.col(k), *c.image_size))
    reader.episodes, reader.steps = reader.episodes.withColumn("split", F.lit(split)), steps
    return reader


def _demonstrations(spark, c: config.DemonstrationConfig) -> EpisodeReader:
    """The demonstrations of all splits that the settings name; "all" for those of the folder.

    With a cache folder the tables are read once from their source and kept there as Parquet.
    """
    names = splits_of(c.local_path) if c.split == "all" and c.source in ("tfds", "rlds") else c.splits
    readers = []
    for name in names:
        kept = f"{c.cache_dir}/{c.name}/{name}" if c.cache_dir else None
        if kept is None or not listed(f"{kept}/steps"):
            reader = _read_split(spark, c, name)
            if kept is None:
                readers.append(reader)
                continue
            reader.episodes.write.mode("overwrite").parquet(f"{kept}/episodes")
            reader.steps.write.mode("overwrite").parquet(f"{kept}/steps")
        readers.append(EpisodeReader(spark.read.parquet(f"{kept}/episodes"), spark.read.parquet(f"{kept}/steps")))
    first, *rest = readers
    for r in rest:
        first.episodes, first.steps = first.episodes.unionByName(r.episodes, allowMissingColumns=True), first.steps.unionByName(r.steps, allowMissingColumns=True)
    return first


def _about(alignment, c: config.CurationConfig) -> list:
    """The columns that tell how an episode was aligned and where it came from."""
    known = {f: F.col(f) for f in alignment.columns}
    none = lambda t: F.lit(None).cast(t)
    how = F.struct(*[known.get(f.name, none(f.dataType)).cast(f.dataType).alias(f.name) for f in ALIGNMENT_METADATA])
    origin = {"annotation_source": F.lit(c.annotations.name), "demonstration_source": F.lit(c.demonstrations.name), "schema_version": F.lit(c.schema_version)}
    return [how.alias("alignment_metadata"), F.struct(*[origin.get(f.name, none(f.dataType)).cast(f.dataType).alias(f.name) for f in PROVENANCE]).alias("provenance")]


def curate(args) -> int:
    """Matches, aligns, validates and exports; prints the totals per split."""
    c = config.load(args.config, config.CurationConfig)
    spark = build_session("curate")
    notes, note_steps = read_annotations(spark, c.annotations.local_path, c.annotations.require_reasoning, c.annotations.max_episodes)
    demos = _demonstrations(spark, c.demonstrations)
    keyed = demos.episodes.withColumn("join_key", composite_key(F.col("source_file"), F.col("episode_num")))
    matched = stored(align.matched_inner(keyed, notes.select("join_key").distinct()), "matched")
    steps = demos.steps.join(matched.select("episode_id", "join_key", "split", "source_file"), "episode_id")
    out = align.aligned(steps, note_steps.drop("episode_id", "is_first", "is_last"), ["join_key"], "step_index", "reasoning", c.alignment_strategy, {"move_primitive": F.lit("")})
    out = stored(out.withColumn("reasoning", align.clean_trace(F.col("reasoning"))), "aligned")
    if c.validate_output:
        checks = validate.validated(
            matched.select(F.col("episode_id").alias("key"), "episode_id", F.lit(c.schema_version).alias("schema_version"), F.col("language_instruction").alias("task_description"),
                           F.lit(c.alignment_strategy).alias("strategy"), F.lit(0).alias("declared_steps")),
            out.select(F.col("episode_id").alias("key"), "step_index", "is_first", "is_last", "action", F.col("reasoning").isNotNull().alias("has_trace"), F.lit(False).alias("has_image")),
            "key", ["step_index"],
        )
        checks = stored(checks, "checks")
        out = validate.only_passed(out.withColumn("key", F.col("episode_id")), checks, "key").drop("key")
        validate.report(checks).show(truncate=False)
    if c.export_format in ("rlds", "tfrecord"):  # of one size, black where a step has none
        for k in (k for k in out.columns if k in ("image_0", "image_1", "image_2", "image_3")):
            out = out.withColumn(k, images.ensured(F.col(k)))
    if c.save_images:
        out = out.withColumn("image_path", export.image_path(c.image_output_dir, F.col("episode_id"), F.col("step_index"), F.col("image_0")))
    alignment = align.alignment_metadata(out, note_steps.join(matched.select("join_key"), "join_key", "left_semi"), ["join_key"], "reasoning", c.alignment_strategy, c.schema_version)
    about = matched.select("episode_id", "join_key", "split", F.col("language_instruction").alias("task_description")).join(alignment, "join_key", "left")
    about = stored(about.select("episode_id", "split", "task_description", *_about(alignment, c)), "about")
    if c.export_format == "jsonl":
        own = out.select("episode_id", "step_index", "action", "reasoning", "is_first", "is_last", F.lit(c.demonstrations.name).alias("source_dataset"), "alignment_confidence", *[k for k in ("image_path", "state") if k in out.columns])
        written = lines.episode_lines(about.withColumn("schema_version", F.lit(c.schema_version)), own)
        export.write_jsonl(written, c.output_dir)
    nested = stored(export.nested_episodes(out, "episode_id", "step_index", {"split": F.col("split"), "source_file": F.col("source_file")}).join(about.drop("split"), "episode_id", "left"), "nested")
    if c.export_format != "jsonl":
        export.exporter(c.export_format)(nested, c.output_dir)
    if c.save_images:  # after the export, which clears its folder
        log.info("%d images", export.write_images(out, c.image_output_dir).count())
    split_rollup(nested, "split", F.col("has_reasoning")).show()
    return 0


def generate(args) -> int:
    """Annotations from a model for the episodes of a source, appended to the output."""
    c = config.load(args.config, config.GenerationConfig)
    spark = build_session("generate")
    episodes, steps = read_annotations(spark, c.dataset.local_path, c.dataset.require_reasoning, c.dataset.max_episodes)
    done = finished_ids(spark, c.output_dir) if c.resume else None
    backend = backends.create_backend(vars(c.backend))
    s = c.frame_sampling
    image = "image_0" if "image_0" in steps.columns else None
    own = steps.select("episode_id", "step_index", *[image] * bool(image))
    if c.dataset.shuffle:
        episodes = episodes.orderBy(F.xxhash64(F.lit(c.dataset.shuffle_seed), "episode_id"))
    out = generation.generate(
        episodes, own, "episode_id", "step_index", "language_instruction", backend, done, c.resume, c.dry_run, s.strategy, s.num_frames, image, s.keyframe_threshold,
        f"{c.output_dir.rstrip('/')}_errors", c.save_raw_responses, c.per_step,
    )
    if c.dry_run:  # prompts are shown, not kept: nothing counts as done
        out.select("episode_id", "text").show(5, truncate=False)
        return 0
    out.write.mode("append").json(c.output_dir)
    return 0


def check(args) -> int:
    """Validates a file of lines; 1 if an episode fails."""
    spark = build_session("validate")
    episodes, steps = lines.read_episodes(spark, args.path)
    checked = validate.validated(
        episodes.select(F.col("episode_id").alias("key"), "episode_id", "schema_version", "task_description", F.col("alignment_metadata.strategy").alias("strategy"),
                        F.col("alignment_metadata.num_steps_bridge").alias("declared_steps")),
        steps.select(F.col("episode_id").alias("key"), "step_index", "is_first", "is_last", "action", F.col("reasoning").isNotNull().alias("has_trace"), F.col("image_path").isNotNull().alias("has_image")),
        "key", ["step_index"], validate.Rules(args.min_steps, args.min_coverage, args.require_images),
    )
    checked = stored(checked, "checked")
    totals = validate.report(checked)
    totals.show(truncate=False)
    validate.failed(checked).orderBy("key").limit(10).show(truncate=False)
    failures = totals.first()["failed"]
    if args.report:
        export.write_validation(checked, totals, args.report)
    return 1 if failures else 0


def count(args) -> int:
    """How the keys of annotations and demonstrations overlap."""
    spark = build_session("count")
    notes, _ = read_annotations(spark, args.annotations)
    demos = read_tfrecords(spark, args.demonstrations, args.split).episodes.withColumn("join_key", composite_key(F.col("source_file"), F.col("episode_num")))
    setops.overlap_counts(notes, demos, "join_key").show()
    return 0


def show(args) -> int:
    """The first episodes and steps of an annotation file."""
    spark = build_session("show")
    notes, steps = read_annotations(spark, args.path)
    notes.orderBy("episode_id").limit(args.n).show(truncate=40)
    steps.orderBy("episode_id", "step_index").limit(args.n).show(truncate=40)
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="stepweave", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--log-level", default="INFO")
    sub = p.add_subparsers(required=True)
    for name, run in (("curate", curate), ("generate", generate)):
        s = sub.add_parser(name, help=run.__doc__)
        s.add_argument("--config", required=True)
        s.set_defaults(run=run)
    s = sub.add_parser("validate", help=check.__doc__)
    s.add_argument("path")
    s.add_argument("--min-steps", type=int, default=1)
    s.add_argument("--min-coverage", type=float, default=0.0)
    s.add_argument("--require-images", action="store_true")
    s.add_argument("--report")
    s.set_defaults(run=check)
    s = sub.add_parser("count", help=count.__doc__)
    s.add_argument("annotations")
    s.add_argument("demonstrations")
    s.add_argument("--split", default="train")
    s.set_defaults(run=count)
    s = sub.add_parser("show", help=show.__doc__)
    s.add_argument("path")
    s.add_argument("-n", type=int, default=10)
    s.set_defaults(run=show)
    args = p.parse_args(argv)
    setup_logging(args.log_level)
    return args.run(args)


if __name__ == "__main__":
    sys.exit(main())
