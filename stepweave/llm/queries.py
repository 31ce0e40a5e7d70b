"""Queries of the operators for training data, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepweave.llm import dedupe, instructions, mixing, overlap, packing, pairs, runs, splits, tokens, toxicity
from stepweave.operators.skew import lookup
from stepweave.session import new_folder, ship, stored

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.broken_pairs(_table(spark, sf, "generation_results"), _table(spark, sf, "prompts"))


def p1_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Answers and defects per model and finish reason."""
    results = _table(spark, sf, "generation_results").groupBy("result_id").agg(
        F.min("model").alias("model"), F.min(F.lower("finish_reason")).alias("finish_reason")
    )
    judged = results.join(p1_found(spark, sf), "result_id", "left")
    return judged.groupBy("model", "finish_reason", F.coalesce("defect", F.lit("none")).alias("defect")).agg(F.count("*").alias("answers"))


def _episode_links(spark: SparkSession, sf: str) -> DataFrame:
    ep = _table(spark, sf, "episodes")
    return ep.select(
        "episode_key", splits.session_of(F.col("episode_metadata.file_path")).alias("session"),
        F.when(F.col("episode_metadata.episode_id") != -1, F.col("episode_metadata.episode_id")).alias("known_id"),
        F.coalesce(F.datediff("ingested_at", "recorded_at") > 7, F.lit(False)).alias("late"),
    )


def _split_table(spark: SparkSession, sf: str) -> splits.SplitTable:
    """All episodes in two batches: what was delivered within a week of its recording, then what came late."""
    table = splits.SplitTable(spark, new_folder(spark, "splits"), buckets=max(16, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    links, targets = stored(_episode_links(spark, sf), "episode_links"), _table(spark, sf, "split_targets")
    for late in (False, True):
        table.add(links.where(F.col("late") == F.lit(late)), "episode_key", ["session", "known_id"], targets)
    return table


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    members = stored(_split_table(spark, sf).members().select(F.col("id").cast("long").alias("id"), "component"), "members")
    heads = members.groupBy("component").agg(F.min("id").alias("head"))
    return lookup(members, stored(heads, "group_heads"), ["component"], "id").where("id <> head").select(F.col("head").alias("head_key"), F.col("id").alias("member_key"))


def p2_splits(spark: SparkSession, sf: str) -> DataFrame:
    return _split_table(spark, sf).members().select(F.col("id").cast("long").alias("episode_key"), "component", "split")


def p2_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Late episodes that would have tied components of different splits together, with their session and known id."""
    barred = p2_splits(spark, sf).where(F.col("split") == splits.QUARANTINE).select("episode_key", "component")
    links = _episode_links(spark, sf).groupBy("episode_key").agg(F.min("session").alias("session"), F.min("known_id").alias("known_id"))
    return barred.join(links, "episode_key")


def p2_apart(spark: SparkSession, sf: str) -> DataFrame:
    """How many sessions and known ids have episodes in more than one split, what is quarantined aside: none may."""
    links = _episode_links(spark, sf).select("episode_key", F.explode(F.array(F.concat(F.lit("s:"), "session"), F.concat(F.lit("i:"), F.col("known_id").cast("string")))).alias("value"))
    given = p2_splits(spark, sf).where(F.col("split") != splits.QUARANTINE)
    per = links.where("value is not null").join(given, "episode_key").groupBy("value").agg(F.min("split").alias("lo"), F.max("split").alias("hi"))
    return per.agg(F.count_if(F.col("lo") != F.col("hi")).alias("apart"))


def _split_texts(spark: SparkSession, sf: str) -> DataFrame:
    ep = _table(spark, sf, "episodes").where("split in ('train', 'val', 'test')").groupBy("episode_key").agg(
        F.min("split").alias("split"), F.min("episode_metadata.file_path").alias("path")
    )
    text = instructions.first_instruction(_table(spark, sf, "steps")).withColumnRenamed("episode_key", "id")
    return text.join(ep, text.id == ep.episode_key).select(
        "id", "split", F.when(F.col("split") == "train", "train").otherwise("eval").alias("side"), "text",
        F.split_part(splits.session_of(F.col("path")), F.lit("/"), F.lit(1)).alias("source"),
    )


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    pairs = overlap.expanded(*overlap.near_links(_split_texts(spark, sf)))
    return pairs.select(F.least("train_id", "eval_id").alias("key_a"), F.greatest("train_id", "eval_id").alias("key_b"))


def p3_report(spark: SparkSession, sf: str) -> DataFrame:
    texts = _split_texts(spark, sf)
    return overlap.overlap_report(texts, *overlap.near_links(texts))


def _writing(spark: SparkSession, sf: str) -> DataFrame:
    steps = dedupe.writing_groups(instructions.first_instruction(_table(spark, sf, "steps")), "episode_key", "text")
    meta = dedupe.writing_groups(_table(spark, sf, "metadata_records"), "record_id", "metadata", "record")
    return steps.withColumn("origin", F.lit("steps")).unionByName(meta.withColumn("origin", F.lit("metadata")))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return _writing(spark, sf).where("id <> keep_id").select("origin", "keep_id", F.col("id").alias("copy_id"))


def p4_collapsed(spark: SparkSession, sf: str) -> DataFrame:
    return _writing(spark, sf).groupBy("origin", "keep_id").agg(F.count("*").alias("copies"))


def _move_runs(spark: SparkSession, sf: str, min_len: int) -> DataFrame:
    steps = _table(spark, sf, "steps").select("episode_key", "step_index", "recorded_at", F.col("ecot_features.move_primitive").alias("move"))
    return runs.collapse_runs(steps, "episode_key", "step_index", "move", "recorded_at", min_len)


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return _move_runs(spark, sf, 2).select(
        F.col("entity").alias("episode_key"), F.col("start").cast("int").alias("start_step"), F.col("end").cast("int").alias("end_step")
    )


def p6_collapsed(spark: SparkSession, sf: str) -> DataFrame:
    return _move_runs(spark, sf, 1).select(
        F.col("entity").alias("episode_key"), F.col("start").cast("int").alias("start_step"), "label", F.col("n").alias("n_steps"),
        F.round("duration_s", 6).alias("duration_s"),
    )


def _sized(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "source", tokens.token_count(F.col("text")).alias("tokens"))


#: Limits on segments and on the share of loss-bearing tokens in the packs of documents, and of prompts with their answers.
DOC_LIMITS, PAIR_LIMITS = {"max_segments": 256, "max_loss_share": 1.0}, {"max_segments": 64, "max_loss_share": 0.75}


def p8_packs(spark: SparkSession, sf: str) -> DataFrame:
    items = _sized(spark, sf).withColumn("loss", F.greatest(F.col("tokens") - 1, F.lit(0)))
    return packing.packed(items, _table(spark, sf, "pack_sizes"), **DOC_LIMITS).withColumnRenamed("id", "doc_id")


def p8_fill(spark: SparkSession, sf: str) -> DataFrame:
    return packing.fill_report(p8_packs(spark, sf).withColumnRenamed("doc_id", "id"))


def p8_pair_packs(spark: SparkSession, sf: str) -> DataFrame:
    """Prompt and response pairs, of which the response bears loss, at most 64 to a pack."""
    prompts = _table(spark, sf, "prompts").groupBy("prompt_id").agg(F.min("text").alias("ask"))
    answers = _table(spark, sf, "generation_results").groupBy("result_id").agg(F.min(F.struct("prompt_id", "text")).alias("r"))
    pairs = answers.select("result_id", "r.*").join(prompts, "prompt_id", "left")
    loss = tokens.token_count(F.col("text"))
    items = pairs.select(F.col("result_id").alias("id"), loss.alias("loss"), tokens.token_count(F.col("ask")).alias("ask"))
    items = items.select("id", (F.col("loss") + F.col("ask")).alias("tokens"), "loss")
    return packing.packed(items, _table(spark, sf, "pack_sizes"), **PAIR_LIMITS).withColumnRenamed("id", "result_id")


def p8_over(spark: SparkSession, sf: str) -> DataFrame:
    """How many packs of each kind go beyond a limit: none may."""
    docs = packing.violations(p8_packs(spark, sf), **DOC_LIMITS).withColumn("kind", F.lit("documents"))
    pairs_ = packing.violations(p8_pair_packs(spark, sf), **PAIR_LIMITS).withColumn("kind", F.lit("pairs"))
    return docs.unionByName(pairs_).groupBy("kind", "pack_name").agg(F.sum("over").alias("over"))


def p9_mix(spark: SparkSession, sf: str) -> DataFrame:
    mix, _ = mixing.mixed(_sized(spark, sf), _table(spark, sf, "mix_targets"))
    return mix.withColumnRenamed("id", "doc_id")


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixed(_sized(spark, sf), _table(spark, sf, "mix_targets"))[1]


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.with_kind(toxicity.scored(_table(spark, sf, "documents"), "doc_id", "text", ["source"]))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).where("kind is not null").select("doc_id", "kind").distinct()


def p10_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf)


def p10_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, flagged documents by kind and mean scores per source."""
    counts = [F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in toxicity.KINDS]
    means = [F.round(F.avg(k), 6).alias(f"mean_{k}") for k in toxicity.KINDS]
    rate = F.round(F.count("kind") / F.count("*"), 6).alias("rate")
    return _scored(spark, sf).groupBy("source").agg(F.count("*").alias("documents"), *counts, rate, *means)


def queries() -> dict[str, Query]:
    own = (
        p1_found, p1_rates, p2_found, p2_splits, p2_quarantine, p2_apart, p3_found, p3_report, p4_found, p4_collapsed, p6_found, p6_collapsed, p8_packs, p8_fill, p8_pair_packs, p8_over, p9_mix, p9_shares,
        p10_found, p10_scores, p10_rates,
    )
    return {f.__name__: f for f in own}
