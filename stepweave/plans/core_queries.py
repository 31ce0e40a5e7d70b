"""Queries of the curation operators on the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepweave.functions import arrays, reply, text
from stepweave.functions.reply import parsed_reply
from stepweave.operators import align, keys, sampling, sequences, setops, validate
from stepweave.plans import generation
from stepweave.plans.backends import MockBackend
from stepweave.plans.tables import annotation_episodes, annotation_steps, demo_episodes, demo_steps, event_steps, table
from stepweave.sources.annotations import task_text
from stepweave.sources.demonstrations import EpisodeReader
from stepweave.sources.export import export_step, has_reasoning

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


def _joined(c: str) -> Column:
    return F.array_join(F.col(c).cast("array<string>"), ",").alias(c)


def _finite(c: Column, places: int = 6) -> Column:
    d = c.cast("double")
    return F.round(F.when(~F.isnan(d) & (F.abs(d) < 1e30), d), places)


# --- alignment over events -------------------------------------------------------------------------------------------


def _align(spark: SparkSession, sf: str, strategy: str) -> DataFrame:
    out = align.filled(event_steps(spark, sf), ["user_id"], "step_index", "task", strategy)
    return out.select("user_id", F.col("step_index").cast("long").alias("step_index"), "task", "alignment_confidence")


def align_nearest(spark, sf):
    return _align(spark, sf, "nearest")


def align_exact(spark, sf):
    return _align(spark, sf, "exact")


def align_broadcast(spark, sf):
    return _align(spark, sf, "broadcast")


def confidence_hist(spark, sf):
    return _align(spark, sf, "nearest").groupBy(align.confidence_band(F.col("alignment_confidence")).alias("band")).agg(F.count("*").alias("steps"))


def dedupe_last_wins(spark, sf):
    e = table(spark, sf, "events")
    return keys.last_wins(e, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id", "value")


def coverage_by_user(spark, sf):
    return sequences.coverage(event_steps(spark, sf), ["user_id"], "task")


def trace_quality(spark, sf):
    d = table(spark, sf, "documents").select(F.struct("title", "editor", "edit_note").alias("trace"))
    return sequences.trace_quality(d, "trace", ("title", "editor", "edit_note"))


def phase_segments(spark, sf):
    return sequences.phases(event_steps(spark, sf), "user_id", "step_index", F.col("value") > 20).select(
        "user_id", F.col("phase").cast("long").alias("phase"), F.col("on").alias("above"), F.col("start").cast("long").alias("start_pos"), F.col("end").cast("long").alias("end_pos"), "n"
    )


def context3(spark, sf):
    out = sequences.context(event_steps(spark, sf), "user_id", "step_index", "event_type", 3)
    return out.select("user_id", F.col("step_index").cast("long").alias("step_index"), _joined("context"))


def limit_after_filter(spark, sf):
    per = event_steps(spark, sf).groupBy("user_id").agg(F.count("*").alias("steps"), F.max(F.col("task").isNotNull()).alias("annotated"))
    return EpisodeReader(per.where("annotated").select(F.col("user_id").alias("episode_id"), "steps"), per.select(F.col("user_id").alias("episode_id"))).take(20).withColumnRenamed("episode_id", "user_id")


def resume_anti(spark, sf):
    e = table(spark, sf, "events")
    rest = setops.not_done(e, e.where("event_type = 'purchase' and value > 200"), "user_id")
    return rest.groupBy("user_id").agg(F.count("*").alias("events"))


def json_props(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


# --- matching and sets -----------------------------------------------------------------------------------------------


def match_inner(spark, sf):
    o = table(spark, sf, "orders").withColumnRenamed("o_custkey", "join_key")
    c = table(spark, sf, "customer").withColumnRenamed("c_custkey", "join_key")
    return align.matched_inner(o, c.select("join_key", "c_name")).select("o_orderkey", "join_key", "c_name")


def match_left_full(spark, sf):
    c = table(spark, sf, "customer").withColumnRenamed("c_custkey", "join_key").select("join_key", "c_name")
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("join_key")).agg(F.count("*").alias("n_orders"))
    return align.matched_all(c, o).select("join_key", "c_name", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


def unmatched_anti(spark, sf):
    c = table(spark, sf, "customer").withColumnRenamed("c_custkey", "join_key").select("join_key", "c_name")
    return align.unmatched(c, table(spark, sf, "orders").where("o_orderstatus = 'P' and o_orderpriority like '1%'").select(F.col("o_custkey").alias("join_key")))


def match_counts(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("join_key"))
    return align.match_counts(c, table(spark, sf, "orders").select(F.col("o_custkey").alias("join_key")))


def key_overlap(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("key"))
    return setops.overlap_counts(e, table(spark, sf, "customer").select(F.col("c_custkey").alias("key")), "key")


def keys_union(spark, sf):
    o = table(spark, sf, "orders")
    return setops.union_keys(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'P'"), key="o_custkey")


def keys_common(spark, sf):
    o = table(spark, sf, "orders")
    return setops.common_keys(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'P'"), "o_custkey")


def keys_except(spark, sf):
    o = table(spark, sf, "orders")
    return setops.other_keys(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'P'"), "o_custkey")


def match_demo_annotations(spark, sf):
    a = annotation_episodes(spark, sf).select("join_key", F.col("file_path").alias("note_path")).groupBy("join_key").agg(F.count("*").alias("notes"))
    return align.matched_inner(demo_episodes(spark, sf), a).select("episode_key", "join_key", "notes")


def match_key_or_path(spark, sf):
    demos = demo_episodes(spark, sf).select("episode_key", "join_key", "path_key")
    a = annotation_episodes(spark, sf).select("join_key", keys.normalized_path(F.col("file_path")).alias("path_key"))
    return align.matched_or_path(a, demos, "join_key", "path_key", ["episode_key"], [F.col("episode_key")]).select("join_key", "episode_key", "matched_by")


def demo_key_overlap(spark, sf):
    return setops.overlap_counts(annotation_episodes(spark, sf), demo_episodes(spark, sf), "join_key")


def composite_key(spark, sf):
    return demo_episodes(spark, sf).select("episode_key", "path_key", "join_key")


def split_counts(spark, sf):
    """Episodes per split and in all, with how many have annotations."""
    a = annotation_episodes(spark, sf).select("join_key").distinct().withColumn("noted", F.lit(True))
    e = demo_episodes(spark, sf).join(a, "join_key", "left").withColumn("split", F.coalesce("split", F.lit("none")))
    return sequences.split_rollup(e, "split", F.coalesce("noted", F.lit(False)))


# --- curated steps ---------------------------------------------------------------------------------------------------


def _curated(spark: SparkSession, sf: str, strategy: str = "nearest") -> DataFrame:
    """Steps of matched episodes with the reasoning of their annotation carried along."""
    notes = annotation_steps(spark, sf)
    notes = notes.groupBy("join_key", "step_index").agg(F.max(F.struct("reasoning", F.col("move_primitive").alias("note_move"))).alias("n")).select("join_key", "step_index", "n.*")
    demos = demo_episodes(spark, sf).join(notes.select("join_key").distinct(), "join_key", "left_semi").select("episode_key", "join_key")
    steps = demo_steps(spark, sf, "language_instruction").join(demos, "episode_key")
    keyed = notes.join(demos, "join_key").select("episode_key", "step_index", "reasoning", "note_move")
    return align.aligned(steps, keyed, ["episode_key"], "step_index", "reasoning", strategy, {"note_move": F.lit("")})


def curated_steps(spark, sf):
    return _curated(spark, sf).select(
        "episode_key", "step_index", F.col("reasoning.subtask_reasoning").alias("subtask"), F.col("reasoning.move_reasoning").alias("move"), "note_move", "alignment_confidence"
    )


def curated_coverage(spark, sf):
    c = _curated(spark, sf)
    return c.groupBy("episode_key").agg(
        F.count("*").alias("steps"), F.count("reasoning").alias("with_trace"), F.count_if("direct").alias("direct"), F.count_if(has_reasoning(F.col("reasoning"))).alias("with_text"),
        F.round(F.avg("alignment_confidence"), 6).alias("mean_confidence"),
    )


def coverage_matrix(spark, sf):
    return sequences.presence_matrix(_curated(spark, sf, "exact"), "episode_key", "reasoning", ("task_reasoning", "subtask_reasoning", "move_reasoning"))


def first_instruction(spark, sf):
    return sequences.first_filled(demo_steps(spark, sf, "language_instruction"), "episode_key", "step_index", "language_instruction", "instruction")


def task_texts(spark, sf):
    own = sequences.first_filled(demo_steps(spark, sf, "language_instruction"), "episode_key", "step_index", "language_instruction", "instruction")
    notes = annotation_episodes(spark, sf).groupBy("join_key").agg(F.min("language_instruction").alias("note"))
    e = demo_episodes(spark, sf).select("episode_key", "join_key").join(own, "episode_key", "left").join(notes, "join_key", "left")
    return e.select("episode_key", task_text(F.col("instruction"), F.col("note")).alias("task"))


def export_projection(spark, sf):
    s = demo_steps(spark, sf, "action", "state", "state_3d", "gripper_position", "move_primitive", "caption", "bboxes", "is_first", "is_last", "reward", "discount")
    e = s.withColumn("reasoning", F.lit(None).cast("struct<task_reasoning:string,plan:string,subtask_reasoning:string,subtask_reason:string,move_reasoning:string,move_reason:string>"))
    x = e.select("episode_key", "step_index", export_step(e.columns).alias("x"))
    return x.select(
        "episode_key", "step_index", *[_finite(F.get("x.action", i)).alias(f"a{i}") for i in range(7)], *[_finite(F.get("x.ecot_features.state_3d", i)).alias(f"p{i}") for i in range(3)],
        F.size("x.ecot_features.gripper_position").alias("n_grip"), F.col("x.ecot_features.move_primitive").alias("move"), F.col("x.ecot_features.caption").alias("caption"),
        F.col("x.reasoning.task").alias("task"),
    )


# --- steps and frames ------------------------------------------------------------------------------------------------


def _line_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").cast("int").alias("n"))


def sample_uniform(spark, sf):
    return _line_counts(spark, sf).select("l_orderkey", sampling.uniform_frames(F.col("n"), 5).alias("frames")).select("l_orderkey", _joined("frames"))


def sample_linspace(spark, sf):
    return _line_counts(spark, sf).select("l_orderkey", sampling.spaced_frames(F.col("n"), 4).alias("frames")).select("l_orderkey", _joined("frames"))


def sample_keyframe(spark, sf):
    out = sampling.keyframes(demo_steps(spark, sf, "action"), "episode_key", "step_index", threshold=0.05)
    return out.select("episode_key", "n_steps", _joined("frames"))


def sample_keyframe8(spark, sf):
    out = sampling.keyframes(demo_steps(spark, sf, "action"), "episode_key", "step_index", threshold=0.05, most=8)
    return out.select("episode_key", "n_steps", _joined("frames"))


def phase_transitions(spark, sf):
    s = demo_steps(spark, sf, "state").withColumn("grip", F.get("state", 6).cast("double"))
    return sequences.transitions(s.withColumn("grip", F.when(~F.isnan("grip"), F.col("grip"))), "episode_key", "step_index", "grip")


def cumulative_path(spark, sf):
    s = demo_steps(spark, sf, "action").withColumn("action", F.transform("action", lambda x: _finite(x)))
    out = sequences.cumulative_path(s, "episode_key", "step_index", "action")
    return out.select("episode_key", "step_index", *[F.round(f"p{k}", 6).alias(f"p{k}") for k in range(3)])


def action_components(spark, sf):
    s = demo_steps(spark, sf, "action").select("episode_key", "step_index", arrays.action_parts(F.col("action")).alias("p"))
    return s.select("episode_key", "step_index", *[_finite(F.get("p.xyz", k)).alias(n) for k, n in enumerate("xyz")], *[_finite(F.get("p.rpy", k)).alias(n) for k, n in enumerate(("roll", "pitch", "yaw"))],
                    sequences.gripper_label(_finite(F.col("p.gripper"))).alias("gripper"))


def nested_order(spark, sf):
    s = table(spark, sf, "lineitem").withColumn("o", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"))
    return sequences.stacked(s, "l_orderkey", "o", "l_partkey", "parts").select("l_orderkey", _joined("parts"))


def split_rollup(spark, sf):
    return sequences.split_rollup(table(spark, sf, "lineitem"), "l_linestatus", F.col("l_returnflag") == "R")


# --- validation ------------------------------------------------------------------------------------------------------


def _order_checks(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    zero = F.array_repeat(F.col("l_discount").cast("float"), 7)
    steps = lines.select(
        F.col("l_orderkey").alias("key"), *LINE_ORDER, (F.col("l_linenumber") - 1).alias("step_index"), (F.col("l_linenumber") == 1).alias("is_first"),
        (F.col("l_returnflag") == "N").alias("is_last"), F.when(F.col("l_quantity") > 5, zero).otherwise(F.slice(zero, 1, 3)).alias("action"),
        (F.col("l_tax") > 0.02).alias("has_trace"), F.lit(False).alias("has_image"),
    )
    episodes = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderkey").cast("string").alias("episode_id"), F.when(F.col("o_orderstatus") != "P", "1.0").alias("schema_version"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).otherwise("").alias("task_description"),
        F.when(F.col("o_orderstatus") == "O", "nearest").when(F.col("o_orderstatus") == "F", "exact").otherwise("other").alias("strategy"), F.lit(4).alias("declared_steps"),
    )
    return validate.validated(episodes, steps, "key", LINE_ORDER, validate.Rules(min_coverage=0.25))


def validate_orders(spark, sf):
    return _order_checks(spark, sf).select(
        "key", F.array_join("errors", "|").alias("errors"), F.array_join("warnings", "|").alias("warnings"), "passed",
        F.round("zero_action_fraction", 6).alias("zero_action_fraction"), F.round("reasoning_coverage", 6).alias("reasoning_coverage"),
    )


def validation_report(spark, sf):
    return validate.report(_order_checks(spark, sf)).withColumn("pass_rate", F.round("pass_rate", 6))


def failed_first10(spark, sf):
    return validate.failed(_order_checks(spark, sf)).orderBy("key").limit(10).select("key", F.size("errors").alias("n_errors"))


def passed_lines(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "key")
    return validate.only_passed(lines, _order_checks(spark, sf), "key").groupBy("key").agg(F.count("*").alias("lines"))


def validate_demos(spark, sf):
    """The same rules on the delivered episodes."""
    steps = demo_steps(spark, sf, "action", "is_first", "is_last", "move_primitive").withColumnRenamed("episode_key", "key")
    steps = steps.withColumn("has_trace", text.filled(F.col("move_primitive"))).withColumn("has_image", F.lit(False))
    e = demo_episodes(spark, sf).select(
        F.col("episode_key").alias("key"), F.col("file_path").alias("episode_id"), "schema_version", F.col("split").alias("task_description"),
        F.lit("nearest").alias("strategy"), F.col("n_steps").alias("declared_steps"),
    )
    out = validate.validated(e, steps, "key", ["step_index"])
    return out.select("key", F.array_join("errors", "|").alias("errors"), F.array_join("warnings", "|").alias("warnings"), "passed", F.round("reasoning_coverage", 6).alias("reasoning_coverage"))


# --- texts and vectors -----------------------------------------------------------------------------------------------


def clean_field(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", text.clean_field(F.col("edit_note")).alias("note"), text.is_placeholder(F.col("edit_note")).alias("placeholder"), text.clean_field(F.col("lang")).alias("lang"))


def filled_fields(spark, sf):
    trace = F.struct("title", "editor", "edit_note", "lang")
    names = ("title", "editor", "edit_note", "lang")
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(sequences.filled_fields(trace, names), ",").alias("filled"), sequences.is_complete(trace, names).alias("complete"), sequences.is_empty(trace, names).alias("empty")
    )


def safe_path(spark, sf):
    return demo_episodes(spark, sf).select("episode_key", text.safe_path_part(F.col("file_path")).alias("folder"), text.numbered("step_", F.lit(7), 5, ".png").alias("image"))


def previews(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", text.head(F.col("title"), 12).alias("start"), text.tail(F.col("title"), 12).alias("rest"), sequences.reasoning_text(F.col("title"), F.col("edit_note"), F.col("editor")).alias("lines"))


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings")


def pad7(spark, sf):
    v = _vectors(spark, sf).select("vec_id", arrays.pad7(F.slice("embedding", 1, 5)).alias("v"), arrays.pad_state_3d(F.col("embedding")).alias("s"), arrays.cut2(F.slice("embedding", 1, 1)).alias("g"))
    return v.select("vec_id", *[F.round(F.get("v", i).cast("double"), 6).alias(f"v{i}") for i in range(7)], F.round(F.get("s", 2).cast("double"), 6).alias("s2"), F.size("g").alias("n_g"), F.size("s").alias("n_s"))


def pad512(spark, sf):
    v = _vectors(spark, sf).select("vec_id", arrays.pad_embedding(F.col("embedding")).alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return v.select("vec_id", F.size("v").alias("n"), F.round(total, 4).alias("total"), F.round(F.get("v", 511).cast("double"), 6).alias("last"))


def embedding_norm(spark, sf):
    return _vectors(spark, sf).select("vec_id", F.round(arrays.norm(F.col("embedding")), 5).alias("norm"), arrays.all_zero(F.col("embedding")).alias("zero"))


# --- generation ------------------------------------------------------------------------------------------------------


def usage_totals(spark, sf):
    g = table(spark, sf, "generation_results").groupBy("result_id").agg(F.min(F.struct("model", "usage", "finish_reason")).alias("g")).select("result_id", "g.*")
    out = sequences.usage_totals(g, ["model"]).withColumnRenamed("model", "by_model")
    stop = g.groupBy(F.col("model").alias("by_model")).agg(F.count_if(F.coalesce(F.col("finish_reason") == "stop", F.lit(False))).alias("complete"))
    return out.join(stop, "by_model")


def _replies(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "prompts").groupBy("prompt_id").agg(F.min("text").alias("ask"))
    frames = F.transform(F.split(F.regexp_extract("ask", r"\(frames \[([0-9, ]+)\]\)", 1), ", "), lambda x: x.try_cast("int"))
    g = table(spark, sf, "generation_results").groupBy("result_id").agg(F.min(F.struct("prompt_id", "text")).alias("g")).select("result_id", "g.*")
    return g.join(p.select("prompt_id", F.array_compact(frames).alias("frames")), "prompt_id").where("size(frames) > 0")


def parse_replies(spark, sf):
    """Traces of the replies to prompts that name frames."""
    t = _replies(spark, sf).select("result_id", F.explode(parsed_reply(F.col("text"), F.col("frames"))).alias("t"))
    return t.select("result_id", F.col("t.step_index").alias("step_index"), *[text.clean_field(F.col(f"t.{f}")).alias(f) for f in ("task_reasoning", "subtask_reasoning", "move_reasoning", "gripper_reasoning")])


def parse_strict(spark, sf):
    """Traces of the replies that are plain JSON arrays of objects, each of which names a frame of its prompt."""
    strict = F.try_parse_json("text")
    named = F.transform(F.try_variant_get(strict, F.lit("$"), "array<variant>"), lambda v: F.try_variant_get(v, F.lit("$.frame_index"), "int"))
    ok = _replies(spark, sf).withColumn("named", named).where("size(named) > 0 and size(array_except(named, frames)) = 0 and size(array_distinct(named)) = size(named)")
    t = ok.select("result_id", F.explode(parsed_reply(F.col("text"), F.col("frames"))).alias("t"))
    return t.select("result_id", F.col("t.step_index").alias("step_index"), *[F.col(f"t.{f}").alias(f) for f in ("task_reasoning", "move_reasoning", "gripper_reasoning")])


def missing_frames(spark, sf):
    """Frames that a prompt names and a reply, read as text, does not."""
    named = F.transform(F.regexp_extract_all("text", F.lit(r'"frame_index": ([0-9]+)'), F.lit(1)), lambda x: x.try_cast("int"))
    r = _replies(spark, sf).where("text is not null")
    return r.select("result_id", reply.missing_frames(F.col("frames"), named).alias("missing")).select("result_id", _joined("missing"), F.size("missing").alias("n_missing"))


def _prompt_input(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    steps = demo_steps(spark, sf, "language_instruction", "action")
    return sequences.first_filled(steps, "episode_key", "step_index", "language_instruction", "task"), steps


def prompt_text(spark, sf):
    eps, steps = _prompt_input(spark, sf)
    return generation.prompts(eps, steps, "episode_key", "step_index", "task", "uniform", 4).select("episode_key", "text", "n_steps")


def mock_generate(spark, sf):
    eps, steps = _prompt_input(spark, sf)
    out = generation.generate(eps, steps.select("episode_key", "step_index"), "episode_key", "step_index", "task", MockBackend("mock-1"), n=4)
    return out.select("episode_key", "step_index", F.col("reasoning.task_reasoning").alias("task_reasoning"), "alignment_confidence")


def queries() -> dict:
    names = (
        "align_nearest align_exact align_broadcast confidence_hist dedupe_last_wins coverage_by_user trace_quality phase_segments context3 limit_after_filter resume_anti json_props "
        "match_inner match_left_full unmatched_anti match_counts key_overlap keys_union keys_common keys_except match_demo_annotations match_key_or_path demo_key_overlap composite_key split_counts "
        "curated_steps curated_coverage coverage_matrix first_instruction task_texts export_projection sample_uniform sample_linspace sample_keyframe sample_keyframe8 phase_transitions cumulative_path "
        "action_components nested_order split_rollup validate_orders validation_report failed_first10 passed_lines validate_demos clean_field filled_fields safe_path previews pad7 pad512 embedding_norm "
        "usage_totals parse_replies parse_strict missing_frames prompt_text mock_generate"
    )
    return {n: globals()[n] for n in names.split()}
