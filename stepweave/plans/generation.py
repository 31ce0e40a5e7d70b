"""Annotations from a model: prompts, replies, traces on every step."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepweave.functions.images import encoded
from stepweave.functions.reply import parsed_reply, parsed_step
from stepweave.operators.align import aligned
from stepweave.operators.sampling import KEYFRAME_THRESHOLD, select_frames
from stepweave.operators.setops import not_done
from stepweave.plans.backends import Backend, Request
from stepweave.schemas import GENERATION_RESULT, REPLY_FIELDS
from stepweave.session import stored

SYSTEM_PROMPT = (
    "You look at frames of a robot arm at work and say why it moves as it does. For every frame give one JSON object with the whole number "
    "frame_index and the texts task_reasoning (what the whole episode is for), subtask_reasoning (the present part of it), move_reasoning (why "
    "the arm moves this way now), gripper_reasoning (what the gripper does), attribute_reasoning (properties of things that matter) and "
    "spatial_reasoning (where things are to each other). Write one or two sentences for each; leave a text empty rather than guess. "
    "Answer with a JSON array of these objects and nothing else."
)


def episode_text(task: Column, n_steps: Column, frames: Column) -> Column:
    """The request for a whole episode."""
    return F.concat(
        F.lit('Task: "'), F.coalesce(task, F.lit("")), F.lit('"\n\nThe episode has '), n_steps.cast("string"), F.lit(" steps. You see "), F.size(frames).cast("string"),
        F.lit(" of them (frames ["), F.array_join(frames.cast("array<string>"), ", "), F.lit("]).\n\nDescribe each frame as the system prompt asks."),
    )


def step_text(task: Column, step: Column, context: Column | None = None) -> Column:
    """The request for one step, after what was said about the steps before it."""
    before = F.lit("") if context is None else F.when(F.size(context) > 0, F.concat(F.lit("\nBefore: "), F.array_join(context, " / "))).otherwise(F.lit(""))
    return F.concat(F.lit('Task: "'), F.coalesce(task, F.lit("")), F.lit('"\nStep: '), step.cast("string"), before, F.lit("\n\nDescribe this frame as one JSON object without frame_index."))


def _pictures(frames: DataFrame, steps: DataFrame, key: str, order: str, image: str) -> DataFrame:
    """key, images: the bytes of the sampled steps in the order of ``frames``; steps without an image are skipped."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    of_step = steps.select(key, place.alias("_at"), F.col(image).alias("_image")).where("length(_image) > 0")
    wanted = frames.select(key, F.posexplode("frames").alias("_nth", "_at"))
    taken = F.array_sort(F.collect_list(F.struct("_nth", "_image")))
    return wanted.join(of_step, [key, "_at"]).groupBy(key).agg(F.transform(taken, lambda x: x["_image"]).alias("images"))


def prompts(episodes: DataFrame, steps: DataFrame, key: str, order: str, task: str, strategy: str = "uniform", n: int = 8, image: str | None = None, threshold: float = KEYFRAME_THRESHOLD) -> DataFrame:
    """key, text, system_prompt, frames, n_steps per episode; episodes without steps have none.

    With ``image``, a column of encoded or raw square images in ``steps``, also
    images: those of the frames, in their order.
    """
    frames = select_frames(steps, key, order, strategy, n, threshold)
    out = frames.join(episodes.select(key, task), key).select(
        key, episode_text(F.col(task), F.col("n_steps"), F.col("frames")).alias("text"), F.lit(SYSTEM_PROMPT).alias("system_prompt"), "frames", "n_steps"
    )
    if image is None:
        return out
    return out.join(_pictures(frames, steps, key, order, image), key, "left").withColumn("images", F.coalesce("images", F.array().cast("array<binary>")))


def step_prompts(asked: DataFrame, episodes: DataFrame, steps: DataFrame, key: str, order: str, task: str, image: str | None = None, before: int = 3) -> DataFrame:
    """A request for each frame of ``asked`` (key, system_prompt, frames, n_steps): key, text, system_prompt, frames (that one), n_steps.

    With ``image`` also images: those of up to ``before`` sampled frames before it, then its own.
    """
    each = asked.select(key, "system_prompt", "n_steps", F.col("frames").alias("_all"), F.posexplode("frames").alias("_nth", "_frame"))
    each = each.join(episodes.select(key, task), key).withColumn("text", step_text(F.col(task), F.col("_frame")))
    if image is None:
        return each.select(key, "text", "system_prompt", F.array("_frame").alias("frames"), "n_steps")
    place = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    of_step = steps.select(key, place.alias("_at"), F.col(image).alias("_image")).where("length(_image) > 0")
    first = F.greatest(F.lit(1), F.col("_nth") + 1 - before)
    wanted = each.withColumn("_shown", F.slice("_all", first, F.col("_nth") + 2 - first)).select("*", F.explode("_shown").alias("_at"))
    shown = F.array_sort(F.collect_list(F.when(F.col("_image").isNotNull(), F.struct("_at", "_image"))))
    out = wanted.join(of_step, [key, "_at"], "left").groupBy(key, "_frame").agg(F.first("text").alias("text"), F.first("system_prompt").alias("system_prompt"), F.first("n_steps").alias("n_steps"), shown.alias("s"))
    return out.select(key, "text", "system_prompt", F.array("_frame").alias("frames"), "n_steps", F.transform("s", lambda x: x["_image"]).alias("images"))


def _request(text: str, images, system_prompt: str, frames) -> Request | Exception:
    try:
        return Request(text, [encoded(bytes(x)) for x in images], system_prompt, {"frames": [int(x) for x in frames]})
    except ValueError as e:  # an image of no known kind
        return e


def generated(requests: DataFrame, key: str, backend: Backend, batch: int = 16) -> DataFrame:
    """``requests`` with the struct ``result``; a request that fails for good gives finish_reason 'error' and no text.

    A request carries the bytes of its row's ``images``, if there is such a column.

    One client per Python worker. To hold a provider's limit, repartition to k
    tasks and give the backend a k-th of it.
    """
    if "images" in requests.columns and not backend.supports_multimodal:
        raise ValueError(f"model {backend.model_name!r} takes no images")
    kept = [f for f in requests.schema if f.name in (key, "frames", "n_steps")]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + f", result {GENERATION_RESULT.simpleString()}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a in range(0, len(pdf), batch):
                part = pdf.iloc[a : a + batch]
                images = part.images if "images" in part.columns else [()] * len(part)
                asked = [_request(*r) for r in zip(part.text, images, part.system_prompt, part.frames)]
                out = []
                for g in backend.generate_each(asked):
                    if isinstance(g, Exception):  # one request's error must not cost the others
                        out.append({"text": None, "model": backend.model_name, "finish_reason": "error", "usage": None, "metadata": {"error": str(g)}})
                    else:
                        p, c, t = g.usage()
                        out.append({"text": g.text, "model": g.model, "finish_reason": g.finish_reason, "usage": {"prompt_tokens": p, "completion_tokens": c, "total_tokens": t}, "metadata": {}})
                yield part[[f.name for f in kept]].assign(result=out)

    return requests.mapInPandas(run, ddl)


def sparse_traces(results: DataFrame, key: str, one_step: bool = False) -> DataFrame:
    """key, step_index, reasoning, raw_response: one row per frame that a reply speaks of.

    With ``one_step`` a reply is about the one frame of its row.
    """
    if one_step:
        rows = results.select(key, F.get("frames", 0).alias("step_index"), parsed_step(F.col("result.text")).alias("t"))
        return rows.select(key, "step_index", F.struct(*[F.col(f"t.{f}").alias(f) for f in REPLY_FIELDS]).alias("reasoning"), F.col("t.raw_response").alias("raw_response"))
    rows = results.select(key, F.explode(parsed_reply(F.col("result.text"), F.col("frames"))).alias("t"))
    return rows.select(key, F.col("t.step_index").alias("step_index"), F.struct(*[F.col(f"t.{f}").alias(f) for f in REPLY_FIELDS]).alias("reasoning"), F.col("t.raw_response").alias("raw_response"))


def generate(
    episodes: DataFrame, steps: DataFrame, key: str, order: str, task: str, backend: Backend, done: DataFrame | None = None, resume: bool = True,
    dry_run: bool = False, strategy: str = "uniform", n: int = 8, image: str | None = None, threshold: float = KEYFRAME_THRESHOLD, errors: str | None = None,
    raw: bool = True, per_step: bool = False,
) -> DataFrame:
    """Steps with a trace each, carried along the episode; with ``dry_run`` only the prompts.

    With ``resume`` episodes in ``done`` are left out. An episode whose request
    failed for good isn't in the result, so that a later run asks for it again;
    such requests are appended as JSON lines to the folder ``errors``, if it is
    given. The replies are asked for here and written once. ``image`` is the
    column of ``steps`` that the model is shown; it isn't in the result. With
    ``raw`` the model's own words stay beside each step that they were about.
    With ``per_step`` every sampled frame has a request of its own, and an
    episode counts as failed if one of them does.
    """
    todo = not_done(episodes, done, key) if resume and done is not None else episodes
    asked = prompts(todo, steps, key, order, task, strategy, n, image, threshold)
    if per_step:
        asked = step_prompts(asked.drop("text", "images"), todo, steps, key, order, task, image)
    if dry_run:
        return asked
    results = stored(generated(asked, key, backend), "replies")
    bad = results.where("result.finish_reason <=> 'error'")
    if errors is not None:
        bad.select(key, F.col("result.metadata")["error"].alias("error")).write.mode("append").json(errors)
    replies = results.join(bad.select(key).distinct(), key, "left_anti")
    traces = sparse_traces(replies, key, one_step=per_step).withColumnRenamed("step_index", order)
    chosen = (steps.drop(image) if image else steps).join(replies.select(key).distinct(), key, "left_semi")
    out = aligned(chosen, traces.drop("raw_response"), [key], order, "reasoning", "nearest")
    return out.join(traces.select(key, order, "raw_response"), [key, order], "left") if raw else out
