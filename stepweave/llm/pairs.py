"""Broken prompt and response pairs: empty, copied, refused, wrong-language and truncated answers.

Rules judge each answer against its prompt. What is left open, a text without
an end, is judged against all answers: whole answers, their sentences and the
values of JSON answers are sorted by text and compared with both neighbours;
one that is itself a neighbour's prefix is a shortened version. Word
statistics of all sentences and spikes of the answer lengths decide the others.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepweave.llm.language import language_of, wanted_language
from stepweave.llm.refusals import is_refusal
from stepweave.operators.skew import join_heads, lookup, small_side
from stepweave.session import stored

# Texts that stand for no answer.
PLACEHOLDERS = frozenset("null none nil na n/a nan undefined empty tbd todo placeholder blank void missing unavailable".split()) | {
    "no answer", "no response", "no output", "not available", "not applicable", "no content",
}
_CLOSED = re.compile(r"\b(?:number only|one word|single word|yes or no|true or false|one number|just the number|one letter|a number)\b", re.I)
_FENCE = re.compile(r"```[a-zA-Z0-9_-]*[ \t]*\n?")
_INVISIBLE = re.compile("[​-‏⁠﻿­]")
_PLACE_KEY = re.compile(r"frame|step|index|\bid\b", re.I)
_WORDS = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_END = re.compile(r"[.!?。！？…][\"'”’»)\]]*\s*$")
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"(\s*:)?|[\[\]{}]|"', re.S)
_SPLIT = re.compile(r"(?<=[.!?。！？])[\"'”’»)\]]*(?:\s+|(?<=[。！？]))|\n+")


def json_state(text: str) -> tuple[list[str], bool] | None:
    """(string values, whether it is closed) of the JSON that a text holds; None if it holds none.

    Field names are no values; nor are null and numbers that only tell a place.
    Of JSON that breaks off, the values up to the break are given.
    """
    start = min((i for i in (text.find("["), text.find("{")) if i >= 0), default=-1)
    if start < 0 or (text[start] == "[" and not re.match(r"\[\s*(?:[\[{\"\]]|-?\d|null|true|false|$)", text[start:])):
        return None
    if text[start] == "{" and not re.match(r"\{\s*(?:[\"}]|$)", text[start:]):
        return None
    block = text[start:]
    if len(_WORDS.findall(text[:start])) > 15:
        return None  # brackets within prose
    try:
        value, end = json.JSONDecoder(strict=False).raw_decode(block)
    except (ValueError, RecursionError):
        value = ...
    if value is not ...:
        out, todo, objects = [], [("", value)], False
        while todo:
            key, v = todo.pop()
            if isinstance(v, dict):
                objects = True
                todo += v.items()
            elif isinstance(v, list):
                todo += ((key, x) for x in v)
            elif isinstance(v, str) or v is not None and not _PLACE_KEY.search(key):
                out.append(str(v))
        if not objects and _WORDS.search(text[:start] + block[end:]):
            return None
        return out[::-1], True
    depth, strings, last = 0, [], 0
    for m in _TOKEN.finditer(block):
        token, last = m.group(), m.end()
        if token in "[{":
            depth += 1
        elif token in "]}":
            depth -= 1
        elif token == '"':  # one that nothing closes
            return [*strings, block[m.end() :]], False
        elif m.group(1) is None:
            strings.append(token[1:-1])
    return strings, depth <= 0


def _in_order(got: list[str], asked: list[str]) -> int:
    """The most words of ``got`` that ``asked`` has in the same order."""
    places: dict[str, list[int]] = {}
    for i, w in enumerate(asked):
        places.setdefault(w, []).append(i)
    ends: list[int] = []  # smallest place at which a common row of each length ends
    for w in got:
        for i in reversed(places.get(w, ())):
            k = bisect_left(ends, i)
            if k == len(ends):
                ends.append(i)
            else:
                ends[k] = i
    return len(ends)


def _slip(a: str, b: str) -> bool:
    """Whether two words have at least three of five letters in common order."""
    return abs(len(a) - len(b)) <= 2 and 2 * _in_order(list(a), list(b)) >= 0.6 * (len(a) + len(b))


@lru_cache(maxsize=5_000)
def _asked(prompt: str) -> tuple[list[str], Counter]:
    words = _WORDS.findall(prompt.lower())
    return words, Counter(words)


def _is_copy(content: str, prompt: str) -> bool:
    """Whether nothing but the prompt's text, or a whole part of it, is there, slips aside."""
    if len(content) > 2 * len(prompt) + 200:  # words more than a third beyond the prompt's are none of it
        if len(_WORDS.findall(content)) > 4 * len(_asked(prompt)[0]) // 3 + 6:
            return False
    got = _WORDS.findall(content.lower())
    asked, counts = _asked(prompt)
    if len(got) >= 2 and got[0] in ("question", "prompt", "you", "q", "user", "asked"):
        skip = 2 if got[0] == "you" and got[1] in ("ask", "asked", "said", "wrote") else 1
        got = got[skip:]
    if len(got) < 4 or not asked:
        return False
    left = Counter(got) - counts
    if sum(left.values()) > max(2, len(got) // 4):
        return False
    # Words of the answer that the prompt has not, but for slips of letters in words of the prompt.
    strange = [w for w in left.elements() if not any(_slip(w, a) for a in set(asked))]
    return len(strange) <= 0.05 * len(got) and _in_order(got, asked) >= 0.8 * len(got)


def _size(sentences: list[str]) -> int:
    return sum(len(_WORDS.findall(x)) for x in sentences)


def _core(text: str) -> str:
    return re.sub(r"[^\w/]+", " ", text.lower()).strip(" _") if len(text) < 200 else text


def judge(text: str | None, prompt: str | None) -> tuple[str | None, list[str], str | None, bool]:
    """(defect, its sentences, open tail, whether it is JSON) of one answer by rules alone.

    The tail is a last sentence without an end, which only all answers
    together can judge; of JSON it is that of the last value, if all other
    values of some length have an end. Sentences are those of answers without
    defect.
    """
    plain = _INVISIBLE.sub("", text or "").strip()
    inner = _FENCE.sub("\n", plain).strip() if "```" in plain else plain
    state = json_state(inner)
    values = [v.strip() for v in state[0]] if state is not None else [inner]
    content = "\n".join(values)
    if not _WORDS.search(content) or _core(content) in PLACEHOLDERS:
        if state is None or state[1] or not inner.strip("[]{} \n\t\"',:") or _core(content) in PLACEHOLDERS:
            return "empty", [], None, False
        return "truncated", [], None, False
    if (state is None or state[1]) and all(not _WORDS.search(v) or _core(v) in PLACEHOLDERS for v in content.split("\n")):
        return "empty", [], None, False
    if prompt and _is_copy(content, prompt):
        return "copy", [], None, False
    sentences = [s for s in _SPLIT.split(content) if s and _WORDS.search(s)]
    if is_refusal(sentences, _size):
        return "refusal", [], None, False
    if prompt:
        want = wanted_language(prompt)
        is_in = language_of(content)
        if want and is_in and want != is_in:
            return "language", [], None, False
    if state is None:
        closed = bool(prompt and _CLOSED.search(prompt)) and len(_WORDS.findall(content)) <= 3
        return None, sentences, None if closed or _END.search(content) else sentences[-1], False
    if not state[1]:
        return "truncated", [], None, True
    texts = [v for v in values if len(_WORDS.findall(v)) >= 4]
    if not texts or texts[-1] != values[-1] or _END.search(values[-1]) or not all(_END.search(v) for v in texts[:-1]) or len(texts) < 2:
        return None, sentences, None, True
    return None, sentences, [s for s in _SPLIT.split(values[-1]) if s and _WORDS.search(s)][-1], True


@F.pandas_udf(T.IntegerType())
def common_prefix(a: pd.Series, b: pd.Series) -> pd.Series:
    """Characters that two texts begin with in common, 0 for NULL."""

    def one(x, y):
        if not x or not y:
            return 0
        low, high = 0, min(len(x), len(y))
        while low < high:
            mid = (low + high + 1) // 2
            if x[low:mid] == y[low:mid]:
                low = mid
            else:
                high = mid - 1
        return low

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="int32")


def neighbours(texts: DataFrame, text: str, wanted: Column) -> DataFrame:
    """The rows of ``wanted``, with the longest prefix in common with their neighbours in text order as ``common``.

    ``texts`` has every text once; it is sorted by ranges, and the neighbour
    across a range's edge is looked up among the ranges' first and last texts.
    """
    parts = max(8, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = stored(texts.repartitionByRange(parts, text).withColumn("part", F.spark_partition_id()), "sorted")
    # One row a range: as many as there are shuffle partitions.
    edges = ranged.groupBy("part").agg(F.min(text).alias("first"), F.max(text).alias("last"))
    by_part = Window.orderBy("part")
    edges = edges.select("part", F.lead("first").over(by_part).alias("next_first"), F.lag("last").over(by_part).alias("last_before"))
    inside = Window.partitionBy("part").orderBy(text)
    rows = ranged.join(F.broadcast(edges), "part").select(
        "*", F.coalesce(F.lead(text).over(inside), "next_first").alias("after"), F.coalesce(F.lag(text).over(inside), "last_before").alias("before")
    )
    rows = rows.where(wanted)
    return rows.withColumn("common", F.greatest(common_prefix(text, "before"), common_prefix(text, "after"))).drop("part", "next_first", "last_before", "before", "after")


def broken_pairs(results: DataFrame, prompts: DataFrame) -> DataFrame:
    """(result_id, defect) of every defective answer; the one defect is the first of empty, copy, refusal, language, truncated.

    ``results`` has result_id, prompt_id, text, model and usage (a struct with
    completion_tokens); ``prompts`` has prompt_id and text. The finish reason
    plays no part.

    Nulls: rows without result_id are skipped; a NULL text is empty; an answer
    without prompt is judged without the copy and language rules. Repeated
    rows count once; of different rows of one id the smallest text counts.
    Texts are read whole. Empty tables give no rows; extra columns are ignored.
    """
    one = results.where("result_id is not null").groupBy("result_id").agg(
        F.min(F.struct("text", "prompt_id", F.coalesce("model", F.lit("")).alias("model"), F.col("usage.completion_tokens").alias("tokens"))).alias("r")
    )
    one = stored(one.select("result_id", "r.*"), "answers")
    asked = prompts.where("prompt_id is not null").groupBy("prompt_id").agg(F.min("text").alias("prompt"))
    paired = lookup(one.where("prompt_id is not null"), asked, ["prompt_id"], "result_id", may_broadcast=False).select("result_id", "text", "prompt", "model", "tokens")
    alone = one.where("prompt_id is null").select("result_id", "text", F.lit(None).cast("string").alias("prompt"), "model", "tokens")
    idt = results.schema["result_id"].dataType.simpleString()

    def rules(batches):
        for pdf in batches:
            got = [judge(t, p) for t, p in zip(pdf.text, pdf.prompt)]
            columns = dict(zip(("defect", "sentences", "tail", "json"), map(list, zip(*got)))) if got else {k: [] for k in ("defect", "sentences", "tail", "json")}
            yield pd.DataFrame({"result_id": pdf.result_id, "model": pdf.model, "tokens": pdf.tokens, **{k: pd.Series(v, index=pdf.index, dtype=object) for k, v in columns.items()}})

    ddl = f"result_id {idt}, model string, tokens int, defect string, sentences array<string>, tail string, json boolean"
    judged = stored(paired.unionByName(alone).mapInPandas(rules, ddl), "judged")

    # Sentences and whole answers without defect, once each, as words: how often a sentence has its end, and whether it is a tail.
    norm = lambda c: F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}']+", " "))
    is_tail = F.col("s").eqNullSafe(F.col("tail"))
    sentences = judged.select(F.explode("sentences").alias("s"), "tail", "json").select(
        norm(F.col("s")).alias("norm"), (~is_tail & (~F.col("json") | F.rtrim("s").rlike(r"[.!?。！？…][\"'”’»)\]]*$"))).alias("whole"), is_tail.alias("open")
    )
    answers = judged.where("not json and size(sentences) > 1").select(
        norm(F.array_join("sentences", " ")).alias("norm"), F.lit(False).alias("whole"), F.col("tail").isNotNull().alias("open")
    )
    texts = sentences.unionByName(answers).where("norm <> ''").groupBy("norm").agg(F.count_if("whole").alias("whole"), F.max("open").alias("open"))
    texts = stored(texts, "texts")
    shortened = F.col("common") >= F.length("norm")
    open_ = neighbours(texts, "norm", F.col("open")).select("norm", "whole", shortened.alias("shortened"))
    open_ = stored(open_, "open_texts")

    # How often words, and the two words before a word, stand at a proper end and elsewhere.
    w = F.col("w")
    place = F.transform(w, lambda x, i: F.struct(x.alias("word"), F.concat_ws(" ", F.get(w, i - 2), F.get(w, i - 1)).alias("before"), (i == F.size(w) - 1).alias("at_end")))
    pos = texts.where("whole > 0").select("whole", F.split("norm", " ").alias("w")).select("whole", F.explode(place).alias("at"))
    stats = stored(pos.groupBy("at.word", "at.before", "at.at_end").agg(F.sum("whole").alias("n")), "stats")
    by_word = stats.groupBy("word").agg(F.sum(F.when(F.col("at_end"), F.col("n")).otherwise(0)).alias("ends"))
    by_ctx = stats.where("before <> ''").groupBy("before").agg(
        F.sum(F.when(F.col("at_end"), F.col("n")).otherwise(0)).alias("ctx_ends"), F.sum(F.when(~F.col("at_end"), F.col("n")).otherwise(0)).alias("ctx_inner")
    )
    # A length at which far more answers end than at the lengths around it is a limit.
    lengths = judged.where("tokens is not null").groupBy("model", "tokens").agg(F.count("*").alias("k"))
    near = Window.partitionBy("model").orderBy("tokens").rangeBetween(-8, 8)
    spikes = lengths.withColumn("rest", (F.sum("k").over(near) - F.col("k")) / F.lit(16.0)).where("k >= 20 and k > 10 * rest").select("model", "tokens", F.lit(True).alias("at_limit"))
    tails = judged.where("defect is null and tail is not null").select(
        "result_id", "model", "tokens", "json", norm(F.col("tail")).alias("norm"), (F.size("sentences") > 1).alias("later"), norm(F.array_join("sentences", " ")).alias("answer")
    )
    tails = tails.withColumn("answer", F.when(F.col("later") & ~F.col("json"), F.col("answer")).otherwise(F.col("norm")))
    tails = stored(tails.join(small_side(stored(spikes, "limits")), ["model", "tokens"], "left").withColumn("at_limit", F.coalesce("at_limit", F.lit(False))), "tails")
    # Equal tails are judged once, whatever their number; then the verdict is brought back to the answers.
    kinds = tails.groupBy("norm", "json", "later", "at_limit").agg(F.count("*").alias("n"))
    n = F.size("w")
    kinds = kinds.withColumn("w", F.split("norm", " ")).withColumn("word", F.element_at("w", -1)).withColumn("before", F.concat_ws(" ", F.get("w", n - 3), F.get("w", n - 2))).withColumn("words", n).drop("w")
    kinds = lookup(stored(kinds, "tail_kinds"), stored(by_word, "words"), ["word"], "norm")
    kinds = lookup(stored(kinds, "word_kinds"), stored(by_ctx, "contexts"), ["before"], "norm").join(open_, "norm")
    # A word or two after whole sentences is a beginning, even if it could stand alone elsewhere.
    begun = F.col("later") & (F.col("words") <= 2) & F.col("shortened")
    cut = F.col("shortened") | (F.coalesce("ends", F.lit(0)) == 0) | ((F.coalesce("ctx_ends", F.lit(0)) == 0) & (F.coalesce("ctx_inner", F.lit(0)) > 0)) | F.col("at_limit")
    keys = ["norm", "json", "later", "at_limit"]
    heads = stored(kinds.select(*keys, "n", (F.col("whole") == 0).alias("endless"), (begun | ((F.col("whole") == 0) & cut)).alias("cut")), "verdicts")
    by_tail = join_heads(tails, heads.where("cut"), keys, "n", "result_id").select("result_id")
    # Whole answers that another one goes on from, unless they stop where a sentence is known to end.
    whole_answers = tails.where("answer <> norm")
    longer = open_.where("shortened").select(F.col("norm").alias("answer"))
    sizes = stored(whole_answers.groupBy("answer").agg(F.count("*").alias("of")).join(longer, "answer"), "shortened_answers")
    by_answer = join_heads(join_heads(whole_answers, sizes, ["answer"], "of", "result_id"), heads.where("endless"), keys, "n", "result_id").select("result_id")
    truncated = by_tail.union(by_answer).distinct().withColumn("defect", F.lit("truncated"))
    return judged.where("defect is not null").select("result_id", "defect").unionByName(truncated)
