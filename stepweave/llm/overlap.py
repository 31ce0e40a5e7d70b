"""Texts of evaluation splits that occur, exactly or almost, in the training split.

Exact copies fall together by the hash of their canonical words. Texts within
``max_edits`` word edits share at least ``max(n, m) - max_edits`` words, so of
the first ``max_edits + l`` words of both, in one fixed order with rare words
first, at least l are common (the prefix principle). Every l-word subset of
those prefixes is hashed; evaluation hashes are joined with training hashes,
and an exact word distance confirms what they find. No link can be lost.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepweave.operators.skew import lookup, small_side
from stepweave.session import stored

#: Words that make up more than this share of all words are ordered by their
#: frequency; at most 1/share of them can exist, which bounds the broadcast.
FREQUENT_SHARE = 1 / 20_000
#: A signature that gives more pairs than this is spread over tasks, at most MAX_PARTS.
HOT_PAIRS, MAX_PARTS = 1_000_000, 4096
_ALPHABET = "".join(map(chr, range(0x4E00, 0x4E00 + 4096)))


def canonical_words(text: Column) -> Column:
    """Runs of letters and digits in lower case, put together with single spaces."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def signatures(words: list[str], frequent: dict[str, int], max_edits: int, common: int) -> list[int]:
    """Hashes of which two texts within ``max_edits`` edits share at least one."""
    seen: Counter[str] = Counter()
    tokens = []
    for w in words:
        seen[w] += 1
        tokens.append((frequent.get(w, 0), xxhash.xxh64_intdigest(w), seen[w], w))
    tokens.sort()
    out = [(common, c) for c in combinations(tokens[: max_edits + common], common)]
    # Pairs whose longer text is shorter than max_edits + common share fewer words.
    for longer in range(max(len(tokens), 1), max_edits + common):
        need = longer - max_edits
        out += [(-longer, c) for c in (combinations(tokens, need) if need > 0 else [()])]
    return [
        xxhash.xxh64_intdigest(f"{kind}\x1f" + "\x1f".join(f"{w}\x1e{k}" for _, _, k, w in c)) - (1 << 63) for kind, c in out
    ]


def word_distance(a: Column, b: Column, at_most: int) -> Column:
    """Word edits between two arrays of words, -1 beyond ``at_most`` (codegen'd Levenshtein over symbols)."""
    both = F.array_distinct(F.concat(a, b))

    def coded(words: Column) -> Column:
        symbol = lambda w: F.substring(F.lit(_ALPHABET), F.array_position(both, w).cast("int"), F.lit(1))
        return F.array_join(F.transform(words, symbol), "")

    return F.levenshtein(coded(a), coded(b), at_most)


@F.pandas_udf(T.BooleanType())
def _within_long(a: pd.Series, b: pd.Series, k: pd.Series) -> pd.Series:
    """Banded word distance for texts with more different words than the symbol alphabet has."""

    def one(x, y, d):
        big = d + 1
        if abs(len(x) - len(y)) > d:
            return False
        row = {j: j for j in range(min(len(y), d) + 1)}
        for i, w in enumerate(x, 1):
            new = {}
            for j in range(max(0, i - d), min(len(y), i + d) + 1):
                if j == 0:
                    new[j] = i
                else:
                    new[j] = min(row.get(j, big) + 1, new.get(j - 1, big) + 1, row.get(j - 1, big) + (w != y[j - 1]))
            row = new
        return row.get(len(y), big) <= d

    return pd.Series([one(list(x), list(y), int(d)) for x, y, d in zip(a, b, k)], dtype=bool)


def near_links(texts: DataFrame, max_edits: int = 3, common: int = 5) -> tuple[DataFrame, DataFrame]:
    """(members, links) of a table id, side ('train' or 'eval'), text.

    members: id, side, class (the smallest id with the same canonical words).
    links: class_t, class_e, every pair of a class with a training member and
    one with an evaluation member within ``max_edits`` word edits, equal
    classes too. Copies are not expanded here.

    Rows without id, side or any word are skipped; repeated rows count once.
    """
    spark = texts.sparkSession
    canon = texts.select("id", "side", canonical_words(F.col("text")).alias("canon")).where("id is not null and side is not null and canon <> ''")
    keyed = stored(canon.withColumn("h", F.xxhash64("canon")).distinct(), "canon")
    classes = stored(
        keyed.groupBy("h", "canon").agg(
            F.min("id").alias("class"), F.max(F.col("side") == "train").alias("in_train"), F.max(F.col("side") == "eval").alias("in_eval")
        ).withColumn("words", F.split("canon", " ")),
        "classes",
    )
    members = keyed.join(classes.select("h", "canon", "class"), ["h", "canon"]).select("id", "side", "class")

    counted = classes.select(F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    total = classes.agg(F.sum(F.size("words"))).first()[0] or 0
    frequent = {w: n for w, n in counted.where(F.col("n") > total * FREQUENT_SHARE).collect()}
    shared = spark.sparkContext.broadcast(frequent)

    @F.pandas_udf("array<long>")
    def signed(words: pd.Series) -> pd.Series:
        return words.map(lambda w: signatures(list(w), shared.value, max_edits, common))

    sides = classes.select("class", "in_train", "in_eval", F.size("words").alias("len"), F.explode(F.array_distinct(signed("words"))).alias("sig"))
    sides = stored(sides, "signatures")
    t = sides.where("in_train").select("sig", F.col("class").alias("class_t"), F.col("len").alias("len_t"))
    e = sides.where("in_eval").select("sig", F.col("class").alias("class_e"), F.col("len").alias("len_e"))
    # Signatures of common words, or of few, stand on very many texts: their evaluation side is cut into parts, each of which meets the training side.
    both = sides.groupBy("sig").agg(F.count_if("in_train").alias("nt"), F.count_if("in_eval").alias("ne")).where("nt > 0 and ne > 0")
    wide = F.ceil(F.col("nt") * F.col("ne") / F.lit(HOT_PAIRS)).cast("int")
    hot = small_side(stored(both.where(F.col("nt") * F.col("ne") > HOT_PAIRS).select("sig", F.least(wide, F.lit(MAX_PARTS)).alias("parts")), "hot"))
    parts = F.coalesce("parts", F.lit(1))
    t = t.join(hot, "sig", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    e = e.join(hot, "sig", "left").withColumn("part", F.pmod(F.xxhash64("class_e"), parts).cast("int")).drop("parts")
    pairs = t.join(e, ["sig", "part"]).where((F.abs(F.col("len_t") - F.col("len_e")) <= max_edits) & (F.col("class_t") != F.col("class_e")))
    pairs = stored(pairs.select("class_t", "class_e").distinct(), "candidates")
    words = classes.select("class", "words")
    met = lookup(pairs, words.withColumnsRenamed({"class": "class_t", "words": "wt"}), ["class_t"], "class_e", may_broadcast=False)
    met = lookup(met, words.withColumnsRenamed({"class": "class_e", "words": "we"}), ["class_e"], "class_t", may_broadcast=False)
    fits = F.size(F.array_distinct(F.concat("wt", "we"))) <= len(_ALPHABET)
    near = met.where(fits).where(word_distance(F.col("wt"), F.col("we"), max_edits) >= 0)
    far = met.where(~fits).where(_within_long("wt", "we", F.lit(max_edits)))
    same = classes.where("in_train and in_eval").select(F.col("class").alias("class_t"), F.col("class").alias("class_e"))
    links = near.select("class_t", "class_e").unionByName(far.select("class_t", "class_e")).unionByName(same)
    return members, links


def expanded(members: DataFrame, links: DataFrame) -> DataFrame:
    """(train_id, eval_id) of every linked pair of members."""
    t = members.where("side = 'train'").select(F.col("id").alias("train_id"), F.col("class").alias("class_t"))
    e = members.where("side = 'eval'").select(F.col("id").alias("eval_id"), F.col("class").alias("class_e"))
    return links.join(t, "class_t").join(e, "class_e").select("train_id", "eval_id")


def overlap_report(texts: DataFrame, members: DataFrame, links: DataFrame) -> DataFrame:
    """Per split and source: records, records with an exact copy in train, records with a near or exact one.

    ``texts`` is the input with split and source; counting needs no pairs.
    """
    evals = texts.where("side = 'eval'").select("id", "split", "source").distinct()
    hit = links.groupBy(F.col("class_e").alias("class")).agg(F.max(F.col("class_t") == F.col("class_e")).alias("exact"))
    joined = evals.join(members.where("side = 'eval'").select("id", "class"), "id", "left").join(hit, "class", "left")
    return joined.groupBy("split", "source").agg(
        F.count("*").alias("records"), F.count_if(F.col("exact")).alias("exact"), F.count_if(F.col("exact").isNotNull()).alias("near_or_exact")
    )
