"""Runs of repeated consecutive events in ordered sequences.

Events are mapped to Unicode code points, a sequence becomes a string, and a
back-reference pattern finds the runs. A sequence is cut into chunks of
``CHUNK`` positions, so that an entity of any length is spread over tasks; runs
that touch a chunk's edge are joined afterwards.
"""

from __future__ import annotations

import re

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepweave.operators.skew import small_side
from stepweave.session import stored

CHUNK = 2048
#: One distinct code point for every different label that a chunk can hold.
_ALPHABET = "".join(map(chr, range(0x4E00, 0x4E00 + CHUNK)))
_GAP, _NONE = "\x01", "\x02"
_RUN = re.compile(r"([^\x01\x02])\1*")


def label_form(label: Column) -> Column:
    """Lower-case words of a label in alphabetical order, NULL if it has none."""
    words = F.trim(F.regexp_replace(F.lower(label), r"[^\p{L}\p{N}]+", " "))
    return F.when(words != "", F.array_join(F.array_sort(F.split(words, " ")), " "))


def _slip_keys(form: str, joined: str):
    """(key, role) pairs of a form: two forms are one slip apart if they share a
    key as 'sub'/'sub' or 'joined'/'joined', or one has it as 'self' and the other as 'del'."""
    yield "j" + joined, "joined"
    words = form.split(" ")
    for i, w in enumerate(words):
        rest = "d" + xxhash.xxh3_128_hexdigest(" ".join(words[:i] + words[i + 1 :])) + "\x1f"
        yield rest + w, "self"
        for k in range(len(w)):
            yield f"s{rest}{w[:k]}\x1f{w[k + 1:]}", "sub"
            if len(w) > 1:
                yield rest + w[:k] + w[k + 1 :], "del"


def slip_map(forms: DataFrame) -> DataFrame:
    """(form, canon) for every form that is one letter's slip of a more frequent one.

    ``forms`` has form, joined (the words in their first order, put together)
    and n. A form goes to the most frequent form within one slip of it (ties:
    the alphabetically last); a form that is itself the most frequent stays. No
    pairs are made: each key passes on only its most frequent form.
    """

    def keys(batches):
        for pdf in batches:
            out = [(k, role, f, n) for f, j, n in zip(pdf.form, pdf.joined, pdf.n) for k, role in set(_slip_keys(f, j))]
            yield pd.DataFrame(out, columns=["key", "role", "form", "n"])

    exploded = forms.mapInPandas(keys, "key string, role string, form string, n long")
    at = Window.partitionBy("key")
    best = lambda *roles: F.max(F.when(F.col("role").isin(*roles), F.struct("n", "form"))).over(at)
    other = F.when(F.col("role") == "self", best("del")).when(F.col("role") == "del", best("self")).otherwise(best("sub", "joined"))
    return (
        exploded.withColumn("other", other)
        .groupBy("form")
        .agg(F.max("n").alias("n"), F.max("other").alias("other"))
        .where((F.col("other.n") > F.col("n")) | ((F.col("other.n") == F.col("n")) & (F.col("other.form") > F.col("form"))))
        .select("form", F.col("other.form").alias("canon"))
    )


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _spans(symbols: pd.Series) -> pd.Series:
    """Start and length of each run, flat, in positions that don't count gaps."""

    def one(s: str) -> list[int]:
        gaps, out = _GAP in s, []
        for m in _RUN.finditer(s):
            out += (m.start() - (s.count(_GAP, 0, m.start()) if gaps else 0), m.end() - m.start())
        return out

    return symbols.map(one)


def collapse_runs(
    events: DataFrame, entity: str, order: str, label: str, ts: str | None = None, min_len: int = 1, slips: bool = True
) -> DataFrame:
    """One row per run: entity, start, end, n, label (canonical), first_at, last_at, duration_s.

    Neighbouring events whose order rises by 1 form a run while their labels
    differ only in case, spacing, separators, word order or (``slips``) one
    letter. Runs of fewer than ``min_len`` events are left out.

    Nulls: rows without entity or order are skipped; a null or blank label, or
    a missing order value, ends a run. Repeated rows count once; of different
    rows with one order value the first by label, then time, counts. Without
    ``ts`` the times are null. An empty table gives no rows. Extra columns,
    whatever their names, are ignored.
    """
    stamp = F.col(ts) if ts else F.lit(None).cast("timestamp_ntz")
    plain = F.trim(F.regexp_replace(F.lower(F.col(label)), r"[^\p{L}\p{N}]+", " "))
    base = events.select(
        F.col(entity).alias("entity"), F.col(order).cast("long").alias("pos"), label_form(F.col(label)).alias("form"),
        F.regexp_replace(plain, " ", "").alias("joined"), stamp.alias("at"),
    ).where("entity is not null and pos is not null")
    if slips:
        forms = stored(base.where("form is not null").groupBy("form", "joined").agg(F.count("*").alias("n")), "forms")
        total = forms.groupBy("form").agg(F.sum("n").alias("total"))
        forms = forms.join(total, "form").select("form", "joined", F.col("total").alias("n"))
        moved = stored(slip_map(forms), "slips")
        base = base.join(small_side(moved), "form", "left").withColumn("form", F.coalesce("canon", "form"))

    chunk = F.floor(F.col("pos") / F.lit(CHUNK))
    item = F.struct("pos", F.col("form").isNull().alias("none"), "form", "at")
    chunks = base.groupBy("entity", chunk.alias("chunk")).agg(F.array_sort(F.collect_set(item)).alias("all"))
    events_at = F.filter("all", lambda x, i: (i == 0) | (x.pos != F.get(F.col("all"), i - 1).pos))
    chunks = chunks.select("entity", "chunk", events_at.alias("ev"))
    chunks = chunks.withColumn("names", F.array_distinct(F.transform("ev", lambda x: x.form)))

    def symbol(x: Column, i: Column) -> Column:
        gap = F.when((i > 0) & (x.pos != F.get(F.col("ev"), i - 1).pos + 1), F.lit(_GAP)).otherwise(F.lit(""))
        name = F.substring(F.lit(_ALPHABET), F.array_position(F.col("names"), x.form).cast("int"), F.lit(1))
        return F.concat(gap, F.when(x.none, F.lit(_NONE)).otherwise(name))

    spans = _spans(F.array_join(F.transform("ev", symbol), ""))
    runs = chunks.select("entity", "chunk", "ev", spans.alias("sp")).where("size(sp) > 0")
    runs = runs.select("*", F.explode(F.expr("sequence(0, size(sp) - 2, 2)")).alias("k"))
    first = F.get("ev", F.get("sp", F.col("k")))
    last = F.get("ev", F.get("sp", F.col("k")) + F.get("sp", F.col("k") + 1) - 1)
    runs = runs.select("entity", "chunk", first.alias("a"), last.alias("b")).select(
        "entity", F.col("a.pos").alias("start"), F.col("b.pos").alias("end"), F.col("a.form").alias("label"),
        F.col("a.at").alias("first_at"), F.col("b.at").alias("last_at"),
        ((F.col("a.pos") == F.col("chunk") * CHUNK) | (F.col("b.pos") == F.col("chunk") * CHUNK + CHUNK - 1)).alias("edge"),
    ).where(F.col("edge") | (F.col("end") - F.col("start") + 1 >= min_len))
    runs = stored(runs, "runs")

    by_start = Window.partitionBy("entity").orderBy("start")
    opens = (F.lag("label").over(by_start).eqNullSafe(F.col("label")) & (F.lag("end").over(by_start) + 1 == F.col("start"))).cast("int")
    joined = (
        runs.where("edge")
        .withColumn("fresh", 1 - F.coalesce(opens, F.lit(0)))
        .withColumn("run", F.sum("fresh").over(by_start))
        .groupBy("entity", "run", "label")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"))
    )
    cols = ["entity", "start", "end", "label", "first_at", "last_at"]
    out = runs.where("not edge").select(cols).unionByName(joined.select(cols)).withColumn("n", F.col("end") - F.col("start") + 1)
    seconds = (F.unix_micros(F.col("last_at").cast("timestamp")) - F.unix_micros(F.col("first_at").cast("timestamp"))) / F.lit(1e6)
    return out.where(F.col("n") >= min_len).withColumn("duration_s", seconds)
