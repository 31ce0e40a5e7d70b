import json
import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stepweave.llm import dedupe


def canon(t):
    t = t if t.isascii() else unicodedata.normalize("NFC", t)
    return "".join((c.lower() if len(c.lower()) == 1 else c) for c in t if c.isalpha() or unicodedata.category(c)[0] == "N")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=12))
def test_hashes_follow_the_canonical_text(texts):
    h1, h2, kept = dedupe.poly_hashes(texts)
    seen = {}
    for t, *h in zip(texts, h1, h2, kept):
        assert h[2] == len(canon(t))
        assert seen.setdefault(canon(t), h) == h


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30), st.text(max_size=30))
def test_comparison(a, b):
    assert dedupe.same_writing(a, b) == (canon(a) == canon(b))
    assert dedupe.same_writing(a, a.upper().lower()) == (canon(a) == canon(a.upper().lower()))


def test_long_texts_in_blocks():
    a = "ab, " * 40_000
    assert dedupe.same_writing(a, "AB" * 40_000) and not dedupe.same_writing(a, "AB" * 40_000 + "c")
    h = dedupe.poly_hashes([a, "AB" * 40_000, "ab" * 39_999])
    assert h[0][0] == h[0][1] != h[0][2]


@pytest.mark.parametrize("kind", ["text", "record"])
def test_groups_against_brute_force(spark, kind):
    rng = random.Random(7)
    rows = []
    for i in range(300):
        word = rng.choice(["go up", "café, 7", "stop!", "", "  "])
        text = "".join(rng.choice([c, c.upper()]) + rng.choice(["", "", "-", "​"]) for c in word)
        if kind == "record":
            fields = [("a", text), ("n", rng.choice([7, "7"]))] + ([("c", None)] if rng.random() < 0.3 else [])
            rng.shuffle(fields)
            text = json.dumps(dict(fields), ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1])) if rng.random() < 0.9 else "{broken " + word
        rows.append((rng.randrange(1000), text))
    rows += rows[:20] + [(None, "x"), (5000, None)]

    def key(t):
        f = dedupe.record_fields(t) if kind == "record" else None
        return canon(t) if f is None else tuple(sorted((k, canon(v)) for k, v in f.items()))

    heads = {}
    for i, t in rows:
        if i is not None and t is not None:
            heads[key(t)] = min(i, heads.get(key(t), i))
    want = {(i, heads[key(t)]) for i, t in rows if i is not None and t is not None}
    df = spark.createDataFrame(rows, "id long, text string").selectExpr("*", "1 as h", "2 as kept", "3 as n", "4 as head")
    got = [(r.id, r.keep_id) for r in dedupe.writing_groups(df, "id", "text", kind).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_colliding_hashes_are_told_apart(spark, monkeypatch):
    import numpy as np
    from pyspark import cloudpickle

    def same_for_all(texts):
        z = np.zeros(len(texts), np.uint64)
        return z, z, np.zeros(len(texts), np.int64)

    cloudpickle.register_pickle_by_value(__import__("sys").modules[__name__])
    monkeypatch.setattr(dedupe, "poly_hashes", same_for_all)
    df = spark.createDataFrame([(1, "a b"), (2, "AB"), (3, "c"), (4, "C!"), (5, "d")], "id long, text string")
    got = sorted((r.id, r.keep_id) for r in dedupe.writing_groups(df, "id", "text").collect())
    assert got == [(1, 1), (2, 1), (3, 3), (4, 3), (5, 5)]


def test_edges(spark):
    assert dedupe.writing_groups(spark.createDataFrame([], "id long, text string"), "id", "text").count() == 0
    groups = dedupe.writing_groups(spark.createDataFrame([(1, ""), (2, "?!"), (3, "x")], "id long, text string"), "id", "text")
    assert [tuple(r) for r in dedupe.copies(groups).collect()] == [(1, 2)]
    assert sorted((r.keep_id, r.copies) for r in dedupe.collapsed(groups).collect()) == [(1, 2), (3, 1)]
    assert dedupe.record_fields("[1]") is None and dedupe.record_fields('{"a": {"b": [1, true, null]}}') is not None
    assert dedupe.same_record('{"a": 1, "b": "X y"}', '{"b": "xY", "a": "1"}') and not dedupe.same_record('{"a": 1}', '{"a": 1, "b": null}')
