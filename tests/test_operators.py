import random

import pytest
from pyspark.sql import functions as F

from stepweave.operators import align, keys, sampling, sequences, setops, validate


def fill_oracle(values, strategy):
    if strategy == "exact" or all(v is None for v in values):
        return values
    first = next(v for v in values if v is not None)
    if strategy == "broadcast":
        return [first] * len(values)
    out, last = [], first
    for v in values:
        last = v if v is not None else last
        out.append(last)
    return out


@pytest.mark.parametrize("strategy", ["exact", "nearest", "broadcast"])
def test_fill_against_plain_python(spark, strategy):
    rng = random.Random(5)
    rows = [(k, i, rng.choice([None, None, None, f"t{k}.{i}"])) for k in range(12) for i in range(rng.randrange(1, 30))]
    steps = spark.createDataFrame([r[:2] for r in rows], "k int, i int")
    notes = spark.createDataFrame([r for r in rows if r[2]] + [(0, 999, "beyond")], "k int, i int, trace string")
    got = {(r.k, r.i): (r.trace, r.alignment_confidence) for r in align.aligned(steps, notes, ["k"], "i", "trace", strategy).collect()}
    assert len(got) == len(rows)
    for k in range(12):
        mine = [r for r in rows if r[0] == k]
        for r, want in zip(mine, fill_oracle([r[2] for r in mine], strategy)):
            assert got[k, r[1]] == (want, 1.0 if r[2] else 0.7 if want else 0.0)


def test_unknown_strategy():
    with pytest.raises(ValueError):
        align.check_strategy("linear")


def test_keys(spark):
    df = spark.createDataFrame([("/nfs/data/out.npy", 42), ("a\\b", 1), ("x", None)], "p string, n int")
    assert [r[0] for r in df.select(keys.composite_key(F.col("p"), F.col("n"))).collect()] == ["nfs/data/out.npy_42", "a/b_1", None]
    assert df.select(keys.path_key(F.lit("/s"), F.lit("e"))).first()[0] == "s"
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 1, "d")], "k int, o int, v string")
    assert sorted(r.v for r in keys.last_wins(rows, ["k"], [F.col("o")]).collect()) == ["b", "c", "d"]


def test_clean_trace(spark):
    df = spark.sql("select named_struct('task_reasoning', ' a ', 'plan', 'p', 'move_reason', 'n/a') t union all select null")
    fields = ("task_reasoning", "plan", "move_reason")
    rows = df.select(align.clean_trace(F.col("t"), fields).alias("t"), align.clean_trace(F.col("t"), fields, strict=True).alias("s")).collect()
    assert rows[0].t.asDict() == {"task_reasoning": "a", "plan": "p", "move_reason": None}
    assert rows[0].s.plan is None and rows[1].t is None


def test_matching(spark):
    d = spark.createDataFrame([("a_1", "a", 1), ("a_2", "a", 2), (None, "b", 3)], "join_key string, path string, e int")
    n = spark.createDataFrame([("a_1", "a"), ("zz", "b"), ("yy", "q")], "join_key string, path string")
    got = align.matched_or_path(n, d, "join_key", "path", ["e"], [F.col("e")]).collect()
    assert sorted((r.join_key, r.e, r.matched_by) for r in got) == [("a_1", 1, "key"), ("zz", 3, "path")]
    assert align.matched_inner(d, n.select("join_key")).count() == 1
    assert align.unmatched(d, n).count() == 2
    c = align.match_counts(d, n).first()
    assert (c.demonstrations, c.matched, c.unmatched, c.match_rate) == (3, 1, 2, 0.3333)


def _episode(n=10, **changes):
    rows = [{"key": 1, "pos0": i, "step_index": i, "is_first": i == 0, "is_last": i == n - 1, "action": [0.1] * 7, "has_trace": i % 2 == 0, "has_image": True} for i in range(n)]
    for i, change in changes.pop("rows", {}).items():
        rows[i].update(change)
    return rows


SCHEMA = "key int, pos0 int, step_index int, is_first boolean, is_last boolean, action array<float>, has_trace boolean, has_image boolean"


def _check(spark, rows, rules=validate.Rules(), **episode):
    e = {"key": 1, "episode_id": "e", "schema_version": "1.0", "task_description": "t", "strategy": "nearest", "declared_steps": 10} | episode
    eps = spark.createDataFrame([tuple(e.values())], "key int, episode_id string, schema_version string, task_description string, strategy string, declared_steps int")
    steps = spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in rows], SCHEMA)
    return validate.validated(eps, steps, "key", ["pos0"], rules).first()


def test_validation(spark):
    good = _check(spark, _episode())
    assert good.passed and not good.warnings and good.reasoning_coverage == 0.5
    assert _check(spark, []).errors == ["Episode has 0 steps; minimum is 1."]
    assert _check(spark, _episode(rows={3: {"action": [0.0] * 3}})).errors == ["Step 3: action shape is (3,), expected (7,)."]
    assert _check(spark, _episode(rows={2: {"step_index": 99}})).errors == ["step_index mismatch at position 2: expected 2, got 99."]
    assert _check(spark, _episode(rows={0: {"is_first": False}})).errors == ["Expected exactly 1 is_first step, found 0."]
    assert _check(spark, _episode(rows={0: {"is_first": False}, 1: {"is_first": True}})).errors == ["is_first is not on step 0."]
    assert _check(spark, _episode(rows={i: {"action": [0.0] * 7} for i in range(6)})).warnings == ["60% of actions are all-zeros — possible data issue."]
    warned = _check(spark, _episode(), validate.Rules(min_coverage=0.99), schema_version=None, task_description="", strategy="odd", declared_steps=9)
    assert len(warned.warnings) == 5 and warned.passed
    assert _check(spark, _episode(rows={i: {"has_image": False} for i in range(10)}), validate.Rules(require_images=True)).warnings == ["No step has an image."]
    assert not _check(spark, _episode(), episode_id="").passed


def keyframe_oracle(actions, threshold, most):
    n = len(actions)
    hit = {0, n - 1}
    for i in range(1, n):
        a, b = actions[i], actions[i - 1]
        if abs(a[6] - b[6]) > threshold or sum((a[k] - b[k]) ** 2 for k in range(3)) ** 0.5 > threshold:
            hit.add(i)
    out = sorted(hit)
    if most is not None and len(out) > most:
        out = [out[round(i * len(out) / most)] for i in range(most) if round(i * len(out) / most) < len(out)]
    return out


@pytest.mark.parametrize("most", [None, 4, 7])
def test_keyframes_against_plain_python(spark, most):
    rng = random.Random(3)
    eps = {k: [[rng.choice([0.0, 0.03125, 0.5]) for _ in range(7)] for _ in range(rng.randrange(1, 25))] for k in range(10)}
    df = spark.createDataFrame([(k, i, a) for k, v in eps.items() for i, a in enumerate(v)], "k int, i int, action array<double>")
    for r in sampling.keyframes(df, "k", "i", threshold=0.05, most=most).collect():
        assert r.frames == keyframe_oracle(eps[r.k], 0.05, most)


def test_nan_is_no_keyframe(spark):
    df = spark.createDataFrame([(0, 0, [0.0] * 7), (0, 1, [float("nan")] * 7), (0, 2, None), (0, 3, [0.0] * 7)], "k int, i int, action array<double>")
    assert sampling.keyframes(df, "k", "i").first().frames == [0, 3]


def test_phases_and_transitions(spark):
    df = spark.createDataFrame([(1, i, float(g)) for i, g in enumerate([0, 0, 1, 1, 0, 1, 0, 0])], "k int, i int, g double")
    assert [r.i for r in sequences.transitions(df, "k", "i", "g").orderBy("i").collect()] == [2, 4, 5, 6]
    assert [(r.start, r.end) for r in sequences.phases(df, "k", "i", F.col("g") > 0.5).orderBy("start").collect()] == [(0, 2), (2, 4), (4, 5), (5, 6), (6, 8)]


def test_sets(spark):
    a, b = spark.createDataFrame([("x",), ("y",), (None,)], "key string"), spark.createDataFrame([("y",), ("z",), ("y",)], "key string")
    r = setops.overlap_counts(a, b, "key").first()
    assert (r.left_keys, r.right_keys, r.both, r.only_left, r.only_right, r.either, r.share_only_left) == (2, 2, 1, 1, 1, 3, 50.0)


def test_rollup_keeps_null_split(spark):
    df = spark.createDataFrame([("a", True), (None, False)], "split string, w boolean")
    assert {(r.split, r.written) for r in sequences.split_rollup(df, "split", F.col("w")).collect()} == {("a", 1), (None, 1), ("Total", 2)}


def test_join_heads_spreads_hot_keys(spark):
    from stepweave.operators.skew import join_heads
    from stepweave.session import stored

    rows = spark.createDataFrame([(1, i) for i in range(200)] + [(2, 500)], "k int, id long")
    heads = stored(rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("h")), "h")
    got = join_heads(rows, heads, ["k"], "n", "id", hot_rows=50, fanout=8)
    assert sorted((r.k, r.id, r.h) for r in got.collect()) == sorted((r.k, r.id, 0 if r.k == 1 else 500) for r in rows.collect())


def test_lookup_is_a_left_join_whatever_the_size(spark, monkeypatch):
    from stepweave.operators import skew

    rows = spark.range(300).selectExpr("case when id % 10 = 9 then null else if(id < 200, 0, id) end as k", "id")
    table = spark.range(0, 250, 2).selectExpr("id as k", "id * 2 as v")
    want = {(r.k, r.id, r.v) for r in rows.join(table, "k", "left").collect()}
    assert {(r.k, r.id, r.v) for r in skew.lookup(rows, table, ["k"], "id").collect()} == want
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(skew, "small_side", lambda df, max_rows=10: df)
    got = skew.lookup(rows, table, ["k"], "id", hot_rows=50).collect()
    assert len(got) == 300 and {(r.k, r.id, r.v) for r in got} == want


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    from stepweave.session import shared_dir

    def session(master, named, app):
        conf = SimpleNamespace(get=lambda key, default: named or default)
        return SimpleNamespace(sparkContext=SimpleNamespace(applicationId=app, getConf=lambda: conf, master=master))

    assert shared_dir(session("spark://host:7077", "hdfs://n/shared/", "a")) == "hdfs://n/shared"
    assert shared_dir(session("local[4]", None, "b")).startswith("file:///")
    with pytest.raises(RuntimeError):
        shared_dir(session("spark://host:7077", None, "c"))


def test_long_rows_are_not_broadcast(spark, monkeypatch):
    from stepweave.operators import skew

    few = spark.range(10).selectExpr("id", "repeat('x', 1000) as t", "array(id, id) as a")
    assert skew.small_side(few) is not few and skew.small_side(few, 5) is few
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 5000)
    assert skew.small_side(few) is few
