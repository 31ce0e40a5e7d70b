import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stepweave.functions import arrays, images, reply, text
from stepweave.operators import sampling


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {t}" for k, t in _types(values))) if values else spark.range(1)
    return df.select(expr).first()[0]


def _types(values):
    for k, v in values.items():
        yield k, "string" if isinstance(v, str) or v is None else "array<double>" if isinstance(v, list) else "int"


@pytest.mark.parametrize("raw, want", [("  a b ", "a b"), ("N/A", None), (" Unknown ", None), ("...", None), ("-", None), ("--", "--"), ("none.", "none."), ("", None), (None, None), (" \x1c", None), ("n/a x", "n/a x")])
def test_clean_field(spark, raw, want):
    assert one(spark, text.clean_field(F.col("x")), x=raw) == want


def test_json_texts(spark):
    assert one(spark, text.strip_fences(F.col("x")), x="```json\n[1]\n```") == "[1]"
    assert one(spark, text.fix_trailing_commas(F.col("x")), x='{"a": [1, ], }') == '{"a": [1]}'
    assert one(spark, text.json_block(F.col("x")), x='so: {"a": 1} end') == '{"a": 1}'
    assert one(spark, text.json_block(F.col("x")), x='x [{"a":"b]c"}] y') == '[{"a":"b]'
    assert one(spark, text.safe_path_part(F.col("x")), x="/a\\b:c/") == "a_b_c"
    assert one(spark, text.percent(F.lit(0.125))) == "12%"
    assert one(spark, text.head(F.col("x"), 3), x="abcd") == "abc..." and one(spark, text.tail(F.col("x"), 3), x="abc") == "abc"
    assert text.wrapped("aa bb cc", 5) == "aa bb\ncc" and text.wrapped(None, 5) == "—"


def test_padding(spark):
    assert one(spark, arrays.pad7(F.col("x")), x=[1.0, 2.0]) == [1, 2, 0, 0, 0, 0, 0]
    assert one(spark, arrays.pad7(F.col("x")), x=[float(i) for i in range(9)]) == [0, 1, 2, 3, 4, 5, 6]
    assert one(spark, arrays.cut2(F.col("x")), x=[1.0, 2.0, 3.0]) == [1, 2]
    assert one(spark, arrays.norm(F.col("x")), x=[3.0, 4.0]) == 5
    assert one(spark, arrays.all_zero(F.col("x")), x=[0.0, 1e-9]) is True
    assert one(spark, arrays.all_zero(F.col("x")), x=[0.0, float("nan")]) is False
    assert spark.sql("select cast(null as array<float>) x").select(arrays.pad_state_3d(F.col("x"))).first()[0] == [0, 0, 0]
    action = one(spark, arrays.named_action(F.col("x").cast("array<float>")), x=[float(i) for i in range(7)])
    assert action.delta_x == 0 and action.gripper == 6
    with pytest.raises(Exception, match="seven"):
        one(spark, arrays.named_action(F.col("x").cast("array<float>")), x=[1.0])


def _uniform(n, k):
    return list(range(n)) if n <= k else [0] if k == 1 else [round(i * (n - 1) / (k - 1)) for i in range(k)]


@pytest.mark.parametrize("k", [1, 2, 5, 8])
def test_uniform_frames(spark, k):
    rows = spark.range(0, 60).select("id", sampling.uniform_frames(F.col("id").cast("int"), k).alias("f"), sampling.spaced_frames(F.col("id").cast("int"), k).alias("g")).collect()
    for r in rows:
        assert r.f == _uniform(r.id, k)
        if r.id:
            assert r.g == np.linspace(0, r.id - 1, k, dtype=int).tolist()


@pytest.mark.parametrize(
    "raw, frames, want",
    [
        ('[{"frame_index": 0, "task": "A"}, {"frame_index": 5, "task_reasoning": " B "}]', [0, 5], [(0, "A"), (5, "B")]),
        ('```json\n[{"frame_index": 0, "goal": "A"},]\n```', [0], [(0, "A")]),
        ('[{"task_reasoning":"A"},{"task_reasoning":"B"}]', [3, 7], [(3, "A"), (7, "B")]),
        ("bad", [0, 3], [(0, None), (3, None)]),
        (None, [1], [(1, None)]),
        ('{"task_reasoning": 5, "task": "x"}', [2, 4], [(2, "x"), (4, None)]),
        ('[{"frame_index": "two", "task": "A"}, 7, {"frame_index": 9, "task": "C"}]', [1, 2, 3], [(1, "A"), (2, None), (3, "C")]),
        ("null", [1], [(1, None)]),
    ],
)
def test_parse_episode(raw, frames, want):
    got = reply.parse_episode(raw, frames)
    assert [(r[0], r[1]) for r in got] == want
    assert all(r[-1] == (raw or "") for r in got)


def test_parsed_reply_takes_the_last(spark):
    df = spark.createDataFrame([('[{"frame_index": 1, "task": "A"}, {"frame_index": 1, "task": "B"}]', [1]), (None, None)], "t string, f array<int>")
    rows = df.select(reply.parsed_reply(F.col("t"), F.col("f")).alias("p")).collect()
    assert [x.task_reasoning for x in rows[0].p] == ["B"] and rows[1].p == []


def test_parse_step():
    assert reply.parse_step('[{"move_reasoning": "m"}]')[2] == "m"
    assert reply.parse_step("no")[-1] == "no"


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9))
def test_png_round_trip(h, w):
    im = np.random.default_rng(h * 10 + w).integers(0, 255, (h, w, 3), dtype=np.uint8)
    assert (images.png_decode(images.png_encode(im)) == im).all()


def test_images(spark):
    assert images.as_rgb(None, 4).sum() == 0
    assert images.as_rgb(bytes([9] * 16), 2).tolist() == [[[9, 9, 9]] * 2] * 2
    assert images.resized(np.full((3, 5, 3), 7, np.uint8), 6, 6).tolist() == np.full((6, 6, 3), 7).tolist()
    df = spark.createDataFrame([(None,), (b"",), (b"\0\0\0",), (b"\0\1\0",)], "i binary")
    assert [r[0] for r in df.select(images.has_content(F.col("i"))).collect()] == [False, False, False, True]
    assert len(df.select(images.ensured(F.col("i"), 2)).first()[0]) == 12
