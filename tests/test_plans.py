import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from stepweave import config
from stepweave.plans import backends, generation
from stepweave.plans.backends import MockBackend, RateLimiter, Request, retried


def test_generate(spark):
    steps = spark.createDataFrame([(e, i) for e in ("a", "b") for i in range(5)], "e string, i int")
    eps = spark.createDataFrame([("a", "do a"), ("b", None)], "e string, task string")
    done = spark.createDataFrame([("b",)], "e string")
    out = generation.generate(eps, steps, "e", "i", "task", MockBackend("m"), done=done, n=2).orderBy("i").collect()
    assert [r.e for r in out] == ["a"] * 5 and [r.alignment_confidence for r in out] == [1.0, 0.7, 0.7, 0.7, 1.0]
    assert generation.generate(eps, steps, "e", "i", "task", MockBackend("m"), done=done, resume=False, n=2).select("e").distinct().count() == 2
    dry = generation.generate(eps, steps, "e", "i", "task", MockBackend("m"), dry_run=True, n=2).orderBy("e").first()
    assert dry.frames == [0, 4] and 'Task: "do a"' in dry.text and "[0, 4]" in dry.text


cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Failing(MockBackend):
    def generate(self, request):
        raise RuntimeError("down")


class Seeing(MockBackend):
    def generate(self, request):
        got = super().generate(request)
        got.model = " ".join(i.hex() if i[:4] != b"\x89PNG" else "png" for i in request.images)
        return got


def test_requests_carry_the_images_of_their_frames(spark):
    jpeg = lambda i: b"\xff\xd8\xff" + bytes([i])
    rows = [("a", 10 + i, None if i == 2 else bytes(12) if i == 8 else jpeg(i)) for i in range(9)] + [("b", 0, None), ("b", 1, b"")]
    steps = spark.createDataFrame(rows, "e string, i int, img binary").repartition(3)
    eps = spark.createDataFrame([("a", "t"), ("b", "t")], "e string, task string")
    asked = generation.prompts(eps, steps, "e", "i", "task", n=5, image="img")
    assert {r.e: [bytes(x) for x in r.images] for r in asked.collect()} == {"a": [jpeg(0), jpeg(4), jpeg(6), bytes(12)], "b": []}
    got = {r.e: r.result.model for r in generation.generated(asked, "e", Seeing("m")).collect()}
    assert got == {"a": "ffd8ff00 ffd8ff04 ffd8ff06 png", "b": ""}
    out = generation.generate(eps, steps, "e", "i", "task", Seeing("m"), n=5, image="img")
    assert "img" not in out.columns and out.count() == 11
    with pytest.raises(ValueError, match="takes no images"):
        generation.generated(asked, "e", backends.create_backend({"provider": "openai", "model_name": "text-1"}))
    png = backends.chat_messages(Request("t", [b"\x89PNG\r\n\x1a\n"]))
    assert png[0]["content"][0]["image_url"]["url"].startswith("data:image/png;base64,")


def test_a_failing_backend_keeps_the_rows(spark):
    eps, steps = spark.createDataFrame([("a", "t")], "e string, task string"), spark.createDataFrame([("a", 0)], "e string, i int")
    asked = generation.prompts(eps, steps, "e", "i", "task")
    got = generation.generated(asked, "e", Failing("m", max_retries=0)).first()
    assert got.result.finish_reason == "error" and got.result.text is None and got.result.metadata["error"] == "down"


class Moody(MockBackend):
    def generate(self, request):
        if '"bad' in request.text:
            raise RuntimeError("no")
        return super().generate(request)


def test_a_failing_request_costs_its_own_episode_only(spark):
    eps = spark.createDataFrame([(f"e{i}", "bad" if i == 3 else f"t{i}") for i in range(8)], "e string, task string").coalesce(1)
    steps = spark.createDataFrame([(f"e{i}", j) for i in range(8) for j in range(3)], "e string, i int").coalesce(1)
    backend = Moody("m", max_retries=0)
    got = {r.e: r.result for r in generation.generated(generation.prompts(eps, steps, "e", "i", "task").coalesce(1), "e", backend).collect()}
    assert {e for e, r in got.items() if r.finish_reason == "error"} == {"e3"} and got["e3"].metadata["error"] == "no" and all(got[e].text for e in got if e != "e3")
    out = generation.generate(eps, steps, "e", "i", "task", backend)
    assert out.count() == 21 and out.where("e = 'e3' or reasoning is null").count() == 0
    again = generation.generate(eps, steps, "e", "i", "task", MockBackend("m"), done=out.select("e"))
    assert [r.e for r in again.collect()] == ["e3"] * 3
    odd = steps.where("e = 'e1'").withColumn("img", F.lit(b"\1" * 5))
    asked = generation.prompts(eps, odd, "e", "i", "task", image="img")
    assert generation.generated(asked, "e", MockBackend("m")).first().result.finish_reason == "error"
    with pytest.raises(RuntimeError):
        backend.generate_batch([Request('"bad')])


class Single(MockBackend):
    """Answers about the one frame it is shown, with how many images came."""

    def generate(self, request):
        got = super().generate(request)
        got.text = '{"task": "seen %d", "motion": "%s"}' % (len(request.images), request.text.split("Step: ")[1].split()[0])
        return got


def test_a_request_for_each_sampled_frame(spark):
    steps = spark.createDataFrame([("a", i, b"\xff\xd8\xff" + bytes([i]) if i != 2 else None) for i in range(5)], "e string, i int, img binary")
    eps = spark.createDataFrame([("a", "t")], "e string, task string")
    out = generation.generate(eps, steps, "e", "i", "task", Single("m"), n=3, image="img", per_step=True).orderBy("i").collect()
    assert [(r.reasoning.task_reasoning, r.reasoning.move_reasoning, r.alignment_confidence) for r in out] == [
        ("seen 1", "0", 1.0), ("seen 1", "0", 0.7), ("seen 1", "2", 1.0), ("seen 1", "2", 0.7), ("seen 2", "4", 1.0)
    ]
    assert out[0].raw_response.startswith("{") and out[1].raw_response is None


def test_errors_are_kept_apart(spark, tmp_path):
    eps, steps = spark.createDataFrame([("a", "bad"), ("b", "t")], "e string, task string"), spark.createDataFrame([("a", 0), ("b", 0)], "e string, i int")
    out = generation.generate(eps, steps, "e", "i", "task", Moody("m", max_retries=0), errors=str(tmp_path / "errors"), raw=False)
    assert [r.e for r in out.collect()] == ["b"] and "raw_response" not in out.columns
    assert [(r.e, r.error) for r in spark.read.json(str(tmp_path / "errors")).collect()] == [("a", "no")]


def test_step_text(spark):
    df = spark.sql("select 't' as task, array('x','y') as c, array() as n")
    row = df.select(generation.step_text(F.col("task"), F.lit(3), F.col("c")).alias("a"), generation.step_text(F.col("task"), F.lit(3)).alias("b")).first()
    assert "Before: x / y" in row.a and "Before" not in row.b


def test_rate_limit_and_retry():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    r = RateLimiter(60, clock=lambda: now[0], sleep=sleep)
    for _ in range(3):
        r.acquire()
    assert slept == [1.0, 1.0]
    with pytest.raises(ValueError):
        RateLimiter(0)
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "ok"

    assert retried(flaky, sleep=lambda s: None) == "ok" and len(calls) == 3
    with pytest.raises(OSError):
        retried(lambda: (_ for _ in ()).throw(OSError()), retries=1, sleep=lambda s: None)


def test_registries():
    assert backends.create_backend({"provider": "mock", "model_name": "m"}).health_check()
    with pytest.raises(ValueError):
        backends.create_backend({"provider": "none", "model_name": "m"})
    m = backends.builtin_modalities()
    assert m.has("depth_map") and set(m.all()) == {"depth_map", "scene_graph"}
    with pytest.raises(KeyError):
        m.get("smell")
    messages = backends.chat_messages(Request("t", [b"x"], "s"))
    assert messages[0]["role"] == "system" and messages[1]["content"][0]["image_url"]["url"].startswith("data:image/jpeg;base64,")
    assert not backends.create_backend({"provider": "openai", "model_name": "text-1"}).supports_multimodal


def test_config(tmp_path, monkeypatch):
    p = tmp_path / "c.yaml"
    p.write_text("alignment_strategy: exact\nannotations:\n  local_path: /x\n")
    c = config.load(p, config.CurationConfig)
    assert c.annotations.local_path == "/x" and c.image_output_dir == "outputs/curated/images"
    with pytest.raises(ValueError):
        config.from_dict(config.CurationConfig, {"alignment_strategy": "odd"})
    with pytest.raises(ValueError):
        config.from_dict(config.CurationConfig, {"nothing": 1})
    with pytest.raises(ValueError):
        config.DemonstrationConfig(source="hdf5")
    with pytest.raises(ValueError):
        config.BackendConfig(provider="qwen", mode="local", local_model_path="/m")
    assert config.DatasetConfig(split="train+val, test").splits == ["train", "val", "test"]
    monkeypatch.setenv("OPENAI_API_KEY", "k")
    p.write_text("provider: openai\nmax_tokens: 5\n")
    b = config.load_backend(p)
    assert b.model_name == "gpt-4o" and b.max_tokens == 5
    p.write_text("provider: other\n")
    with pytest.raises(ValueError):
        config.load_backend(p)
