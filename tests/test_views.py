import json

import pytest
from pyspark.sql import functions as F

from stepweave import cli
from stepweave.operators import views
from stepweave.sources import export, lines


@pytest.fixture(scope="module")
def steps(spark):
    return spark.sql("""select e, cast(i as int) step_index, if(i % 2 = 0, named_struct('task_reasoning', 't'), null) reasoning, if(i % 2 = 0, 1.0D, 0.7D) alignment_confidence,
        array(0f,1f,2f,3f,4f,5f, if(i > 3, 1f, 0f)) action, if(i = 2, null, array(1f,2f,3f,4f,5f,6f,7f)) state from values ('a'), ('b') v(e) cross join range(10) r(i)""")


def test_step_views(spark, steps):
    assert views.annotated_steps(steps).count() == 10 and views.high_confidence_steps(steps).count() == 10
    assert views.step_at(steps, "e", "a", 3).first().step_index == 3
    with pytest.raises(IndexError):
        views.step_at(steps, "e", "a", 10)
    assert [r.step_index for r in views.frame_strip(steps, "e", 4).where("e = 'a'").orderBy("step_index").collect()] == [0, 3, 6, 9]
    named, phases = views.gripper_view(steps, "e", F.get("action", 6))
    assert named.where("label = 'CLOSE'").count() == 12
    assert sorted((r.start, r.end) for r in phases.where("e = 'a'").collect()) == [(0, 4), (4, 10)]
    assert views.state_view(steps, "e").count() == 18
    assert views.action_view(steps, "e").first().xyz == [0, 1, 2]
    s = views.episode_summary(steps, "e").first()
    assert (s.steps, s.with_reasoning, s.share) == (10, 5, 0.5)


def test_numbering_is_dense_over_all_rows(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("v"))
    assert all(r.v == r.number for r in views.numbered_rows(df, ["v"]).collect())
    assert sorted(r.number for r in views.numbered_rows(df.withColumn("g", F.col("v") % 2), ["v"], ["g"]).collect()) == sorted([*range(250)] * 2)


def test_small_helpers(spark, steps):
    df = spark.sql("select array(1,2,3) a, array('x','y') b, binary('') d, cast(null as string) p")
    row = df.select(views.zipped(F.col("a"), F.col("b")).alias("z"), views.has_image(F.lit(None), F.col("p")).alias("h"), views.provenance(F.lit("n"), F.lit("d"), F.lit("b"), F.lit("m")).alias("o")).first()
    assert [tuple(x) for x in row.z] == [(1, "x"), (2, "y")] and row.h is False and row.o.schema_version == "1.0"
    obs = steps.select(views.enriched_observation(steps.columns).alias("o")).first().o
    assert obs.image is None and obs.depth_map.valid is False
    assert views.preview(steps.withColumn("reasoning", F.struct(*[F.lit("x" * 50).alias(c) for c in ("task_reasoning", "subtask_reasoning", "move_reasoning")]))).first().task_reasoning == "x" * 35 + "..."
    eps = spark.createDataFrame([("f1", "1"), ("f1", "2"), ("f2", "3")], "path string, e string")
    assert {(r.path, r.episodes, r.first_episode) for r in views.file_counts(eps, "path", "e").collect()} == {("f1", 2, "1"), ("f2", 1, "3")}
    k = views.key_stats(eps, "path").first()
    assert (k.files, k.episodes, k.sample) == (2, 3, ["f1", "f2"])
    assert sorted(map(tuple, views.shuffled(eps).collect())) == sorted(map(tuple, eps.collect()))


def test_flat_export(spark):
    s = spark.sql("select 'a' e, 0 i, array(1f) action, 'train' split, named_struct('task_reasoning','t','plan','','subtask_reasoning','','subtask_reason','','move_reasoning','','move_reason','') reasoning")
    flat = views.flat_export(export.nested_episodes(s, "e", "i", {"split": F.col("split")})).first()
    assert flat.reasoning_task == "t" and flat.reasoning_plan is None and flat.action[0] == 1 and flat.split == "train"


def test_lines_and_validation_command(spark, steps, tmp_path):
    eps = spark.createDataFrame([("a", "1.0", "do"), ("b", "1.0", "do")], "episode_id string, schema_version string, task_description string")
    marked = steps.withColumnRenamed("e", "episode_id").withColumn("is_first", F.col("step_index") == 0).withColumn("is_last", F.col("step_index") == 9).drop("reasoning")
    export.write_jsonl(lines.episode_lines(eps, marked), str(tmp_path / "l"))
    back, back_steps = lines.read_episodes(spark, str(tmp_path / "l"))
    assert back.count() == 2 and [r.step_index for r in back_steps.where("episode_id = 'b'").collect()] == list(range(10))
    assert cli.main(["validate", str(tmp_path / "l"), "--report", str(tmp_path / "r.json")]) == 0
    (tmp_path / "bad.jsonl").write_text(json.dumps({"episode_id": "x", "steps": [{"step_index": 3, "is_first": True, "is_last": True}]}) + "\n")
    _, s = lines.read_episodes(spark, str(tmp_path / "bad.jsonl"))
    assert s.first().alignment_confidence == 1.0 and s.first().action == [0.0] * 7
    assert cli.main(["validate", str(tmp_path / "bad.jsonl"), "--report", str(tmp_path / "r.json")]) == 1
    assert json.loads((tmp_path / "r.json").read_text())["failed"] == 1


def test_curate_and_generate_commands(spark, tmp_path):
    notes = {"p/out.npy": {"7": {"metadata": {"n_steps": 3, "language_instruction": "go"}, "reasoning": {"0": {"task": "t"}}}}}
    (tmp_path / "notes.json").write_text(json.dumps(notes))
    spark.createDataFrame([("e1", "/p/out.npy", 7, "go"), ("e2", "q", 1, "stay")], "episode_id string, source_file string, episode_num int, language_instruction string").write.parquet(str(tmp_path / "demo/episodes"))
    rows = [(e, i, [0.1] * 7, i == 0, i == 2, "go") for e in ("e1", "e2") for i in range(3)]
    spark.createDataFrame(rows, "episode_id string, step_index int, action array<float>, is_first boolean, is_last boolean, language_instruction string").write.parquet(str(tmp_path / "demo/steps"))
    (tmp_path / "c.yaml").write_text(f"annotations: {{local_path: {tmp_path}/notes.json}}\ndemonstrations: {{local_path: {tmp_path}/demo}}\noutput_dir: {tmp_path}/out\n")
    assert cli.main(["curate", "--config", str(tmp_path / "c.yaml")]) == 0
    out = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.variant, r.episode_id) for r in out.collect()} == {("matched", "e1"), ("reasoning_only", "e1")}
    assert [s.reasoning.task for s in out.first().steps] == ["t", "t", "t"]
    (tmp_path / "g.yaml").write_text(f"dataset: {{local_path: {tmp_path}/notes.json}}\noutput_dir: {tmp_path}/gen\n")
    assert cli.main(["generate", "--config", str(tmp_path / "g.yaml")]) == 0
    assert spark.read.json(str(tmp_path / "gen")).count() == 3
    assert cli.main(["generate", "--config", str(tmp_path / "g.yaml")]) == 0
    assert spark.read.json(str(tmp_path / "gen")).count() == 3
    assert cli.main(["show", str(tmp_path / "notes.json")]) == 0
