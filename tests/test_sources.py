import json
import os

import pytest
from pyspark.sql import functions as F

from stepweave.sources import annotations, demonstrations, export, files, tfrecord

TEXT = {"a/out.npy": {"42": {"metadata": {"n_steps": 3, "language_instruction": "go", "caption": "c"}, "features": {"move_primitive": ["up", None], "gripper_positions": [[1, 2, 3]], "state_3d": [[1, 2, 3, 4]], "bboxes": [[{"x": 1}]]},
        "reasoning": {"0": {"task": "t", "move": None}, "1": {}, "7": {"plan": "p"}}}, "43": {"metadata": {"n_steps": 0}, "reasoning": {"0": {"task": ""}, "1": {"task": "x"}}}, "44": 5, "45": {}}, "b": None}


@pytest.fixture
def annotated(tmp_path):
    (tmp_path / ".hidden.json").write_text("{}")
    (tmp_path / "dataset_info.json").write_text("{}")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "notes.json").write_text(json.dumps(TEXT))
    return str(tmp_path)


def test_annotations(spark, annotated):
    episodes, steps = annotations.read_annotations(spark, annotated)
    e = {r.source_episode_id: r for r in episodes.collect()}
    assert set(e) == {"42", "43", "45"} and (e["42"].n_steps, e["43"].n_steps, e["45"].n_steps) == (3, 2, 1)
    assert e["42"].join_key == "a/out.npy_42" and e["42"].language_instruction == "go"
    s = {r.step_index: r for r in steps.where("join_key = 'a/out.npy_42'").collect()}
    assert s[0].reasoning.task_reasoning == "t" and s[0].reasoning.move_reasoning == "" and s[1].reasoning is None
    assert s[0].move_primitive == "up" and s[1].move_primitive is None and s[2].move_primitive is None
    assert s[0].gripper_position == [1, 2] and s[0].state_3d == [1, 2, 3] and json.loads(s[0].bboxes) == [{"x": 1}]
    assert s[0].is_first and s[2].is_last
    some, _ = annotations.read_annotations(spark, annotated, require_reasoning=True, max_episodes=5)
    assert {r.source_episode_id for r in some.collect()} == {"42", "43"}


def test_find_and_versions(tmp_path):
    with pytest.raises(FileNotFoundError):
        files.find_json(str(tmp_path))
    for v in ("1.0.0", "2.0.0", "1.5.0", "10.0.0"):
        (tmp_path / v).mkdir()
        if v != "10.0.0":
            (tmp_path / v / "dataset_info.json").write_text("{}")
    assert files.version_dir(str(tmp_path)).endswith("2.0.0")
    with pytest.raises(FileNotFoundError):
        files.version_dir(str(tmp_path / "none"))


def test_jsonl(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"episode_id": "a"}\n\n{"episode_id": "b"}\n')
    assert files.count_lines(spark, str(p)) == 3
    assert sorted(r[0] for r in files.read_jsonl(spark, str(p), "episode_id string").collect()) == ["a", "b"]
    p.write_text('{"episode_id": "a"}\n{broken\n{"other": 1}\n')
    assert [r[0] for r in files.finished_ids(spark, str(p)).collect()] == ["a"]
    assert files.finished_ids(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(p), "episode_id string").collect()


def test_example_round_trip():
    features = {"a": {"bytes": [b"x", b""], "floats": None, "ints": None}, "b": {"bytes": None, "floats": [1.5, -2.0], "ints": None}, "c": {"bytes": None, "floats": None, "ints": [-1, 0, 1 << 40]}}
    assert tfrecord.decode_example(tfrecord.encode_example(features)) == features
    assert tfrecord.masked_crc(b"123456789") == (((0xE3069283 >> 15) | (0xE3069283 << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def test_tfrecord_round_trip(spark, tmp_path):
    tfrecord.register(spark)
    base = tmp_path / "d" / "1.0.0"
    base.mkdir(parents=True)
    (base / "dataset_info.json").write_text("{}")
    rows = [("p/q", i, [float(i)] * 7, f"w{i}", [0.5] * 7, bytes([i + 1]), {"task_reasoning": f"t{i}"}, [3.0, 4.0], f"m{i}") for i in range(4)] + [("", 0, [0.5] * 3, None, None, None, None, None, None)]
    ddl = "episode_id string, i int, action array<float>, language_instruction string, state array<float>, image_1 binary, reasoning map<string,string>, gripper_position array<float>, move_primitive string"
    trace = "named_struct('task_reasoning', reasoning['task_reasoning'], 'plan', '', 'subtask_reasoning', '', 'subtask_reason', '', 'move_reasoning', '', 'move_reason', '') as reasoning"
    steps = spark.createDataFrame(rows, ddl).selectExpr("* except (reasoning)", trace, "i = 0 as is_first", "float(i) as reward")
    export.write_tfrecord(export.nested_episodes(steps, "episode_id", "i", {"split": F.lit("train")}), str(base))
    reader = demonstrations.read_tfrecords(spark, str(tmp_path / "d"))
    eps = {r.source_file: r for r in reader.episodes.collect()}
    assert eps["p/q"].n_steps == 4 and eps["p/q"].language_instruction == "w0" and eps[""].episode_id.startswith("bridge_ep_")
    got = reader.steps.where("episode_id = 'p/q'").orderBy("step_index").collect()
    assert [r.action[0] for r in got] == [0, 1, 2, 3] and got[0].is_first and got[-1].is_last and got[1].discount == 1.0
    assert [r.reward for r in got] == [0, 1, 2, 3] and [bytes(r.image_1) for r in got] == [b"\1", b"\2", b"\3", b"\4"] and got[0].state == [0.5] * 7 and got[0].image_0 is None
    raw = spark.read.format("tfrecord").load(str(base)).where("decode(features['episode_metadata/file_path'].bytes[0], 'UTF-8') = 'p/q'").selectExpr("explode(features)").where("value is not null").collect()
    of = {r.key: r.value for r in raw if len(r.value["bytes"] or r.value["floats"] or r.value["ints"] or []) > 3}
    assert [bytes(x) for x in of["steps/reasoning/task"]["bytes"]] == [b"t0", b"t1", b"t2", b"t3"] and of["steps/ecot_features/gripper_position"]["floats"] == [3.0, 4.0] * 4
    assert {r.key: r.value["ints"] for r in raw if "has_image_1" in r.key and r.value["ints"] == [1]} and len(of["steps/language_embedding"]["floats"]) == 4 * 512
    assert [r.episode_id for r in demonstrations.read_tfrecords(spark, str(tmp_path / "d"), max_episodes=1).episodes.collect()] == [reader.take(1).first().episode_id]
    assert len(reader) == 2 and reader.take(0).count() == 0 and reader.load("p/q").count() == 1
    with open(next(str(p) for p in base.iterdir() if "tfrecord-" in p.name), "r+b") as f:
        f.truncate(20)
    left = spark.read.format("tfrecord").load(str(base))
    assert left.where("features is null").count() == 1 and demonstrations.read_tfrecords(spark, str(tmp_path / "d")).episodes.count() == left.where("features is not null").count()
    with pytest.raises(Exception):
        spark.read.format("tfrecord").option("mode", "failfast").load(str(base)).count()
    with pytest.raises(NotImplementedError):
        demonstrations.read_hdf5(spark, str(base))


def _nested(spark):
    steps = spark.sql("""select * from values ('a', 0, array(1f), 'train', named_struct('task_reasoning','t','plan','','subtask_reasoning','','subtask_reason','','move_reasoning','','move_reason','')),
        ('a', 1, null, 'train', null), ('b', 0, array(2f), 'val', null) t(episode_id, step_index, action, split, reasoning)""")
    return export.nested_episodes(steps, "episode_id", "step_index", {"split": F.col("split")})


def test_export(spark, tmp_path):
    eps = _nested(spark)
    rows = {r.episode_id: r for r in eps.collect()}
    assert rows["a"].has_reasoning and not rows["b"].has_reasoning
    s = rows["a"].steps
    assert s[0].action == [1, 0, 0, 0, 0, 0, 0] and s[1].action == [0] * 7 and s[0].reasoning.task == "t" and s[1].reasoning.task == ""
    assert len(s[0].language_embedding) == 512 and s[0].discount == 1.0 and s[0].ecot_features.gripper_position == []
    export.write_parquet(eps, str(tmp_path / "out"), ("matched", "reasoning_only"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.where("variant = 'matched'").count() == 2 and back.where("variant = 'reasoning_only'").count() == 1
    stats = export.export_stats(eps).first()
    assert (stats.total, stats.with_reasoning, stats.match_rate, stats.splits) == (2, 1, 0.5, ["train", "val"])
    export.write_jsonl(eps, str(tmp_path / "lines"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "lines")).collect()]
    assert len(lines) == 2 and lines[0]["steps"][0]["observation"]["image_0"] is None
    with pytest.raises(ValueError):
        export.exporter("csv")
    with pytest.raises(NotImplementedError):
        export.exporter("hdf5")
    with pytest.raises(ValueError):
        export.variant_rows(eps, ("none",))


def test_images_on_disk(spark, tmp_path):
    df = spark.createDataFrame([("/a/b", 3, bytes(12)), ("c", 0, None)], "episode_id string, step_index int, image_0 binary")
    got = export.write_images(df, str(tmp_path)).collect()
    assert len(got) == 1 and got[0].image_path.endswith("a_b/step_00003.png") and os.path.getsize(got[0].image_path) > 50


def test_limits_take_records_in_file_order(spark, tmp_path):
    tfrecord.register(spark)
    base = tmp_path / "1.0.0"
    base.mkdir()
    (base / "dataset_info.json").write_text("{}")
    text = lambda t: {"bytes": [t.encode()], "floats": None, "ints": None}
    for k, names in enumerate((["z", ""], ["a", "", "b"])):
        with open(base / f"d-train.tfrecord-0000{k}-of-00002", "wb") as f:
            for n in names:
                f.write(tfrecord.framed(tfrecord.encode_example({"episode_metadata/file_path": text(n), "steps/is_first": {"bytes": None, "floats": None, "ints": [1]}})))
    got = demonstrations.read_tfrecords(spark, str(tmp_path), max_episodes=4)
    assert [r.episode_id for r in got.episodes.orderBy("record_number").collect()] == ["z", "bridge_ep_000001", "a", "bridge_ep_000003"]
    assert got.steps.count() == 4 and demonstrations.splits_of(str(tmp_path)) == ["train"]
    assert tfrecord.count_records(str(base / "d-train.tfrecord-00001-of-00002")) == 3


def test_files_of_one_episode_each(spark):
    rows = spark.createDataFrame(
        [("/x/ep_1.h5", "go", [[1.0] * 7, [2.0] * 7], [[0.0] * 7], [b"a"], []), ("y.hdf5", "", [], [], [b"a", b"b"], [b"c"]), ("none.h5", "", [], [], [], [])],
        "path string, language_instruction string, actions array<array<float>>, state array<array<float>>, images0 array<binary>, images1 array<binary>",
    )
    reader = demonstrations.EpisodeReader(*demonstrations.of_files(rows), order=["source_file"])
    assert {r.episode_id: r.n_steps for r in reader.episodes.collect()} == {"ep_1": 2, "y": 2, "none": 0}
    steps = {(r.episode_id, r.step_index): r for r in reader.steps.collect()}
    assert len(steps) == 4 and steps["ep_1", 1].action == [2.0] * 7 and steps["ep_1", 1].state is None and steps["y", 0].action == [0.0] * 7 and bytes(steps["y", 1].image_0) == b"b" and steps["y", 1].is_last


def test_all_failures_are_written(spark, tmp_path):
    checked = spark.range(25).selectExpr("id as key", "id % 5 = 0 as passed", "array('x') as errors")
    totals = checked.selectExpr("count(*) as total", "count_if(not passed) as failed")
    assert export.write_validation(checked, totals.groupBy().agg(F.sum("total").alias("total"), F.sum("failed").alias("failed")), str(tmp_path / "r.json")) == 20
    with open(tmp_path / "r.json") as f:
        report = json.load(f)
    assert report["failed"] == 20 and len(report["failures"]) == 20


def test_fences_within_values_stay(spark):
    from stepweave.functions import reply, text

    said = '```json\n[{"task_reasoning": "say ``` twice ``` so"}]\n```'
    assert reply.lenient_json(said) == [{"task_reasoning": "say ``` twice ``` so"}]
    assert spark.createDataFrame([(said,)], "t string").select(text.strip_fences(F.col("t"))).first()[0] == '[{"task_reasoning": "say ``` twice ``` so"}]'


def test_annotation_files_are_split_in_one_pass(spark, tmp_path, monkeypatch):
    doc = {'a/ou"t.npy': {"42": {"x": [1, {"y": '}{"['}]}, "43": 5, "44": {}, "\u00e9\n": {"m": {"n": {"o": "q\\"}}}}, "b": None, "c": [{"d": 1}], "d": {"1": [{"z": 1}], "2": {"k": "v"}}, "e": "str{"}
    want = [(p, i, e) for p, m in doc.items() if isinstance(m, dict) for i, e in m.items() if isinstance(e, dict)]
    for text in (json.dumps(doc), json.dumps(doc, indent=2, ensure_ascii=False)):
        for size in (1, 2, 3, 5, 7, 16, 1000):
            pieces = (text[k : k + size] for k in range(0, len(text), size))
            assert [(p, i, json.loads(e)) for p, i, e in annotations.split_entries(pieces)] == want
    assert list(annotations.split_entries([json.dumps(doc)[:60]])) == [('a/ou"t.npy', "42", '{"x": [1, {"y": "}{\\"["}]}')] and list(annotations.split_entries([])) == []
    path = tmp_path / "notes.json"
    path.write_text(json.dumps(TEXT))
    whole = annotations.read_annotations(spark, str(path))
    monkeypatch.setattr(annotations, "SPLIT_BYTES", 10)
    parts = annotations.read_annotations(spark, str(path))
    assert [sorted(map(str, t.collect())) for t in whole] == [sorted(map(str, t.collect())) for t in parts]
    assert annotations.split_file(str(path), str(tmp_path / "parts"), lines_per_part=2) == 3 and len(list((tmp_path / "parts").iterdir())) == 2


def test_datasets_of_one_row_an_episode(spark, tmp_path):
    rows = [json.dumps({"metadata": {"n_steps": 2}, "reasoning": {"0": {"task": f"t{i}"}}}) for i in range(20)]
    (tmp_path / "rows.jsonl").write_text("\n".join(rows))
    lines = annotations.entries_of_rows(spark, str(tmp_path / "rows.jsonl"))
    spark.read.json(str(tmp_path / "rows.jsonl")).coalesce(1).write.parquet(str(tmp_path / "rows"))
    for entries in (lines, annotations.entries_of_rows(spark, str(tmp_path / "rows"))):
        episodes = annotations.flat_episodes(entries)
        assert {r.episode_id for r in episodes.collect()} == {f"{i}_{i}" for i in range(20)}
        steps = {(r.episode_id, r.step_index): r.reasoning for r in annotations.flat_steps(episodes).collect()}
        assert len(steps) == 40 and steps["7_7", 0].task_reasoning == "t7" and steps["7_7", 1] is None
    spread = annotations.row_numbers(spark.range(100, numPartitions=7), "n")
    assert all(r.id == r.n for r in spread.collect())


def test_objects_as_lines_and_back(spark):
    from stepweave.sources import lines

    trace = "named_struct('task_reasoning', 't', 'plan', null, 'raw_response', 'r', 'extra', map('k', 'v'))"
    step = f"named_struct('step_index', 1, 'action', array(1f, 2f), 'reasoning', {trace}, 'is_first', true, 'is_last', false, 'image_path', null, 'state_3d', array(1f))"
    df = spark.sql(f"select 'e' as episode_id, 'go' as language_instruction, map('a', 'b') as metadata, array({step}) as steps, 5 as other")
    text = lines.object_lines(df, "annotation_episode")
    value = json.loads(text.first().value)
    assert set(value) == {"episode_id", "language_instruction", "source_dataset", "metadata", "steps"} and value["source_dataset"] is None
    assert set(value["steps"][0]) == {"step_index", "action", "reasoning", "is_first", "is_last", "image_path"} and "raw_response" not in value["steps"][0]["reasoning"]
    back = lines.objects_of(text, "annotation_episode").first()
    assert back.steps[0].reasoning.task_reasoning == "t" and back.steps[0].reasoning.extra == {"k": "v"} and back.steps[0].action == [1.0, 2.0]
    for kind in lines.SHAPES:
        assert lines.objects_of(lines.object_lines(df, kind), kind).count() == 1
    told = spark.createDataFrame([('{"task_reasoning": "x", "raw_response": "all of it"}',), ("",)], "value string")
    assert [(r.task_reasoning, r.raw_response, r.plan) for r in lines.objects_of(told, "trace").collect()] == [("x", "all of it", None)]


def test_images_by_path_and_as_text(spark, tmp_path):
    import base64

    from stepweave.functions import images

    (tmp_path / "a.png").write_bytes(b"\x89PNG\r\n\x1a\nxyz")
    df = spark.createDataFrame([(None, str(tmp_path / "a.png")), (b"own", "x"), (None, str(tmp_path / "none.png")), (None, None)], "image binary, path string")
    got = [None if r[0] is None else bytes(r[0]) for r in df.select(images.loaded(F.col("image"), F.col("path"))).collect()]
    assert got == [b"\x89PNG\r\n\x1a\nxyz", b"own", None, None]
    text = [r[0] for r in spark.createDataFrame([(bytes(12),), (None,)], "image binary").select(images.base64_text(F.col("image"))).collect()]
    assert base64.b64decode(text[0])[:4] == b"\x89PNG" and text[1] is None


def test_curate_several_splits(spark, tmp_path):
    import yaml

    from stepweave import cli

    rows = [(f"e{k}", f"p{k}", k, "go", s) for k, s in enumerate(["train", "train", "val", "test"])]
    spark.createDataFrame(rows, "episode_id string, source_file string, episode_num int, language_instruction string, split string").write.parquet(str(tmp_path / "demos/episodes"))
    steps = [(f"e{k}", i, [0.1] * 7, i == 0, i == 2, bytes([k] * 12)) for k in range(4) for i in range(3)]
    spark.createDataFrame(steps, "episode_id string, step_index int, action array<float>, is_first boolean, is_last boolean, image_0 binary").write.parquet(str(tmp_path / "demos/steps"))
    notes = {f"p{k}": {str(k): {"metadata": {"n_steps": 3}, "reasoning": {"0": {"task": f"t{k}"}}}} for k in range(4)}
    (tmp_path / "notes.json").write_text(json.dumps(notes))
    settings = {
        "annotations": {"local_path": str(tmp_path / "notes.json")}, "output_dir": str(tmp_path / "out"), "save_images": True, "image_output_dir": str(tmp_path / "images"),
        "demonstrations": {"local_path": str(tmp_path / "demos"), "split": "train+val", "image_size": [1, 1], "cache_dir": str(tmp_path / "cache"), "shuffle": True},
    }
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(settings))
    assert cli.main(["curate", "--config", str(tmp_path / "c.yaml")]) == 0
    out = spark.read.parquet(str(tmp_path / "out")).where("variant = 'matched'").collect()
    assert sorted((r.episode_id, r.split) for r in out) == [("e0", "train"), ("e1", "train"), ("e2", "val")]
    one = next(r for r in out if r.episode_id == "e1")
    assert one.alignment_metadata.strategy == "nearest" and one.provenance.demonstration_source == "bridge_v2" and bytes(one.steps[0].observation.image_0) == b"\1\1\1" and one.steps[2].reasoning.task == "t1"
    assert len(list((tmp_path / "images").iterdir())) == 3 and (tmp_path / "cache/bridge_v2/val/steps").is_dir()
    for fmt in ("jsonl", "tfrecord"):
        (tmp_path / "c.yaml").write_text(yaml.safe_dump(settings | {"export_format": fmt, "output_dir": str(tmp_path / fmt), "save_images": False}))
        assert cli.main(["curate", "--config", str(tmp_path / "c.yaml")]) == 0
    assert {json.loads(r.value)["episode_id"] for r in spark.read.text(str(tmp_path / "jsonl")).collect()} == {"e0", "e1", "e2"}
    assert spark.read.format("tfrecord").load(str(tmp_path / "tfrecord")).count() == 3
