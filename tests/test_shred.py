import json

import pytest

from stepweave.operators import shred
from stepweave.plans import curation_queries as cq
from tests.conftest import compare


def _df(spark, *bodies):
    return spark.createDataFrame([(i, b if b is None or isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)], "rid long, body string")


def test_tables_keep_links(spark):
    doc = {"name": "x", "meta": {"a": 1, "deep": {"b": True}}, "items": [{"k": "p", "tags": ["t", None]}, {"k": "q", "box": [1, 2.5]}], "steps": {"3": {"go": "l"}, "11": {}}}
    t = shred.tables(_df(spark, doc, {"name": None, "items": '[{"k": "text"}]'}), "rid", "body")
    root = {r.rid: r for r in t["$"].collect()}
    assert root[0].name == "x" and root[0]["meta.a"] == 1.0 and root[0]["meta.deep.b"] is True and root[1].name is None
    items = sorted((r.rid, r.key, r.k, r.box, r.row_id, r.parent_id) for r in t["$.items.[]"].collect())
    assert items == [(0, "0", "p", None, "/items[0]", ""), (0, "1", "q", "[1, 2.5]", "/items[1]", ""), (1, "0", "text", None, "/items[0]", "")]
    assert [(r.parent_id, r.key, r.value) for r in t["$.items.[].tags.[]"].collect()] == [("/items[0]", "0", "t")]
    assert sorted((r.key, r.go) for r in t["$.steps.{}"].collect()) == [("11", None), ("3", "l")]


def test_recursive_and_shared(spark):
    tree = {"node": {"v": 1, "node": {"v": 2, "node": {"v": 3}}}, "left": {"size": {"w": 1}}, "right": {"size": {"w": 2}}}
    graph = shred.analyse(_df(spark, tree), "body")
    assert graph.recursive == {"node"} and graph.shared == {"size"}
    t = shred.tables(_df(spark, tree), "rid", "body")
    nodes = sorted((r.row_id, r.parent_id, r.v) for r in t["#node"].collect())
    assert [n[2] for n in nodes] == [1.0, 2.0, 3.0] and nodes[1][1] == nodes[0][0] and nodes[2][1] == nodes[1][0]
    assert sorted(r.w for r in t["#size"].collect()) == [1.0, 2.0]


def test_broken_and_odd_bodies(spark):
    df = _df(spark, None, "", "{", '{"a": NaN}', "[1, 2]", "3", '"x"', {"a": []}, '{"a": 1} tail').selectExpr("*", "1 as id", "2 as `table`", "3 as key")
    graph = shred.analyse(df, "body")
    rows = shred.shredded(df, "rid", "body", graph).collect()
    assert {r.rid for r in rows} == {4, 5, 6, 7}
    assert shred.shredded(_df(spark), "rid", "body", graph).count() == 0
    assert shred.tables(_df(spark), "rid", "body")["$"].count() == 0


def test_many_different_keys_become_a_map(spark):
    wide = {f"k{i}": {"v": i} for i in range(shred.MAX_FIELDS + 50)}
    graph = shred.analyse(_df(spark, wide), "body")
    assert "$" in graph.maps
    rows = shred.shredded(_df(spark, wide), "rid", "body", graph).where("table = '$.{}'").count()
    assert rows == len(wide)


def test_every_value_survives(spark):
    doc = {"a": {"b": [1, "x", None, {"c": [[1, 2], [3]]}], "d": "t"}, "7": {"e": False}}
    graph = shred.analyse(_df(spark, doc), "body")
    values = sorted(v for r in shred.shredded(_df(spark, doc), "rid", "body", graph).collect() for v in r["columns"].values() if v is not None)
    assert values == sorted(["1", "x", "[1, 2]", "[3]", "t", "false"])


def test_long_text(spark):
    big = {"1": {"metadata": {"caption": "x" * 300_000}, "reasoning": {str(i): {"task": "t"} for i in range(3000)}}}
    graph = shred.analyse(_df(spark, big), "body", {"$"})
    rows = shred.shredded(_df(spark, big), "rid", "body", graph)
    assert rows.where("table = '$.{}.reasoning.{}'").count() == 3000


@pytest.mark.parametrize("text, want", [('{"a": 1}', {"a": 1}), ('"{\\"a\\": 1}"', {"a": 1}), ("{broken", "{broken"), ("plain", "plain")])
def test_opened(text, want):
    value = shred.parse(text) if text[0] in '"{' and text != "{broken" else text
    assert shred.opened(value) == want


def _p5_like_sql(spark, tmp_path, *bodies):
    """The three queries give the rows of their SQL over these bodies."""
    df = spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(bodies)], "raw_id long, body string")
    df.toPandas().to_parquet(tmp_path / "embodied_features_bridge.parquet")
    for name in ("p5_found", "p5_reasoning", "p5_episodes"):
        compare(spark, str(tmp_path), cq.queries()[name], cq.oracle_sql()[name])
    return cq.p5_found(spark, str(tmp_path)).count()


def _episode(**more):
    features = {"state_3d": [[0.1, 0.2, 0.3], None, [1, 2, 3]], "move_primitive": ["up"], "bboxes": [[]]}
    return {"metadata": {"episode_id": "7", "caption": "c"}, "features": features, "reasoning": {"0": {"task": "t", "plan": "p"}, "2": {"move": "m"}}} | more


def test_names_met_elsewhere_move_no_child(spark, tmp_path):
    e = _episode()
    odd = _episode(metadata={"episode_id": "8", "features": {"a": 1}, "reasoning": {"task": {"x": 1}}, "metadata": {"caption": "inner"}})
    odd["features"] = odd["features"] | {"features": {"state_3d": [[9]], "metadata": {"z": 1}}, "reasoning": {"1": {"task": "no"}}}
    odd["reasoning"]["0"]["reasoning"] = {"features": {"v": 2}}
    assert _p5_like_sql(spark, tmp_path, {"a": e}, {"b": odd}, {"c}/features": e, "d": json.loads(json.dumps(e))}) == 4 * 6
    df = _df(spark, {"b": odd})
    t = shred.tables(df, "rid", "body", cq.BODY_MAPS, cq.BODY_KNOWN)
    assert [r.v for r in t["#features"].collect() if "v" in t["#features"].columns and r.v] == [2.0]
    assert t["#features.state_3d.[]"].count() == 1 and t["$.{}.features.state_3d.[]"].count() == 2


def test_lists_of_numbers_have_child_rows(spark, tmp_path):
    e = _episode()
    e["features"] |= {"gripper_position": [12, 165], "gripper_positions": [None, 1], "move_primitive": [1, 2.5], "state_3d": [1, 2, 3], "bboxes": [[1, 2], 3]}
    assert _p5_like_sql(spark, tmp_path, {"a": e}, {"b": _episode()}) == 3 + 2 + 2 + 2 + 2 + 6


def test_many_names_move_no_child(spark, tmp_path):
    many = lambda v: {f"n{i}": v for i in range(shred.MAX_FIELDS + 200)}
    e = _episode()
    wide = _episode(**many(1))
    wide["features"] = many({"x": 1}) | wide["features"]
    wide["metadata"] = many("m") | wide["metadata"]
    wide["reasoning"] = {"0": many("r") | {"task": "t"}}
    assert _p5_like_sql(spark, tmp_path, {"a": e}, {"b": wide, "{}": e}) == 3 * 6 - 1


def test_names_are_counted_over_all_rows(spark):
    docs = [{"a": {f"k{i}": {f"x{i}": 1, f"y{i}": [2]}}, "b": {"s": {"t": i}}} for i in range(shred.MAX_FIELDS + 100)]
    df = _df(spark, *docs)
    graphs = [shred.analyse(df.repartition(n), "body") for n in (1, 16)]
    assert graphs[0] == graphs[1] and graphs[0].maps == {"$.a", "$.a.{}"}
    assert shred.shredded(df, "rid", "body", graphs[0]).where("table = '$.a.{}.{}'").count() == 2 * len(docs)


def test_too_large_a_graph_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(shred, "MAX_GRAPH", 10)
    with pytest.raises(ValueError, match="more than 10 paths"):
        shred.analyse(_df(spark, {f"k{i}": i for i in range(20)}), "body")
    # Entries of an object with very many names count once.
    monkeypatch.setattr(shred, "MAX_FIELDS", 15)
    assert shred.analyse(_df(spark, {f"k{i}": i for i in range(20)}), "body").maps == {"$"}


def test_rows_carry_the_keys_that_lead_to_them(spark):
    docs = [{"7": {"reasoning": {"2": {"task": "t"}}, "features": {"state_3d": [[1, 2, 3], None]}}}, {"a/b": {"reasoning": {"0": {"plan": "p"}}}}]
    rows = shred.written(_df(spark, *docs), "rid", "body", cq.BODY_MAPS, cq.BODY_KNOWN)[0].where("table <> '~schema' and kind <> 'null'").collect()
    keys = {(r.rid, r["table"], tuple(r["keys"])) for r in rows}
    assert {(0, "$.{}.reasoning.{}", ("7", "2")), (0, "$.{}.features.state_3d.[]", ("7", "0")), (1, "$.{}.reasoning.{}", ("a/b", "0")), (0, "$", ())} <= keys
    own = {(r.rid, r.row_id): r for r in rows}
    for r in rows:
        if r.parent_id is not None:
            assert r["keys"][: len(own[r.rid, r.parent_id]["keys"])] == own[r.rid, r.parent_id]["keys"]


def test_one_pass_unless_an_element_moves(spark, monkeypatch):
    passes, walked = [], shred._walked
    monkeypatch.setattr(shred, "_walked", lambda *a, **k: passes.append(1) or walked(*a, **k))
    shred.written(_df(spark, {"1": {"metadata": {"a": 1}}}), "rid", "body", {"$"})
    assert len(passes) == 1
    every, graph = shred.written(_df(spark, {"x": {"size": {"w": 1}}, "y": {"size": {"w": 2}}}), "rid", "body")
    assert graph.shared == {"size"} and every.where("table = '#size'").count() == 2 and len(passes) == 4


def test_many_places_are_passed_on(spark, monkeypatch):
    """A task that forgets its places before it ends loses none."""
    monkeypatch.setattr(shred, "MAX_PLACES", 3)
    docs = [{f"n{i}": {"v": i}} for i in range(40)]
    names = {p for p in shred.analyse(_df(spark, *docs), "body").kinds}
    assert {f"$.n{i}.v" for i in range(40)} <= names
