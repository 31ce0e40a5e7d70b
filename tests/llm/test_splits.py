import random

import pytest
from pyspark.sql import functions as F

from stepweave.llm import splits

TARGETS = [("train", 0.8), ("val", 0.1), ("test", 0.1)]


def targets(spark):
    return spark.createDataFrame(TARGETS, "split string, target_share double")


def union_find(rows):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, *links in rows:
        if i is None:
            continue
        find(("r", i))
        for k, v in enumerate(links):
            if v is not None:
                parent[find(("r", i))] = find((k, v))
    groups = {}
    for i, *_ in rows:
        if i is not None:
            groups.setdefault(find(("r", i)), set()).add(i)
    return {i: min(g) for g in groups.values() for i in g}


def heads(table, cast=int):
    """Smallest id of each record's component."""
    rows = table.members().collect()
    least = {}
    for r in rows:
        least[r.component] = min(least.get(r.component, cast(r.id)), cast(r.id))
    assert len({r.id for r in rows}) == len(rows)
    return {cast(r.id): least[r.component] for r in rows}


def table_of(spark, tmp_path, df, id_col, links, batches=1):
    table = splits.SplitTable(spark, f"file://{tmp_path}/table", buckets=4)
    for k in range(batches):
        table.add(df.where(F.col(id_col).isNull() | (F.pmod(F.xxhash64(id_col), F.lit(batches)) == k)), id_col, links, targets(spark))
    return table


@pytest.mark.parametrize("batches", [1, 3])
def test_groups_against_union_find(spark, tmp_path, batches):
    rng = random.Random(3)
    rows = [(i, f"s{rng.randrange(150)}" if rng.random() < 0.9 else None, rng.randrange(250) if rng.random() < 0.8 else None) for i in range(300)]
    rows += rows[:30] + [(None, "s1", 2)]
    df = spark.createDataFrame(rows, "k long, b string, node int").withColumn("id", F.lit(1)).withColumn("n", F.lit(2)).withColumn("split", F.lit("x"))
    assert heads(table_of(spark, tmp_path, df, "k", ["b", "node"], batches)) == union_find(rows)


def test_long_chain(spark, tmp_path):
    rows = [(i, f"a{i // 2}", f"b{(i + 1) // 2}") for i in range(300)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "id long, a string, b string")
    assert set(heads(table_of(spark, tmp_path, df, "id", ["a", "b"])).values()) == {0}


def test_one_hot_value(spark, tmp_path, monkeypatch):
    from stepweave.operators import skew

    monkeypatch.setattr(skew, "small_side", lambda df, max_rows=0: df)  # as if nothing were small enough
    df = spark.range(1500).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("v"))
    got = heads(table_of(spark, tmp_path, df, "id", ["v"]))
    assert all(h == (0 if i % 3 == 0 else i) for i, h in got.items())


def test_shares_and_togetherness(spark, tmp_path):
    df = spark.range(5000).select("id", (F.col("id") % 1700).alias("g"))
    given = splits.SplitTable(spark, f"{tmp_path}/a").add(df, "id", ["g"], targets(spark))
    rows = given.join(df, "id").collect()
    assert len(rows) == 5000
    per = {}
    for r in rows:
        per.setdefault(r.g, set()).add(r.split)
    assert all(len(v) == 1 for v in per.values())
    counts = {k: sum(r.split == k for r in rows) / 5000 for k, _ in TARGETS}
    assert all(abs(counts[k] - s) < 0.01 for k, s in TARGETS)
    again = splits.SplitTable(spark, f"{tmp_path}/b").add(df, "id", ["g"], targets(spark))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, given.collect()))


def test_next_batches_keep_splits_and_quarantine_conflicts(spark, tmp_path):
    table = splits.SplitTable(spark, str(tmp_path / "t"), buckets=4)
    first = spark.createDataFrame([(i, f"g{i}") for i in range(40)], "id long, g string")
    old = {r.id: r.split for r in table.add(first, "id", ["g"], targets(spark)).collect()}
    train = next(i for i, s in sorted(old.items()) if s == "train")
    other = next(i for i, s in sorted(old.items()) if s != "train")
    batch = [(100, f"g{train}", None), (101, f"g{train}", "bridge"), (102, f"g{other}", "bridge"), (103, "new", None), (104, "new", None), (train, f"g{train}", None)]
    new = {r.id: r.split for r in table.add(spark.createDataFrame(batch, "id long, g string, h string"), "id", ["g", "h"], targets(spark)).collect()}
    assert new[103] == new[104] != splits.QUARANTINE and {new[100], new[101], new[102]} == {splits.QUARANTINE} and new[train] == "train"
    # What meets a quarantined component later is quarantined too; what meets another takes its split.
    calm = next(i for i, s in sorted(old.items()) if i not in (train, other))
    third = spark.createDataFrame([(200, f"g{calm}", None), (201, None, "bridge"), (202, f"g{train}", None)], "id long, g string, h string")
    got = {r.id: r.split for r in table.add(third, "id", ["g", "h"], targets(spark)).collect()}
    assert got == {200: old[calm], 201: splits.QUARANTINE, 202: splits.QUARANTINE}
    members = {int(r.id): r for r in table.members().collect()}
    assert len(members) == 48 and all(members[i].split == s for i, s in old.items()) and members[train].component == members[other].component
    assert table.batches() == 3


def test_work_follows_the_batch(spark, tmp_path, monkeypatch):
    """The edges solved for a small batch are its own, however many nodes are known; a batch that broke off is done again."""
    table = splits.SplitTable(spark, str(tmp_path / "t"), buckets=4)
    table.add(spark.range(5000).selectExpr("id", "concat('g', id % 50) as g"), "id", ["g"], targets(spark))
    seen, solve = [], splits.pointer_components
    monkeypatch.setattr(splits, "pointer_components", lambda edges: seen.append(edges.count()) or solve(edges))
    batch = spark.createDataFrame([(7000, "g1"), (7001, "g2"), (7002, "g2")], "id long, g string")
    given = table.add(batch, "id", ["g"], targets(spark))
    assert seen == [3] and given.count() == 3
    import shutil

    shutil.rmtree(tmp_path / "t" / "commits")
    spark.range(1).selectExpr("0 as batch").write.parquet(str(tmp_path / "t" / "commits"))
    assert sorted(map(tuple, table.add(batch, "id", ["g"], targets(spark)).collect())) == sorted(map(tuple, given.collect()))


def test_sessions(spark):
    paths = ["/nfs/x/lab1/task_a/s0000049/train/out.npy", "D:\\x\\lab1\\task_a\\s0000049\\val\\out.npy", "lab1//task_a/s0000049/train/out.npy \n", "./LAB1/TASK_A/S0000049/out.npy", None, ""]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(splits.session_of(F.col("p"))).collect()] == ["lab1/task_a/s0000049"] * 4 + [None, None]


def test_empty(spark, tmp_path):
    none = spark.createDataFrame([], "id long, g string")
    table = splits.SplitTable(spark, str(tmp_path / "t"))
    assert table.add(none, "id", ["g"], targets(spark)).count() == 0 and table.members().count() == 0
    some = spark.createDataFrame([(1, None)], "id long, g string")
    assert table.add(some, "id", ["g"], targets(spark).limit(0)).first().split is None
