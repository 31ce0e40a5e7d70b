"""Splits that keep related records together.

Records and what they share form a bipartite graph. A component table that is
kept at a path of the caller's (node, component, split) is extended batch by
batch: only nodes that a batch touches are looked up, the batch's edges are
contracted to the components they belong to, pointer jumping merges those, and
what changed is appended. Known components keep their split, new ones fill the
splits' deficits, and what would tie components of different splits together
is quarantined.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from stepweave.operators.skew import lookup, small_side
from stepweave.session import stored

QUARANTINE = "quarantine"
MAX_ROUNDS = 60


def session_of(path: Column) -> Column:
    """lab/task/session of an episode's path, however it is written; NULL if there is none.

    The session is the deepest folder of the form s<digits> that two folders
    precede; without one, the path without its last two parts counts.
    """
    clean = F.lower(F.regexp_replace(F.regexp_replace(path, r"\\", "/"), r"[\s\x{200b}\x{feff}]+", ""))
    clean = F.regexp_replace(F.regexp_replace(clean, r"/(\./)+", "/"), "/+", "/")
    found = F.regexp_extract(clean, r"(?:^|/)([^/]+/[^/]+/s[0-9]+)(?:/|$)", 1)
    whole = F.regexp_replace(clean, r"^(?:[a-z]:)?[./]*|/[^/]+/[^/]+$", "")
    return F.coalesce(F.nullif(found, F.lit("")), F.nullif(whole, F.lit("")))


def _sized(table: DataFrame) -> tuple[DataFrame, bool]:
    """A table that is looked up more than once, and whether it may be broadcast."""
    small = small_side(table)
    return small, small is not table


def _found(rows: DataFrame, sized: tuple[DataFrame, bool], names: dict[str, str], key: str, spread_by: str) -> DataFrame:
    """Left join of ``rows`` with a table that was sized before, under new names; hot keys are spread."""
    table, small = sized
    renamed = table.withColumnsRenamed(names)
    return rows.join(F.broadcast(renamed), key, "left") if small else lookup(rows, renamed, [key], spread_by, may_broadcast=False)


def _stored_counting(df: DataFrame, name: str, what: Column) -> tuple[DataFrame, int]:
    """A written table, and in how many of its rows ``what`` holds, counted while it is written."""
    seen = Observation()
    table = stored(df.observe(seen, F.count_if(what).alias("n")), name)
    return table, seen.get["n"]


def _jumped(hooks: DataFrame) -> DataFrame:
    """Every pointer moved on to where its target points."""
    up = hooks.select(F.col("root").alias("next"), F.col("next").alias("next2"))
    return hooks.join(up, "next", "left").select("root", F.coalesce("next2", "next").alias("next"), F.col("next2").isNotNull().alias("moved"))


def pointer_components(edges: DataFrame) -> DataFrame:
    """(node, root) of an undirected edge table a, b; root is the smallest node reached.

    Each round hooks every root to the smallest root seen over an edge, then
    jumps pointers; edges shrink to those that still join different roots. All
    groups are reduced before they are shuffled, and no group is gathered.
    Every round's edges and roots are written to the shared folder, so that a
    lost executor costs one round at most; labels are the nodes joined with the
    roots of the few rounds. Rounds grow with the logarithm of the longest chain.
    """
    pairs = edges.where("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    live, left = _stored_counting(pairs.distinct(), "edges", F.lit(True))
    labels = live.select(F.col("lo").alias("node")).union(live.select("hi")).distinct().withColumn("root", F.col("node"))
    for _ in range(MAX_ROUNDS):
        if not left:
            return labels
        # Every root hooks onto the smallest root it meets; the hooks are a forest.
        hooks = stored(live.groupBy(F.col("hi").alias("root")).agg(F.min("lo").alias("next")), "hooks")
        moved = 1
        while moved:  # two jumps a round
            hooks, moved = _stored_counting(_jumped(_jumped(hooks).select("root", "next")), "jumped", F.col("moved"))
            hooks = hooks.select("root", "next")
        # A root may stand on very many edges and labels: it is looked up with its hot keys spread.
        to = _sized(hooks.select("root", "next"))
        labels = _found(labels, to, {}, "root", "node").select("node", F.coalesce("next", "root").alias("root"))
        both = _found(_found(live, to, {"root": "lo", "next": "lo2"}, "lo", "hi"), to, {"root": "hi", "next": "hi2"}, "hi", "lo")
        live = (
            both.select(F.coalesce("lo2", "lo").alias("x"), F.coalesce("hi2", "hi").alias("y"))
            .where("x <> y")
            .select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi"))
            .distinct()
        )
        live, left = _stored_counting(live, "live", F.lit(True))
    raise RuntimeError("components did not settle")


def fill_deficits(sizes: DataFrame, targets: DataFrame, taken: DataFrame) -> DataFrame:
    """(comp, split) for new components so that the splits come near their shares.

    ``sizes`` is comp, n; ``targets`` split, target_share; ``taken`` split, n of
    what is assigned already. Components of over a thousandth of all records
    (at most a thousand exist) are placed one by one, largest first, into the
    split that lacks most; the rest, in hash order, is cut by prefix sums.
    """
    spark = sizes.sparkSession
    sizes = stored(sizes, "sizes")
    have = {r["split"]: r["n"] for r in taken.collect()}
    want = [(r["split"], float(r["target_share"] or 0)) for r in targets.where("split is not null").orderBy("split").collect()]
    if not want:
        return sizes.select("comp", F.lit(None).cast("string").alias("split"))
    new = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    total, shares = new + sum(have.values()), sum(s for _, s in want) or 1.0
    lack = {k: total * s / shares - have.get(k, 0) for k, s in want}
    limit = max(1, total // 1000)
    placed = []
    for r in sizes.where(F.col("n") > limit).orderBy(F.desc("n"), "comp").collect():
        best = max(lack, key=lambda k: (lack[k], k))
        lack[best] -= r["n"]
        placed.append((r["comp"], best))
    big = spark.createDataFrame(placed, f"comp {sizes.schema['comp'].dataType.simpleString()}, split string")
    small = sizes.where(F.col("n") <= limit).withColumn("key", F.xxhash64("comp"))
    # Prefix sums over hash order: totals of 4096 ranges first, then within each range.
    small = small.withColumn("range", F.shiftrightunsigned("key", 52))
    ranges = small.groupBy("range").agg(F.sum("n").alias("w"))
    before = ranges.select("range", (F.sum("w").over(Window.orderBy("range")) - F.col("w")).alias("before"))
    inside = Window.partitionBy("range").orderBy("key", "comp").rowsBetween(Window.unboundedPreceding, -1)
    small = small.join(F.broadcast(before), "range").withColumn("at", F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    rest = {k: max(0.0, v) for k, v in lack.items()}
    left = sizes.where(F.col("n") <= limit).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    scale = left / (sum(rest.values()) or 1.0)
    split, start = F.lit(max(rest, key=lambda k: (rest[k], k))), 0.0
    for k in sorted(rest):
        split = F.when((F.col("at") >= start) & (F.col("at") < start + rest[k] * scale), F.lit(k)).otherwise(split)
        start += rest[k] * scale
    return big.unionByName(small.select("comp", split.alias("split")))


class SplitTable:
    """Components and splits of all records so far, kept as Parquet below ``path`` in a shared file system.

    ``nodes`` holds each record and shared value once: node, component, split,
    and for records their id. ``components`` holds component, root, split, one
    row for each time it changed; the row of the latest batch counts. ``totals``
    counts the records a batch gave to each split. Nodes and components lie in
    folders by batch and by one of ``buckets`` ranges of their hash, so that a
    batch reads only the buckets it touches and only appends. A batch counts
    once its row in ``commits`` is written; one that broke off is written over.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64) -> None:
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _bucket(self, node: Column) -> Column:
        return F.pmod(F.xxhash64(node), F.lit(self.buckets)).cast("int")

    def batches(self) -> int:
        """How many batches have been added."""
        try:
            return self.spark.read.schema("batch int").parquet(f"{self.path}/commits").select(F.coalesce(F.max("batch") + 1, F.lit(0))).first()[0]
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0

    def _read(self, name: str, ddl: str, buckets: list[int] | None = None, done: int | None = None) -> DataFrame:
        done = self.batches() if done is None else done
        full = f"{ddl}, batch int" if name == "totals" else f"{ddl}, batch int, bucket int"
        if not done:
            return self.spark.createDataFrame([], full)
        rows = self.spark.read.schema(full).option("basePath", f"{self.path}/{name}").parquet(*[f"{self.path}/{name}/batch={k}" for k in range(done)])
        return rows if buckets is None else rows.where(F.col("bucket").isin(buckets))

    def _write(self, df: DataFrame, name: str, batch: int, node: str | None) -> None:
        out = df if node is None else df.withColumn("bucket", self._bucket(F.col(node))).repartition("bucket")
        writer = out.write.mode("overwrite").option("compression", "zstd")
        # The folder of a batch is there even if nothing falls into it.
        (writer if node is None else writer.partitionBy("bucket")).parquet(f"{self.path}/{name}/batch={batch}")

    def _nodes(self, buckets: list[int] | None = None, done: int | None = None) -> DataFrame:
        return self._read("nodes", "node string, record string, component string, split string", buckets, done)

    def _components(self, buckets: list[int] | None = None, done: int | None = None) -> DataFrame:
        """component, root, split as of the latest batch."""
        rows = self._read("components", "component string, root string, split string", buckets, done)
        return rows.groupBy("component").agg(F.max_by(F.struct("root", "split"), "batch").alias("c")).select("component", "c.*")

    def _roots(self, wanted: DataFrame, done: int) -> DataFrame:
        """component, root, split for the components ``wanted``, following merges to the end."""
        todo = stored(wanted.select(F.col("component"), F.col("component").alias("at")), "wanted")
        while True:
            near = [r[0] for r in todo.select(self._bucket(F.col("at"))).distinct().collect()]
            if not near:
                return todo.select("component", F.col("at").alias("root"), F.lit(None).cast("string").alias("split"))
            rows = self._components(near, done).select(F.col("component").alias("at"), "root", "split")
            todo, moved = _stored_counting(todo.select("component", "at").join(rows, "at"), "followed", F.col("root") != F.col("at"))
            if not moved:
                return todo.select("component", "root", "split")
            todo = todo.select("component", F.col("root").alias("at"))

    def members(self) -> DataFrame:
        """id (as text), component, split of every record so far; components that were merged have one name."""
        comps = self._components()
        merged = comps.where("root <> component").select("component")
        final = comps.select("component", "root")
        # Chains of merges are as long as the batches that made them.
        while True:
            up = final.select(F.col("component").alias("root"), F.col("root").alias("root2"))
            final = stored(lookup(final, up, ["root"], "component").select("component", F.coalesce("root2", "root").alias("root"), (F.col("root2") != F.col("root")).alias("moved")), "final")
            if final.where("moved").isEmpty():
                break
            final = final.select("component", "root")
        records = self._nodes().where("record is not null").select("record", "component", "split")
        renamed = stored(final.join(merged, "component", "left_semi").select("component", "root"), "renamed")
        return lookup(records, renamed, ["component"], "record").select(F.col("record").alias("id"), F.coalesce("root", "component").alias("component"), "split")

    def add(self, records: DataFrame, id_col: str, link_cols: list[str], targets: DataFrame) -> DataFrame:
        """Add a batch; (id, component, split) of its records.

        Two records are tied if they have an equal value in the same of
        ``link_cols``, directly or by way of others, of this batch or earlier
        ones. A component that meets known ones of a single split takes it.
        Where known ones of different splits, or a quarantined one, meet, the
        known nodes keep their splits and everything new is quarantined.

        Nulls: records without id are skipped; NULL values tie nothing; without
        targets the split is NULL. Repeated rows count once; a record sent again
        keeps its split. Empty tables work; extra columns are ignored.
        """
        batch = self.batches()
        own = [f"_link{i}" for i in range(len(link_cols))]
        linked = records.select(F.col(id_col).alias("id"), *[F.col(c).cast("string").alias(a) for c, a in zip(link_cols, own)])
        base = stored(linked.where("id is not null").distinct().withColumn("node", F.concat(F.lit("r:"), F.col("id").cast("string"))), "records")
        ties = base.select("node", F.explode(F.array_compact(F.array(*[F.when(F.col(a).isNotNull(), F.concat(F.lit(f"{c}:"), F.col(a))) for a, c in zip(own, link_cols)]))).alias("value"))
        ties = stored(ties.distinct(), "ties")
        ids = base.groupBy("node").agg(F.min(F.col("id").cast("string")).alias("record"))
        nodes = stored(ids.unionByName(ties.select(F.col("value").alias("node"), F.lit(None).cast("string").alias("record")).distinct()), "nodes")

        # What the batch touches: its own nodes, in the buckets where they lie.
        if batch:
            near = [r[0] for r in nodes.select(self._bucket(F.col("node"))).distinct().collect()]
            touched = stored(self._nodes(near, batch).select("node", "component", "split").join(nodes.select("node"), "node", "left_semi"), "touched")
            roots = self._roots(touched.select("component").distinct(), batch)
            placed = stored(lookup(touched, roots.select("component", "root"), ["component"], "node").select("node", "split", F.concat(F.lit("c:"), "root").alias("at")), "placed")
        else:
            roots = self.spark.createDataFrame([], "component string, root string, split string")
            placed = self.spark.createDataFrame([], "node string, split string, at string")

        # Edges between components, where there are any, else between nodes.
        was = _sized(placed)
        at = (was[0].select("node", "at"), was[1])
        edges = _found(ties, at, {}, "node", "value").select(F.coalesce("at", "node").alias("a"), "value")
        edges = _found(edges, at, {"node": "value", "at": "at2"}, "value", "a").select("a", F.coalesce("at2", "value").alias("b")).distinct()
        groups = stored(pointer_components(edges), "groups")
        by_node = _sized(groups)
        ends = _found(nodes, at, {}, "node", "node").select("node", "record", F.col("at").isNull().alias("new"), F.coalesce("at", "node").alias("end"))
        found = stored(_found(ends, by_node, {"node": "end"}, "end", "node").select("node", "record", "new", F.coalesce("root", "end").alias("group")), "found")

        # What each group holds: known components and their splits, new records.
        known = roots.select(F.concat(F.lit("c:"), "root").alias("node"), F.col("root").alias("component"), "split").distinct()
        known = stored(_found(known, by_node, {}, "node", "component").select("component", "split", F.coalesce("root", "node").alias("group")), "known")
        held = known.groupBy("group").agg(
            F.min("split").alias("lo"), F.max("split").alias("hi"), F.max(F.col("split") == QUARANTINE).alias("barred"), F.min("component").alias("root"), F.count("*").alias("parts")
        )
        sizes = found.groupBy("group").agg(F.count_if(F.col("new") & F.col("record").isNotNull()).alias("n"))
        per = stored(sizes.join(held, "group", "left"), "per_group")
        adopted = F.when(F.col("barred") | (F.col("lo") != F.col("hi")), F.lit(QUARANTINE)).otherwise(F.col("lo"))
        taken = self._read("totals", "split string, n long", done=batch).select("split", "n").unionByName(per.where("parts is not null").select(adopted.alias("split"), "n"))
        taken = taken.where((F.col("split") != QUARANTINE)).groupBy("split").agg(F.sum("n").alias("n"))
        fresh = fill_deficits(per.where("parts is null").select(F.col("group").alias("comp"), "n"), targets, taken)
        decided = per.where("parts is null").join(fresh.withColumnRenamed("comp", "group"), "group", "left").select("group", F.col("group").alias("root"), "split", "n")
        decided = stored(decided.unionByName(per.where("parts is not null").select("group", "root", adopted.alias("split"), "n")), "decided")

        verdict = decided.select("group", F.col("root").alias("component"), "split")
        now = lookup(found, verdict, ["group"], "node").select("node", "record", "new", "component", "split")
        self._write(now.where("new").select("node", "record", "component", "split"), "nodes", batch, "node")
        # Components that are new, take another's name, or are barred from now on.
        changed = decided.join(known.select("group").distinct(), "group", "left_anti").select(F.col("root").alias("component"), "root", "split")
        merged = known.withColumnRenamed("split", "before").join(decided.select("group", "root", "split"), "group")
        merged = merged.where("component <> root or before <> split").select("component", "root", "split")
        self._write(changed.unionByName(merged), "components", batch, "component")
        self._write(decided.groupBy("split").agg(F.sum("n").alias("n")), "totals", batch, None)
        self.spark.range(1).select(F.lit(batch).alias("batch")).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        kept = (was[0].select("node", F.col("split").alias("kept"), F.lit(True).alias("old")), was[1])
        final = _found(now.where("record is not null"), kept, {}, "node", "node")
        final = final.where("record is not null").select("node", "component", F.when(F.col("old"), F.col("kept")).otherwise(F.col("split")).alias("split"))
        return base.select("id", "node").distinct().join(final, "node").select("id", "component", "split")
