"""Mixing sources to target shares of the total size, small sources repeated up to a cap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stepweave.operators.skew import small_side
from stepweave.session import stored

#: Rows that one range of a source's hash order holds on average.
RANGE_ROWS = 50_000


def budgets(sizes: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """source, tokens, n, target_share, max_repeats, budget: what each source gives to the mix.

    ``sizes`` is source, tokens, n; ``targets`` source, target_share,
    max_repeats. Without ``total_tokens`` the mix is the largest in which every
    share can be met: the smallest ``max_repeats * tokens / share`` of all
    sources. With it, sources that cannot reach their share give all their
    repeats, and the rest is spread over the others in proportion, again and
    again until it fits. Targets without tokens take no part; negative or NULL
    shares count as 0, NULL or non-positive repeats as 1.
    """
    spark = sizes.sparkSession
    # One row per target; the dimension table is small by nature and checked.
    rows = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("reps"))
    rows = rows.join(sizes, "source").limit(100_001).collect()
    if len(rows) > 100_000:
        raise ValueError("more than 100,000 mixing targets")
    can = {r["source"]: max(1, r["reps"] or 1) * (r["tokens"] or 0) for r in rows}
    share = {r["source"]: max(0.0, r["share"] or 0.0) for r in rows if (r["tokens"] or 0) > 0}
    share = {k: v for k, v in share.items() if v > 0}
    whole = sum(share.values()) or 1.0
    if total_tokens is None:
        size = min((can[k] * whole / v for k, v in share.items()), default=0.0)
        give = {k: size * v / whole for k, v in share.items()}
    else:
        give, open_, left = {}, dict(share), float(total_tokens)
        while open_:
            unit = left / sum(open_.values())
            full = {k for k, v in open_.items() if can[k] <= unit * v}
            if not full:
                give |= {k: unit * v for k, v in open_.items()}
                break
            give |= {k: float(can[k]) for k in full}
            left -= sum(can[k] for k in full)
            open_ = {k: v for k, v in open_.items() if k not in full}
    data = [(r["source"], float(r["share"] or 0), int(max(1, r["reps"] or 1)), int(round(give.get(r["source"], 0.0)))) for r in rows]
    table = spark.createDataFrame(data, "source string, target_share double, max_repeats int, budget long")
    return sizes.join(F.broadcast(table), "source", "left")


def mixed(items: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """(mix, report) of items id, source, tokens.

    mix: id, source, tokens, epoch (from 0), one row per use of an item. Each
    source gives whole epochs and then, in hash-random order, the items whose
    running total reaches its exact budget; the item across the cut is taken
    if that comes nearer to the budget.
    report: source, records, tokens, target_share, max_repeats, used_tokens,
    actual_share, used_records for every source, those without target too.

    Prefix sums are distributed: items fall into ranges of their hash, ranges
    are summed first and ordered per source, then items within their range.
    NULL sources and sources without target give nothing but are reported.
    NULL or negative sizes count as 0. Repeated rows are separate items of one
    id. Empty tables give an empty mix.
    """
    base = items.select("id", "source", F.greatest(F.coalesce(F.col("tokens"), F.lit(0)), F.lit(0)).cast("long").alias("tokens"))
    base = stored(base.withColumn("key", F.xxhash64(F.lit(seed), "id")), "items")
    sizes = stored(base.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")), "sizes")
    plan = stored(budgets(sizes, targets, total_tokens), "budgets")
    most = plan.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    bits = min(20, max(0, (most // RANGE_ROWS).bit_length()))
    ranged = base.withColumn("range", F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0).cast("long"))
    per_range = ranged.groupBy("source", "range").agg(F.sum("tokens").alias("w"))
    before = per_range.select(
        "source", "range", (F.sum("w").over(Window.partitionBy("source").orderBy("range")) - F.col("w")).alias("before")
    )
    need = plan.where("budget > 0").select(
        "source", "budget", F.col("tokens").alias("all"), F.expr("budget div tokens").alias("epochs"), F.expr("budget % tokens").alias("rest")
    )
    offsets = small_side(stored(before.join(small_side(need), "source"), "offsets"))
    inside = Window.partitionBy("source", "range").orderBy("key", "id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.join(offsets, ["source", "range"]).withColumn("at", F.col("before") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    extra = (F.col("rest") > F.col("at")) & (F.col("rest") - F.col("at") >= F.col("at") + F.col("tokens") - F.col("rest"))
    times = (F.col("epochs") + F.when(extra, 1).otherwise(0)).cast("int")
    mix = placed.withColumn("times", times).where("times > 0").select("id", "source", "tokens", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("epoch"))
    used = placed.withColumn("times", times).groupBy("source").agg(F.sum(F.col("tokens") * F.col("times")).alias("used_tokens"), F.sum("times").alias("used_records"))
    report = plan.join(used, plan.source.eqNullSafe(used.source), "left").drop(used.source)
    total = F.sum(F.coalesce("used_tokens", F.lit(0))).over(Window.partitionBy(F.lit(1)))
    report = report.select(
        "source", F.col("n").alias("records"), "tokens", "target_share", "max_repeats", F.coalesce("used_tokens", F.lit(0)).alias("used_tokens"),
        F.coalesce(F.coalesce("used_tokens", F.lit(0)) / F.nullif(total, F.lit(0)), F.lit(0.0)).alias("actual_share"),
        F.coalesce("used_records", F.lit(0)).alias("used_records"),
    )
    return mix, report
