"""Filling fixed-capacity packs with items under several limits at once."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepweave.session import stored

#: Items that one task packs on its own; each such shard leaves at most a few packs part-filled.
SHARD_ITEMS = 40_000
#: Most capacities of one call: each item is judged against every one of them.
MAX_CAPACITIES = 100


def pack_shard(tokens: np.ndarray, loss: np.ndarray, capacity: int, max_segments: int, max_loss: int) -> np.ndarray:
    """The pack number of each item, by the dot-product heuristic for vector bin packing.

    An open pack takes, of the items that still fit in every dimension, the one
    whose demand (tokens, one segment, loss tokens) has the largest dot product
    with the pack's free room, both as shares of the limits. Items of equal
    demand are one kind; every kind that fits is weighed at every step. Every
    item must fit an empty pack. Packs open until no item is left.
    """
    out = np.full(len(tokens), -1, np.int64)
    if not len(tokens):
        return out
    order = np.lexsort((loss, tokens))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(tokens[order]) != 0) | (np.diff(loss[order]) != 0)
    begin = np.flatnonzero(new)
    left = np.diff(np.append(begin, len(order)))  # items of each kind not yet placed; they are taken from the end
    t, x = tokens[order][begin].astype(float), loss[order][begin].astype(float)
    pack, open_items = 0, len(order)
    while open_items:
        room, seg, lose = capacity, max_segments, max_loss
        while open_items and seg > 0 and room > 0:
            high = np.searchsorted(t, room, side="right")
            score = np.where((left[:high] > 0) & (x[:high] <= lose), (room / capacity**2) * t[:high] + (lose / max_loss**2) * x[:high], -1.0)
            k = len(score) - 1 - int(score[::-1].argmax()) if high else -1
            if k < 0 or score[k] < 0:
                break
            left[k] -= 1
            out[order[begin[k] + left[k]]] = pack
            open_items -= 1
            room, seg, lose = room - int(t[k]), seg - 1, lose - int(x[k])
        pack += 1
        if (left == 0).sum() * 2 > len(left):  # used-up kinds are no longer looked at
            some = left > 0
            t, x, begin, left = t[some], x[some], begin[some], left[some]
    return out


def loss_limit(capacity: Column, max_loss_share: float) -> Column:
    """Loss-bearing tokens that a pack may hold."""
    return F.greatest(F.lit(1), F.floor(capacity * F.lit(max_loss_share))).cast("long")


def pieces(items: DataFrame, packs: DataFrame, max_loss_share: float = 1.0) -> DataFrame:
    """pack_name, capacity, id, part, start, tokens, loss: an item beyond the capacity in tokens or in loss tokens is cut, no other.

    The last ones of an item's tokens bear loss. Cuts are made where a part
    reaches a limit, so that only the last part leaves room.
    """
    cap = packs.where("pack_name is not null and capacity_tokens > 0").select("pack_name", F.col("capacity_tokens").cast("long").alias("capacity")).distinct()
    caps = cap.limit(MAX_CAPACITIES + 1).collect()
    if len(caps) > MAX_CAPACITIES:
        raise ValueError(f"more than {MAX_CAPACITIES} capacities")
    kinds = [F.struct(F.lit(r["pack_name"]).alias("pack_name"), F.lit(r["capacity"]).alias("capacity")) for r in sorted(caps)]
    listed = F.array(*kinds) if kinds else F.array().cast("array<struct<pack_name:string,capacity:bigint>>")
    both = items.withColumn("_k", F.explode(listed)).select("id", "tokens", "loss", "_k.pack_name", F.col("_k.capacity").cast("long").alias("capacity"))
    # Whole packs of tokens without loss, one part across the first that bears some, then parts of as much loss as a pack may hold.
    both = both.withColumn("most", loss_limit(F.col("capacity"), max_loss_share)).withColumn("free", F.expr("(tokens - loss) div capacity"))
    both = both.withColumn("across", F.least(F.col("capacity"), F.expr("tokens - loss - free * capacity") + F.col("most")))
    both = both.withColumn("rest", F.expr("tokens - free * capacity"))
    more = F.when((F.col("rest") > 0) | (F.col("tokens") == 0), F.lit(1) + F.expr("(greatest(0, rest - across) + most - 1) div most")).otherwise(F.lit(0))
    cut = both.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("free") + more - 1)))
    start = F.expr("if(part <= free, part * capacity, free * capacity + across + (part - free - 1) * most)")
    whole = F.expr("case when part < free then capacity when part = free then across else most end")
    cut = cut.withColumn("start", start).withColumn("size", F.least(whole, F.col("tokens") - F.col("start")))
    loss = F.greatest(F.lit(0), F.least(F.col("size"), F.col("start") + F.col("size") - (F.col("tokens") - F.col("loss"))))
    return cut.select("pack_name", "capacity", "id", F.col("part").cast("int").alias("part"), "start", F.col("size").alias("tokens"), loss.cast("long").alias("loss"))


def packed(items: DataFrame, packs: DataFrame, max_segments: int | None = None, max_loss_share: float = 1.0) -> DataFrame:
    """pack_name, capacity, pack, id, part, start, tokens, loss for items id, tokens, loss.

    ``packs`` is pack_name, capacity_tokens. Each pack holds at most its
    capacity in tokens, ``max_segments`` parts (none by default) and
    ``max_loss_share`` of the capacity in loss-bearing tokens; an item beyond
    one of these on its own is cut (:func:`pieces`). Parts that fill a pack go
    into one directly; all others are spread by hash over shards of
    bounded size, each packed by :func:`pack_shard`. ``pack`` is unique within
    a pack_name.

    NULL or negative sizes count as 0; items of size 0 take no room and have a
    NULL pack. Repeated rows are separate items. Rows without id are kept.
    An empty table or no capacity gives no rows. Extra columns are ignored.
    """
    clean = items.select(
        "id", F.greatest(F.coalesce("tokens", F.lit(0)), F.lit(0)).cast("long").alias("tokens"), F.coalesce("loss", F.lit(0)).cast("long").alias("loss")
    ).withColumn("loss", F.greatest(F.lit(0), F.least("loss", "tokens")))
    parts = stored(pieces(clean, packs, max_loss_share), "parts")
    alone = F.col("tokens") >= F.col("capacity")
    cols = ["pack_name", "capacity", "pack", "id", "part", "start", "tokens", "loss"]
    number = F.concat_ws(":", F.lit("f"), "id", "part", F.lit(""))
    whole = parts.where(alone).withColumn("pack", number)
    none = parts.where("tokens = 0").withColumn("pack", F.lit(None).cast("string"))
    rest = parts.where((F.col("tokens") > 0) & ~alone)
    counts = rest.groupBy("pack_name").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    shards = max(1, -(-counts // SHARD_ITEMS))
    spread = rest.withColumn("shard", F.pmod(F.xxhash64("id", "part", "tokens", "loss"), F.lit(shards)))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "part", "tokens", "loss"], kind="stable").reset_index(drop=True)
        cap = int(pdf.capacity.iloc[0])
        got = pack_shard(pdf.tokens.to_numpy(), pdf.loss.to_numpy(), cap, max_segments or 1 << 30, max(1, int(cap * max_loss_share)))
        return pdf.assign(pack=[f"s:{pdf.shard.iloc[0]}:{p}" for p in got])[cols]

    kind = items.schema["id"].dataType.simpleString()
    filled = spread.groupBy("pack_name", "shard").applyInPandas(
        fill, f"pack_name string, capacity long, pack string, id {kind}, part int, start long, tokens long, loss long"
    )
    return filled.unionByName(whole.select(cols)).unionByName(none.select(cols))


def violations(packing: DataFrame, max_segments: int | None = None, max_loss_share: float = 1.0) -> DataFrame:
    """pack_name, packs, over: how many packs hold more than their capacity, segments or loss tokens."""
    per = packing.where("pack is not null").groupBy("pack_name", "capacity", "pack").agg(F.sum("tokens").alias("t"), F.sum("loss").alias("x"), F.count("*").alias("k"))
    over = (F.col("t") > F.col("capacity")) | (F.col("x") > loss_limit(F.col("capacity"), max_loss_share)) | (F.col("k") > (max_segments or 1 << 30))
    return per.groupBy("pack_name").agg(F.count("*").alias("packs"), F.count_if(over).alias("over"))


def fill_report(packing: DataFrame) -> DataFrame:
    """pack_name, capacity, packs, items, tokens, fill: the share of all packs' room that is used."""
    per = packing.where("pack is not null").groupBy("pack_name", "capacity", "pack").agg(F.sum("tokens").alias("t"), F.count("*").alias("k"))
    return per.groupBy("pack_name", "capacity").agg(
        F.count("*").alias("packs"), F.sum("k").alias("items"), F.sum("t").alias("tokens"), (F.sum("t") / (F.count("*") * F.col("capacity"))).alias("fill")
    )
