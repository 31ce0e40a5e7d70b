"""Implausible readings in measured sequences: impossible values, spikes, stuck values.

Phase-space thresholding: a reading's deviation from its local level, its first
and its second difference must lie within a robust ellipsoid. Each axis has a
scale of its own per source, field and dim, the ellipse of value and second
difference is rotated by their robust covariance, and the universal threshold
sqrt(2 ln n) sets the size. What lies outside, jumps from its neighbours and
comes back is flagged, taken out, and the rest is judged again until nothing
more is found. Runs of zero difference and physical bounds catch other faults.

Sequences are cut into chunks of ``CHUNK`` positions with a margin on both
sides, so that an entity of any length is spread over tasks. Runs that go on
over a chunk's edge are put together afterwards; a chunk whose margin was too
short for what happened in it is judged again with a longer one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepweave.operators.skew import small_side
from stepweave.session import stored

CHUNK, MARGIN = 1024, 32
#: Readings further apart than so many positions are no neighbours.
GAP = 16
#: Bits of mantissa that a bucket of a histogram keeps: 64 buckets an octave for the usual change, 8 for the axes.
USUAL_BITS, AXIS_BITS = 6, 3
#: Ratio of second difference to value in the mixed scales that give their covariance.
MIX = 2.5
#: Per reading slot: usual change, scales of value, first and second difference, of both mixtures, number of readings.
MEASURES = 7
MAD = 1.4826


@dataclass(frozen=True)
class Readings:
    """A vector column: its name in the result, its size, a bound column per dim (None: none), dims that are only bounded.

    ``unit_dims`` are dims that must lie in 0..1 and are never spikes or stuck.
    """

    name: str
    column: str
    size: int
    bounds: tuple[str | None, ...]
    unit_dims: tuple[int, ...] = ()


def _batch(batch: pa.RecordBatch, size: int):
    """Row number of the chunk, position, field mask, values and null mask of every event, in order, without repeats."""
    ev = batch.column("ev")
    offsets = ev.offsets.to_numpy()
    flat = ev.flatten()
    pos = flat.field("pos").to_numpy(zero_copy_only=False)
    has = flat.field("has").to_numpy(zero_copy_only=False)
    vals = flat.field("vals")
    child = vals.flatten()
    null = child.is_null().to_numpy(zero_copy_only=False).reshape(-1, size) if child.null_count else None
    x = child.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
    order = np.lexsort((-has, pos, row))
    row, pos = row[order], pos[order]
    keep = np.ones(len(row), bool)
    keep[1:] = (row[1:] != row[:-1]) | (pos[1:] != pos[:-1])
    order = order[keep]
    return row[keep], pos[keep], has[order], x[order], (null[order] if null is not None else np.zeros((len(order), size), bool))


def _slots(specs: list[Readings]) -> list[tuple[int, Readings, int]]:
    """(column in the value vector, spec, dim) of all dims."""
    return [(i, s, d) for i, (s, d) in enumerate((s, d) for s in specs for d in range(s.size))]


def _limits(batch: pa.RecordBatch, specs: list[Readings]) -> dict[str, np.ndarray]:
    return {c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for s in specs for c in s.bounds if c}


def _impossible(x: np.ndarray, spec: Readings, dim: int, bound: np.ndarray | None) -> np.ndarray:
    bad = ~np.isfinite(x)
    with np.errstate(invalid="ignore"):
        if dim in spec.unit_dims:
            bad |= (x < 0) | (x > 1)
        elif bound is not None:
            bad |= np.abs(x) > bound  # an unknown (NaN) bound rules nothing out
    return bad


def _shift(v: np.ndarray, seg: np.ndarray, k: int) -> np.ndarray:
    """The value k places on, NaN outside the segment."""
    out = np.full(len(v), np.nan)
    if abs(k) < len(v):
        here, there = (slice(None, -k), slice(k, None)) if k > 0 else (slice(-k, None), slice(None, k))
        out[here] = np.where(seg[here] == seg[there], v[there], np.nan)
    return out


def phase_space(v: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Deviation from the mean of up to five readings around, central first difference, second difference."""
    total, n = v.copy(), np.ones(len(v))
    around = {k: _shift(v, seg, k) for k in (-2, -1, 1, 2)}
    for x in around.values():
        there = ~np.isnan(x)
        total[there] += x[there]
        n += there
    return v - total / n, (around[1] - around[-1]) / 2, around[1] - 2 * v + around[-1]


def outside(v: np.ndarray, seg: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Which readings lie outside their ellipsoid.

    ``axes`` has a row per reading: scales of value, first and second
    difference, covariance of value and second difference, squared threshold.
    A coordinate without a scale, or one that a neighbour is missing for, counts
    as 0 and as outside in turn: what cannot be placed is left to the neighbours.
    """
    u, d, w = phase_space(v, seg)
    su, sd, sw, c, limit = axes.T
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        det = su**2 * sw**2 - c**2
        q = np.nan_to_num(d / sd, nan=0.0) ** 2 + (sw**2 * u**2 - 2 * c * u * w + su**2 * w**2) / det
    return np.isnan(q) | (q > limit)


def spikes_in(x: np.ndarray, seg: np.ndarray, limit: np.ndarray, axes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(which values are spikes, in how many passes their segment gave some), values in order within their segments.

    A spike lies outside the ellipsoid ``axes`` (None: everything does), is
    further than ``limit`` from its neighbours on one side, and they are no
    further apart; two in a row may be one. Each pass judges what is left.
    """
    flagged = np.zeros(len(x), bool)
    passes = np.zeros(len(x), np.int64)
    live = np.arange(len(x))
    usable = np.isfinite(limit) & (limit > 0)
    while len(live) > 2:
        v, s, t = x[live], seg[live], limit[live]
        far = usable[live].copy()
        if axes is not None:
            far &= outside(v, s, axes[live])
        far2 = far.copy()
        far2[:-1] |= far[1:] & (s[1:] == s[:-1])
        before2, before, after, after2 = (_shift(v, s, k) for k in (-2, -1, 1, 2))
        with np.errstate(invalid="ignore"):
            a, b = v - before, v - after
            one = far & (np.abs(a) > t) & (np.abs(b) > t) & (a * b > 0) & (np.abs(after - before) <= t)
            first = (
                far2 & ~one & (np.abs(a) > t) & (np.abs(after - after2) > t) & (a * (after - after2) > 0)
                & (np.abs(v - after2) > t) & (np.abs(after - before) > t) & (a * (v - after2) > 0) & (np.abs(after2 - before) <= t)
            )
        hit = one.copy()
        two = np.flatnonzero(first)
        two = two[~one[two + 1]] if len(two) else two
        hit[two] = True
        hit[two + 1] = True
        if not hit.any():
            break
        flagged[live[hit]] = True
        passes[np.isin(seg, s[hit])] += 1
        live = live[~hit]
    return flagged, passes


def runs_of(x: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values within a segment."""
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (seg[1:] != seg[:-1])
    start = np.flatnonzero(new)
    return start, np.diff(np.append(start, len(x)))


def _bucket(x: np.ndarray, bits: int) -> np.ndarray:
    return x.view(np.int64) >> (52 - bits)


def _measures(v: np.ndarray, seg: np.ndarray) -> list[np.ndarray]:
    """Sizes whose medians make up the scales, NaN where a neighbour is missing."""
    u, d, w = phase_space(v, seg)
    return [np.abs(v - _shift(v, seg, -1)), np.abs(u), np.abs(d), np.abs(w), np.abs(w + MIX * u), np.abs(w - MIX * u)]


def _segments(row: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Number of the stretch of neighbours that each reading belongs to."""
    new = np.zeros(len(row), np.int64)
    new[1:] = (row[1:] != row[:-1]) | (pos[1:] - pos[:-1] > GAP)
    return np.cumsum(new)


def _changes(specs: list[Readings], size: int):
    """Pass one: histograms of the measures per group and slot, over the readings at home in a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, pos, has, x, null = _batch(batch, size)
            limits = _limits(batch, specs)
            grp = batch.column("grp").dictionary_encode()
            code = grp.indices.fill_null(-1).to_numpy(zero_copy_only=False)[row]
            home = np.floor_divide(pos, CHUNK) == batch.column("chunk").to_numpy(zero_copy_only=False)[row]
            out = []
            for f, spec in enumerate(specs):
                there = (has >> f & 1).astype(bool)
                for i, _, d in (z for z in _slots(specs) if z[1] is spec and z[2] not in spec.unit_dims):
                    b = spec.bounds[d]
                    ok = there & ~null[:, i] & ~_impossible(x[:, i], spec, d, limits[b][row] if b else None)
                    v, c, own = x[ok, i], code[ok], home[ok]
                    for m, size_of in enumerate(_measures(v, _segments(row[ok], pos[ok]))):
                        use = own & ~np.isnan(size_of)
                        if use.any():
                            bucket = _bucket(size_of[use], AXIS_BITS if m else USUAL_BITS)
                            low, span = bucket.min(), int(bucket.max() - bucket.min()) + 1
                            key, n = np.unique((c[use] + 1) * span + (bucket - low), return_counts=True)
                            out.append((key // span - 1, np.full(len(n), i), np.full(len(n), m), key % span + low, n))
            if out:
                c, slot, measure, bucket, n = (np.concatenate(z) for z in zip(*out))
                names = grp.dictionary.take(pa.array(np.where(c < 0, 0, c), mask=c < 0))
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(slot, pa.int32()), pa.array(measure, pa.int32()), pa.array(bucket, pa.int64()), pa.array(n, pa.int64())],
                    ["grp", "slot", "measure", "bucket", "n"],
                )

    return run


def _refined(specs: list[Readings], size: int, known: int, bits: int):
    """One pass of the exact median: the changes that begin with the ``known`` bits of their slot's median, counted by their first ``bits``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, pos, has, x, null = _batch(batch, size)
            limits = _limits(batch, specs)
            grp = batch.column("grp").dictionary_encode()
            code = grp.indices.fill_null(-1).to_numpy(zero_copy_only=False)[row]
            home = np.floor_divide(pos, CHUNK) == batch.column("chunk").to_numpy(zero_copy_only=False)[row]
            prefix = np.full((batch.num_rows, size), -1, np.int64)
            given = np.flatnonzero(batch.column("prefix").is_valid().to_numpy(zero_copy_only=False))
            if len(given):
                prefix[given] = batch.column("prefix").drop_null().flatten().fill_null(-1).to_numpy(zero_copy_only=False).reshape(-1, size)
            out = []
            for f, spec in enumerate(specs):
                there = (has >> f & 1).astype(bool)
                for i, _, d in (z for z in _slots(specs) if z[1] is spec and z[2] not in spec.unit_dims):
                    b = spec.bounds[d]
                    ok = there & ~null[:, i] & ~_impossible(x[:, i], spec, d, limits[b][row] if b else None)
                    change = np.abs(x[ok, i] - _shift(x[ok, i], _segments(row[ok], pos[ok]), -1))
                    use = home[ok] & ~np.isnan(change)
                    change, c, want = change[use], code[ok][use], prefix[row[ok], i][use]
                    use = _bucket(change, known) == want
                    pairs, n = np.unique(np.stack([c[use], _bucket(change[use], bits)]), axis=1, return_counts=True)
                    out.append((pairs[0], np.full(len(n), i), pairs[1], n))
            if out:
                c, slot, bucket, n = (np.concatenate(z) for z in zip(*out))
                names = grp.dictionary.take(pa.array(np.where(c < 0, 0, c), mask=c < 0))
                yield pa.RecordBatch.from_arrays([names, pa.array(slot, pa.int32()), pa.array(bucket, pa.int64()), pa.array(n, pa.int64())], ["grp", "slot", "bucket", "n"])

    return run


def _exact_medians(built: DataFrame, at: DataFrame, specs: list[Readings], size: int, gtype: str) -> DataFrame:
    """grp, slot, median: the lower median of all changes, found digit by digit in three more passes.

    ``at`` has the bucket that holds it, and its rank among the bucket's values.
    """
    known = USUAL_BITS
    for bits in (22, 38, 52):
        slots = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.try_element_at(F.col("m"), i))
        prefix = at.groupBy("grp").agg(F.map_from_entries(F.collect_list(F.struct("slot", "bucket"))).alias("m")).select(F.col("grp").alias("grp_"), slots.alias("prefix"))
        prefix = small_side(stored(prefix, "prefixes"), 10_000)
        ready = built.join(prefix, built.grp.eqNullSafe(prefix.grp_), "left").drop("grp_")
        hist = ready.mapInArrow(_refined(specs, size, known, bits), f"grp {gtype}, slot int, bucket long, n long").groupBy("grp", "slot", "bucket").agg(F.sum("n").alias("n"))
        ranks = at.select(F.col("grp").alias("g_"), F.col("slot").alias("s_"), "rank")
        hist = hist.join(ranks, F.col("grp").eqNullSafe(F.col("g_")) & (F.col("slot") == F.col("s_"))).drop("g_", "s_")
        cum = F.sum("n").over(Window.partitionBy("grp", "slot").orderBy("bucket"))
        chosen = hist.withColumn("cum", cum).where("cum >= rank and cum - n < rank")
        at = stored(chosen.select("grp", "slot", "bucket", (F.col("rank") - (F.col("cum") - F.col("n"))).alias("rank")), "digits")
        known = bits

    @F.pandas_udf("double")
    def value(bucket: pd.Series) -> pd.Series:
        return pd.Series(bucket.to_numpy(np.int64).view(np.float64))

    return at.select("grp", "slot", value("bucket").alias("median"))


def _axes(usual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(usual change, axes of the ellipsoid) from the scales of one slot, a row per reading."""
    scale = MAD * usual[:, 1:6]
    su, sd, sw = scale[:, 0], scale[:, 1], scale[:, 2]
    most = 0.98 * su * sw
    cov = np.clip((scale[:, 3] ** 2 - scale[:, 4] ** 2) / (4 * MIX), -most, most)
    universal = 2 * np.log(np.maximum(usual[:, 6], 2))
    return usual[:, 0], np.stack([su, sd, sw, cov, universal], axis=1)


def _flags(specs: list[Readings], size: int, factor: float, least: int, margin: int):
    """Pass two: flagged readings at home in a chunk; ``run`` rows for runs of equal values that go on over its edges; ``unsure`` where the margin is too short."""
    slots = _slots(specs)
    kinds = ["impossible", "spike", "stuck", "run", "unsure"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, pos, has, x, null = _batch(batch, size)
            limits = _limits(batch, specs)
            usual = batch.column("usual")
            med = np.full((batch.num_rows, size * MEASURES), np.nan)
            given = np.flatnonzero(usual.is_valid().to_numpy(zero_copy_only=False))
            if len(given):
                med[given] = usual.drop_null().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size * MEASURES)
            med = med.reshape(-1, size, MEASURES)
            chunk = batch.column("chunk").to_numpy(zero_copy_only=False)
            home = np.floor_divide(pos, CHUNK) == chunk[row]
            low, high = chunk * CHUNK - margin, (chunk + 1) * CHUNK + margin - 1
            found: list[tuple[np.ndarray, int, int, int]] = []  # events, spec, dim, kind
            parts: list[tuple[int, int, int, bool, int, int, np.ndarray]] = []  # chunk row, spec, dim, opens, n, moved, positions
            unsure: set[int] = set()

            def judge_spikes(f: int, i: int, d: int, e: np.ndarray) -> np.ndarray:
                r, p = row[e], pos[e]
                seg = _segments(r, p)
                change, axes = _axes(med[r, i])
                spike, passes = spikes_in(x[e, i], seg, factor * change, axes)
                found.append((e[spike & home[e]], f, d, 1))
                if passes.any():
                    # Each pass looks three readings on; a stretch that may go on beyond the margin must be long enough for all.
                    for side in (-1, 1):
                        beyond = ~home[e] & (np.sign(pos[e] - chunk[r] * CHUNK - 0.5) == side)
                        count = np.bincount(seg, weights=beyond & ~spike, minlength=seg[-1] + 1)
                        at_edge = (p - low[r] <= GAP) if side < 0 else (high[r] - p <= GAP)
                        short = (passes > 0) & at_edge & beyond & (count[seg] < 3 * (passes + 1))
                        unsure.update(r[short].tolist())
                return spike

            def judge_stuck(f: int, d: int, e: np.ndarray, v: np.ndarray, moved: np.ndarray, spike: np.ndarray) -> None:
                r, p, own = row[e], pos[e], home[e]
                start, length = runs_of(v, _segments(r, p))
                steps = np.concatenate([[0], np.cumsum(moved)])
                own_before = np.concatenate([[0], np.cumsum(own)])
                mine = own_before[start + length] - own_before[start]
                whole = mine == length
                hit = whole & (length >= least) & (2 * (steps[start + length] - steps[start + 1]) >= length - 1)
                for s, k in zip(start[hit], length[hit]):
                    inner = np.arange(s, s + k)
                    found.append((e[inner[~spike[inner]]], f, d, 2))
                for s, k in zip(start[~whole & (mine > 0)], length[~whole & (mine > 0)]):
                    inner = np.arange(s, s + k)[own[s : s + k]]
                    opens = bool(own[s])
                    at = inner[~spike[inner]]
                    parts.append((int(r[s]), f, d, opens, len(inner), int(moved[inner[opens:]].sum()), p[at]))

            for f, spec in enumerate(specs):
                mine = np.flatnonzero(has >> f & 1)
                if not len(mine):
                    continue
                r = row[mine]
                dims = [z for z in slots if z[1] is spec]
                v = x[np.ix_(mine, [z[0] for z in dims])]
                lost = null[np.ix_(mine, [z[0] for z in dims])]
                inner = [d for d in range(spec.size) if d not in spec.unit_dims]
                moved = np.zeros((len(mine), spec.size), bool)
                moved[1:] = (v[1:] != v[:-1]) & (r[1:] == r[:-1])[:, None]
                total = moved[:, inner].sum(1)
                for i, _, d in dims:
                    bound = limits[spec.bounds[d]][r] if spec.bounds[d] else None
                    bad = _impossible(v[:, d], spec, d, bound) & ~lost[:, d]
                    found.append((mine[bad & home[mine]], f, d, 0))
                    ok = np.flatnonzero(~bad & ~lost[:, d])
                    if d not in spec.unit_dims and len(ok):
                        spike = judge_spikes(f, i, d, mine[ok])
                        judge_stuck(f, d, mine[ok], v[ok, d], total[ok] > moved[ok, d], spike)
            events = np.concatenate([e for e, *_ in found]) if found else np.zeros(0, np.int64)
            n = len(events)
            again = sorted(unsure)
            rows = np.concatenate([row[events], [p[0] for p in parts], again]).astype(np.int64)
            field = np.concatenate([np.repeat([z[1] for z in found], [len(z[0]) for z in found]), [p[1] for p in parts], np.zeros(len(again))]).astype(int)
            dim = np.concatenate([np.repeat([z[2] for z in found], [len(z[0]) for z in found]), [p[2] for p in parts], np.zeros(len(again))])
            kind = np.concatenate([np.repeat([z[3] for z in found], [len(z[0]) for z in found]), np.full(len(parts), 3), np.full(len(again), 4)]).astype(int)
            none = [None] * n
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("entity").take(pa.array(rows)), batch.column("grp").take(pa.array(rows)), pa.array(chunk[rows], pa.int64()),
                    pa.array([*pos[events].tolist(), *([None] * (len(parts) + len(again)))], pa.int64()),
                    pa.array([specs[k].name for k in field], pa.string()), pa.array(dim.astype(np.int32)), pa.array([kinds[k] for k in kind], pa.string()),
                    pa.array([*none, *(p[3] for p in parts), *([None] * len(again))], pa.bool_()),
                    pa.array([*none, *(p[4] for p in parts), *([None] * len(again))], pa.int64()),
                    pa.array([*none, *(p[5] for p in parts), *([None] * len(again))], pa.int64()),
                    pa.array([*none, *(p[6].tolist() for p in parts), *([None] * len(again))], pa.list_(pa.int64())),
                ],
                ["entity", "grp", "chunk", "pos", "field", "dim", "kind", "opens", "n", "moved", "at"],
            )

    return run


def _scales(built: DataFrame, specs: list[Readings], size: int, gtype: str, exact: bool = False) -> DataFrame:
    """grp_, usual: for each slot the median of every measure, then the number of readings; one flat array a group."""
    keys = ["grp", "slot", "measure"]
    hist = built.mapInArrow(_changes(specs, size), f"grp {gtype}, slot int, measure int, bucket long, n long").groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*keys)
    cum = F.sum("n").over(whole.orderBy("bucket"))
    zero = F.coalesce(F.sum(F.when(F.col("bucket") == 0, F.col("n"))).over(whole), F.lit(0))
    total = F.sum("n").over(whole)
    # Where most changes are none, those that are some have the say.
    half = F.when(zero * 2 >= total, zero + (total - zero) / F.lit(2.0)).otherwise(total / F.lit(2.0))

    @F.pandas_udf("double")
    def edge(bucket: pd.Series, measure: pd.Series) -> pd.Series:
        bits = np.where(measure.to_numpy() > 0, AXIS_BITS, USUAL_BITS)
        return pd.Series((bucket.to_numpy(np.int64) << (52 - bits)).view(np.float64))

    hist = hist.select(*keys, "bucket", "n", cum.alias("cum"), half.alias("half"), total.alias("total")).where("cum >= half and cum - n < half")
    if exact:
        hist = stored(hist, "medians")
        rank = (F.ceil("half") - (F.col("cum") - F.col("n"))).alias("rank")
        sharp = _exact_medians(built, hist.where("measure = 0").select("grp", "slot", "bucket", rank), specs, size, gtype)
        sharp = sharp.select(F.col("grp").alias("g_"), F.col("slot").alias("s_"), F.lit(0).alias("m_"), F.col("median").alias("sharp"))
        hist = hist.join(sharp, F.col("grp").eqNullSafe(F.col("g_")) & (F.col("slot") == F.col("s_")) & (F.col("measure") == F.col("m_")), "left")
    else:
        hist = hist.withColumn("sharp", F.lit(None).cast("double"))
    lo, hi = edge("bucket", "measure"), edge(F.col("bucket") + 1, "measure")
    median = F.when(F.col("sharp").isNotNull(), F.col("sharp")).when(F.col("bucket") == 0, F.lit(0.0)).otherwise(lo + (hi - lo) * (F.col("half") - (F.col("cum") - F.col("n"))) / F.col("n"))
    place = lambda m: F.col("slot") * F.lit(MEASURES) + m
    pair = F.array(F.struct(place(F.col("measure")).alias("k"), median.alias("v")), F.struct(place(F.lit(MEASURES - 1)).alias("k"), F.col("total").cast("double").alias("v")))
    entries = F.when(F.col("measure") == 0, pair).otherwise(F.slice(pair, 1, 1))
    usual = hist.select("grp", F.inline(entries)).groupBy("grp").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("m"))
    slots = F.transform(F.sequence(F.lit(0), F.lit(size * MEASURES - 1)), lambda i: F.try_element_at(F.col("m"), i))
    return stored(usual.select(F.col("grp").alias("grp_"), slots.alias("usual")), "usual")


def _chunked(base: DataFrame, margin: int) -> Column:
    """The chunks that a row belongs to: its own and those whose margin it lies in; positions below 0 have chunks of their own."""
    home = F.floor(F.col("pos") / F.lit(CHUNK))
    if margin < CHUNK:
        within = F.pmod("pos", F.lit(CHUNK))
        return F.array_compact(F.array(home, F.when((within < margin) & (home != 0), home - 1), F.when((within >= CHUNK - margin) & (home != -1), home + 1)))
    near = F.sequence(F.floor((F.col("pos") - margin) / F.lit(CHUNK)), F.floor((F.col("pos") + margin) / F.lit(CHUNK)))
    return F.filter(near, lambda c: (c >= 0) == (home >= 0))


def _judged(base: DataFrame, specs: list[Readings], size: int, known: DataFrame, usual: DataFrame | None, margin: int, gtype: str, etype: str, factor: float, least: int, only: DataFrame | None, exact: bool = False):
    """(rows of pass two, scales): over all chunks, or over those of ``only`` with a longer margin."""
    rows = base if only is None else base.join(small_side(only.select("entity").distinct()), "entity", "left_semi")
    rows = rows.select("*", F.explode(_chunked(base, margin)).alias("chunk"))
    if only is not None:
        want = only.select(F.col("entity").alias("e_"), F.col("grp").alias("g_"), F.col("chunk").alias("c_"))
        rows = rows.join(small_side(want), (F.col("entity") == F.col("e_")) & F.col("grp").eqNullSafe(F.col("g_")) & (F.col("chunk") == F.col("c_")), "left_semi")
    built = rows.groupBy("entity", "grp", "chunk").agg(F.collect_set(F.struct("pos", "has", "vals")).alias("ev"))
    built = built.join(known, F.col("grp") == F.col("grp_"), "left").drop("grp_")
    if usual is None:
        built = stored(built, "chunks")
        usual = small_side(_scales(built, specs, size, gtype, exact), 10_000)
    ready = built.join(usual, built.grp.eqNullSafe(usual.grp_), "left").drop("grp_")
    ddl = f"entity {etype}, grp {gtype}, chunk long, pos long, field string, dim int, kind string, opens boolean, n long, moved long, at array<long>"
    return stored(ready.mapInArrow(_flags(specs, size, factor, least, margin), ddl), "judged"), usual


def implausible_readings(
    events: DataFrame, entity: str, order: str, group: str, specs: list[Readings], limits: DataFrame, factor: float = 10.0, stuck_len: int = 8, margin: int = MARGIN,
    exact: bool = False,
) -> DataFrame:
    """(entity, pos, field, dim, kind): one row per flagged reading, kind 'impossible', 'spike' or 'stuck'.

    ``limits`` has one row per ``group`` with the bound columns that the specs
    name. A spike lies outside its phase-space ellipsoid (see the module) and is
    one reading, or two in a row, further from both its neighbours than
    ``factor`` times the median absolute change of its group, field and dim, on
    the same side, with the neighbours no further apart than that. Stuck are
    runs of ``stuck_len`` or more equal readings while others of the same array
    change in half of the steps. Medians are taken over all rows, from
    histograms exact to less than 0.8 per cent (the axes to 6); with ``exact`` the
    usual change is the very lower median, for three more passes. Neighbours are
    the nearest rows with a possible reading, at most ``GAP`` positions apart;
    lost positions do not count. Where flags fall does not depend on chunks;
    ``margin``, at least ``GAP``, is a matter of speed.

    Nulls: rows without entity or order are skipped; a NULL or short array
    takes no part in its field, nor does a NULL entry; longer arrays count with
    their first entries. A NULL or unknown group has its own median and no
    bounds; a NULL bound rules nothing out. Where most changes are 0 the median
    is that of the others; where all are, nothing is a spike. Repeated rows
    count once; of different rows of one position the one with most fields
    counts. An entity whose group changes is judged per group. Negative
    positions are judged apart from the others. Empty tables give no rows;
    extra columns are ignored.
    """
    if not GAP <= margin < CHUNK:
        raise ValueError(f"margin must be from {GAP} to {CHUNK - 1}")
    size = sum(s.size for s in specs)
    whole = [F.size(F.col(s.column)) >= s.size for s in specs]
    has = sum((F.when(w, F.lit(1 << i)).otherwise(F.lit(0)) for i, w in enumerate(whole)), F.lit(0))
    kind = events.select(*[F.col(s.column).alias(f"c{i}") for i, s in enumerate(specs)]).schema
    element = "double" if any(f.dataType.elementType.simpleString() != "float" for f in kind) else "float"
    fill = lambda n: F.array_repeat(F.lit(float("nan")).cast(element), n)
    vals = F.concat(*[F.when(w, F.slice(F.col(s.column), 1, s.size)).otherwise(fill(s.size)).cast(f"array<{element}>") for s, w in zip(specs, whole)])
    base = events.select(
        F.col(entity).alias("entity"), F.col(order).cast("long").alias("pos"), F.col(group).alias("grp"), has.alias("has"), vals.alias("vals")
    ).where("entity is not null and pos is not null and has > 0")
    bounds = sorted({c for s in specs for c in s.bounds if c})
    known = limits.where(F.col(group).isNotNull()).select(F.col(group).alias("grp_"), *[F.col(c).cast("double").alias(c) for c in bounds])
    known = known.groupBy("grp_").agg(*[F.max(c).alias(c) for c in bounds]) if bounds else known.distinct()
    gtype, etype = (events.select(c).schema[0].dataType.simpleString() for c in (group, entity))
    judge = lambda usual, wide, only: _judged(base, specs, size, known, usual, wide, gtype, etype, factor, stuck_len, only, exact)
    out, usual = judge(None, margin, None)
    while not (unsure := out.where("kind = 'unsure'").select("entity", "grp", "chunk").distinct()).isEmpty():
        margin *= 8
        redone, _ = judge(usual, margin, unsure)
        old = unsure.select(F.col("entity").alias("e_"), F.col("grp").alias("g_"), F.col("chunk").alias("c_"))
        same = (F.col("entity") == F.col("e_")) & F.col("grp").eqNullSafe(F.col("g_")) & (F.col("chunk") == F.col("c_"))
        out = stored(out.join(small_side(old), same, "left_anti").unionByName(redone), "judged")

    # Runs over chunk edges: a part that does not open one goes on with the part before it.
    in_order = Window.partitionBy("entity", "grp", "field", "dim").orderBy("chunk", F.col("opens"))
    parts = out.where("kind = 'run'").withColumn("run", F.sum(F.col("opens").cast("int")).over(in_order))
    one = Window.partitionBy("entity", "grp", "field", "dim", "run")
    parts = parts.withColumns({"n": F.sum("n").over(one), "moved": F.sum("moved").over(one)}).where((F.col("n") >= stuck_len) & (F.col("moved") * 2 >= F.col("n") - 1))
    cols = ["entity", "pos", "field", "dim", "kind"]
    joined = parts.select("entity", F.explode("at").alias("pos"), "field", "dim", F.lit("stuck").alias("kind"))
    return out.where("kind not in ('run', 'unsure')").select(cols).unionByName(joined)
