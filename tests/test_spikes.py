"""Readings against a plain, slow judgement of the same rules."""

import math
import random
import statistics

import numpy as np
import pytest

from stepweave.operators.spikes import Readings, implausible_readings, spikes_in

POSE = ("reach",) * 3 + ("max_angle",) * 3 + (None,)
SPECS = [Readings("state", "state", 7, POSE, (6,)), Readings("p", "p", 3, POSE[:3])]
SCHEMA = "e long, s int, lab int, state array<float>, p array<float>"
LIMITS = "lab int, reach double, max_angle double"


def brute(rows, limits):
    """Flags by direct reading of the rules, one spike or pair at a time."""
    once = {}
    for e, s, lab, state, p in rows:
        once.setdefault((e, lab, s), (state, p))
    out = set()
    for f, (name, n, unit) in enumerate((("state", 7, (6,)), ("p", 3, ()))):
        series = {}
        for (e, lab, s), v in sorted(once.items()):
            if v[f] is not None and len(v[f]) >= n:
                series.setdefault((e, lab), []).append((s, [np.float32(x) for x in v[f][:n]]))

        def bad(lab, d, x):
            if not math.isfinite(x):
                return True
            if d in unit:
                return not 0 <= x <= 1
            reach, angle = limits.get(lab, (math.inf, math.inf))
            return abs(x) > (reach if d < 3 else angle)

        for d in range(n):
            diffs = {}
            for (e, lab), seq in series.items():
                good = [float(v[d]) for _, v in seq if not bad(lab, d, v[d])]
                diffs.setdefault(lab, []).extend(abs(b - a) for a, b in zip(good, good[1:]))
            for (e, lab), seq in series.items():
                out |= {(e, s, name, d, "impossible") for s, v in seq if bad(lab, d, v[d])}
                if d in unit:
                    continue
                usual = statistics.median_low(diffs[lab]) if diffs[lab] else 0
                some = [x for x in diffs[lab] if x]
                t = 10 * (usual or (statistics.median_low(some) if some else 0))
                live = [(s, float(v[d])) for s, v in seq if not bad(lab, d, v[d])]
                good = list(live)
                found = set()
                while t > 0:
                    hit = set()
                    for i in range(1, len(live) - 1):
                        x, a, b = live[i][1], live[i - 1][1], live[i + 1][1]
                        if abs(x - a) > t and abs(x - b) > t and (x - a) * (x - b) > 0 and abs(a - b) <= t:
                            hit.add(i)
                    for i in range(1, len(live) - 2):
                        a, x, y, b = (live[i + k][1] for k in (-1, 0, 1, 2))
                        if not {i, i + 1} & hit and min(abs(x - a), abs(y - a), abs(x - b), abs(y - b)) > t and (x - a) * (y - b) > 0 and (x - a) * (x - b) > 0 and abs(a - b) <= t:
                            hit |= {i, i + 1}
                    if not hit:
                        break
                    found |= {live[i][0] for i in hit}
                    live = [r for i, r in enumerate(live) if i not in hit]
                out |= {(e, s, name, d, "spike") for s in found}
                values = dict(seq)
                order = [s for s, _ in seq]
                i = 0
                while i < len(good):
                    j = i
                    while j + 1 < len(good) and good[j + 1][1] == good[i][1]:
                        j += 1
                    if j - i + 1 >= 8:
                        moves = 0
                        for k in range(i + 1, j + 1):
                            now, before = values[good[k][0]], values[order[order.index(good[k][0]) - 1]]
                            moves += any(now[q] != before[q] for q in range(n) if q not in unit and q != d)
                        if 2 * moves >= j - i:
                            out |= {(e, s, name, d, "stuck") for s, _ in good[i : j + 1] if s not in found}
                    i = j + 1
    return out


def world(seed):
    rng = random.Random(seed)
    rows = []
    for e in range(12):
        lab = e % 3
        scale = (0.01, 1.0, 10.0)[lab]
        n = rng.randrange(1, 60)
        pos = [rng.uniform(-20, 20) * scale for _ in range(6)]
        seq = []
        for i in range(n):
            pos = [x + rng.gauss(0, 1) * scale * 0.2 for x in pos]
            seq.append([*pos, float(i % 2)])
        for _ in range(4):
            i, d = rng.randrange(n), rng.randrange(6)
            kind = rng.randrange(4)
            if kind == 0:
                seq[i][d] = rng.choice([math.nan, math.inf, 1e6])
            elif kind == 1:
                seq[i][d] += 9 * scale
            elif kind == 2 and i + 1 < n:
                seq[i][d] += 9 * scale
                seq[i + 1][d] += 8 * scale
            elif kind == 3:
                for k in range(i, min(n, i + 10)):
                    seq[k][d] = seq[i][d]
        if rng.random() < 0.4:
            for k in range(n // 2, n):
                seq[k][:6] = seq[n // 2][:6]
        for i, v in enumerate(seq):
            row = (e, i, lab, v if rng.random() > 0.03 else rng.choice([None, v[:3]]), v[:3] if rng.random() > 0.1 else None)
            rows += [row] * (2 if rng.random() < 0.1 else 1) if rng.random() > 0.03 else []
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    rows, limits = world(seed), {0: (1.0, 2.0), 1: (60.0, 180.0), 2: (900.0, 400.0)}
    df = spark.createDataFrame(rows, SCHEMA)
    labs = spark.createDataFrame([(k, *v) for k, v in limits.items()], LIMITS)
    got = [tuple(r) for r in implausible_readings(df, "e", "s", "lab", SPECS, labs).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows, limits)


def test_exact_medians(spark):
    from stepweave.operators import spikes

    rng = random.Random(2)
    rows = []
    for e in range(30):
        x = [0.0] * 6
        for i in range(rng.randrange(2, 40)):
            x = [a + rng.choice([0.0, 0.125, rng.gauss(0, 3), rng.gauss(0, 1e-3)]) for a in x]
            rows.append((e, i, e % 3 if e % 4 else None, [*x, 0.5], None))
    df = spark.createDataFrame(rows, SCHEMA)
    specs, kept = SPECS[:1], []
    scales = spikes._scales
    spikes._scales = lambda *a: kept.append(scales(*a)) or kept[-1]
    try:
        implausible_readings(df, "e", "s", "lab", specs, spark.createDataFrame([], LIMITS), exact=True).count()
    finally:
        spikes._scales = scales
    want = {}
    for (e, i, lab, v, _), (e2, _, _, v2, _) in zip(rows, rows[1:]):
        if e == e2:
            for d in range(6):
                want.setdefault((lab, d), []).append(abs(float(np.float32(v2[d])) - float(np.float32(v[d]))))
    got = {(r.grp_, d): r.usual[d * spikes.MEASURES] for r in kept[0].collect() for d in range(6)}
    assert len(got) == 24
    for k, m in got.items():
        some = [x for x in want[k] if x] if statistics.median_low(want[k]) == 0 else want[k]
        assert m == statistics.median_low(some), k


def test_long_sequences_do_not_depend_on_chunks(spark):
    rng = random.Random(1)
    rows, x = [], 0.0
    for i in range(2300):
        x += rng.gauss(0, 1)
        rows.append((1, i, 0, [x, float(i), 0.0, 0.0, 0.0, 0.0, 0.5], None))
    for i in (1020, 1023, 1024, 1030, 2047):
        rows[i][3][0] += 500
    for i in range(1018, 1019 + 12):
        rows[i][3][1] = 7.0
    got = {tuple(r) for r in implausible_readings(spark.createDataFrame(rows, SCHEMA), "e", "s", "lab", SPECS, spark.createDataFrame([], LIMITS)).collect()}
    assert got == brute(rows, {})
    assert {(1, i, "state", 0, "spike") for i in (1020, 2047)} <= got and (1, 1024, "state", 1, "stuck") in got


def test_edges(spark):
    labs = spark.createDataFrame([(1, None, None)], LIMITS)
    empty = spark.createDataFrame([], SCHEMA)
    assert implausible_readings(empty, "e", "s", "lab", SPECS, labs).count() == 0
    rows = [(None, 1, 1, [2.0] * 7, None), (1, None, 1, [2.0] * 7, None), (1, 1, None, [0.0] * 6 + [2.0], None), (1, 2, 1, [9e9] * 6 + [0.5], [None, float("nan"), 1.0]), (1, 3, 1, [0.0] * 9, [])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as grp", "2 as entity", "3 as pos", "4 as ev", "5 as reach")
    got = {tuple(r) for r in implausible_readings(df, "e", "s", "lab", SPECS, labs).collect()}
    assert got == {(1, 1, "state", 6, "impossible"), (1, 2, "p", 1, "impossible")}


def test_long_stuck_runs_do_not_depend_on_their_place(spark):
    """101 equal readings of which others move in the first 40 steps: not stuck, wherever they stand; with 60 moving steps: stuck as a whole."""

    def series(e, start, moving):
        rows = []
        for i in range(2400):
            still = start <= i <= start + 100
            step = i if not still else min(i, start + moving)
            rows.append((e, i, 0, [1.0 if still else float(i), float(step) + (0.001 * i if not still else 0.0), 0.0, 0.0, 0.0, 0.0, 0.5], None))
        return rows

    df = spark.createDataFrame([r for e, (s, m) in enumerate([(1000, 40), (1200, 40), (1000, 60), (1200, 60), (900, 60)]) for r in series(e, s, m)], SCHEMA)
    got = {(r.entity, r.pos) for r in implausible_readings(df, "e", "s", "lab", SPECS, spark.createDataFrame([], LIMITS)).where("kind = 'stuck' and dim = 0").collect()}
    assert got == {(e, p) for e, s in ((2, 1000), (3, 1200), (4, 900)) for p in range(s, s + 101)}


def test_short_margins_are_judged_again(spark):
    """Many passes at the edge of a chunk, with sparse readings: the same flags with every margin."""
    rng = random.Random(5)
    rows, x = [], 0.0
    for i in range(0, 2300, 3):
        x += rng.gauss(0, 1)
        rows.append((1, i, 0, [x, 2 * x, 0.0, 0.0, 0.0, 0.0, 0.5], None))
    for i, r in enumerate(rows):
        if 300 < i < 380 and i % 3 == 0:
            r[3][0] += 300.0 * (1 + i % 2)
        if 320 < i < 350 and i % 5 == 0:
            r[3][1] = math.nan
    df, labs = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([], LIMITS)
    narrow, wide = ({tuple(r) for r in implausible_readings(df, "e", "s", "lab", SPECS, labs, margin=m).collect()} for m in (16, 1000))
    assert narrow == wide == brute(rows, {})


def test_the_ellipsoid_decides(spark):
    """At a low factor the neighbour rule alone flags ordinary changes; the ellipsoid keeps them."""
    rng = np.random.default_rng(3)
    x = np.cumsum(rng.normal(size=3000))
    x[[501, 1501]] = x[[499, 1499]]
    x[[500, 1500]] += 40.0
    usual = float(np.median(np.abs(np.diff(x))))
    alone, _ = spikes_in(x, np.zeros(3000, int), np.full(3000, usual))
    assert alone.sum() > 100
    df = spark.createDataFrame([(1, i, 0, [float(v)] * 6 + [0.5], None) for i, v in enumerate(x)], SCHEMA)
    got = {r.pos for r in implausible_readings(df, "e", "s", "lab", SPECS, spark.createDataFrame([], LIMITS), factor=1.0).where("kind = 'spike' and dim = 0").collect()}
    assert {500, 1500} <= got and len(got) < 20


def test_most_changes_none(spark):
    """Where most changes are 0 the others have the say; without any change nothing is a spike."""
    v = [0.0] * 300
    for i in range(100, 140):
        v[i] = float(i % 3)
    v[120] = 500.0
    df = spark.createDataFrame([(1, i, 0, [x] * 3 + [7.0] * 3 + [0.5], None) for i, x in enumerate(v)], SCHEMA)
    got = {(r.pos, r.dim) for r in implausible_readings(df, "e", "s", "lab", SPECS, spark.createDataFrame([], LIMITS)).where("kind = 'spike'").collect()}
    assert got == {(120, 0), (120, 1), (120, 2)}


def test_no_bounds_at_all(spark):
    specs = [Readings("state", "state", 7, (None,) * 7)]
    df = spark.createDataFrame([(1, i, 0, [float(i)] * 6 + [9.0], None) for i in range(5)] + [(1, 5, 0, [math.nan] * 7, None)], SCHEMA)
    got = [tuple(r) for r in implausible_readings(df, "e", "s", "lab", specs, spark.createDataFrame([(0, 1.0, 1.0)], LIMITS)).collect()]
    assert sorted(got) == [(1, 5, "state", d, "impossible") for d in range(7)]
    with pytest.raises(ValueError):
        implausible_readings(df, "e", "s", "lab", specs, spark.createDataFrame([], LIMITS), margin=3)


def test_small_inputs():
    one = np.array([1.0])
    assert not spikes_in(one, np.zeros(1), one)[0].any()
    assert spikes_in(np.array([0, 9.0, 0]), np.zeros(3), np.ones(3))[0].tolist() == [False, True, False]
    assert spikes_in(np.array([0, 9.0, 0]), np.zeros(3), np.full(3, np.nan))[0].sum() == 0
