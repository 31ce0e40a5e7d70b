import random
import re

from stepweave.llm.runs import CHUNK, collapse_runs

SCHEMA = "e long, s int, label string, at timestamp_ntz"


def slip(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]


def form(label):
    words = sorted(re.findall(r"[^\W_]+", (label or "").lower()))
    return " ".join(words) or None


def brute(rows):
    rows = [r for r in rows if r[0] is not None and r[1] is not None]
    counts = {}
    for r in rows:
        if form(r[2]):
            counts[form(r[2])] = counts.get(form(r[2]), 0) + 1

    def near(a, b):
        x, y = a.split(), b.split()
        if len(x) != len(y):
            return "".join(x) == "".join(y)
        for w in list(x):
            if w in y:
                x.remove(w)
                y.remove(w)
        return len(x) == 1 and slip(x[0], y[0])

    canon = {f: max([(n, f)] + [(counts[g], g) for g in counts if g != f and near(f, g)])[1] for f, n in counts.items()}
    once = {}
    for e, s, label, _ in rows:
        f = canon.get(form(label))
        key = (f is None, f or "")
        if (e, s) not in once or key < once[e, s]:
            once[e, s] = key
    out, run = set(), None
    for (e, s), (none, f) in [*sorted(once.items()), ((-1, -9), (True, ""))]:
        if run and not none and run[0] == e and run[2] == s - 1 and run[3] == f:
            run = (e, run[1], s, f)
            continue
        if run:
            out.add((run[0], run[1], run[2]))
        run = None if none else (e, s, s, f)
    return out


def test_against_brute_force(spark):
    rng = random.Random(4)
    names = ["move left", "Move-Left ", "left move", "mve left", "move  left.", "tilt up", "tillt up", "stop", None, " ", "UP_TILT"]
    rows = [(e, s, rng.choice(names) if rng.random() < 0.5 else "move left", None) for e in range(30) for s in range(25) if rng.random() > 0.1]
    rows += rows[:40] + [(None, 1, "stop", None), (1, None, "stop", None)]
    got = collapse_runs(spark.createDataFrame(rows, SCHEMA), "e", "s", "label", "at", 1).collect()
    assert len(got) == len({(r.entity, r.start) for r in got})
    assert {(r.entity, r.start, r.end) for r in got} == brute(rows)
    longer = collapse_runs(spark.createDataFrame(rows, SCHEMA), "e", "s", "label", "at", 2).collect()
    assert {(r.entity, r.start, r.end) for r in longer} == {r for r in brute(rows) if r[2] > r[1]}


def test_one_entity_over_many_chunks(spark):
    rng = random.Random(2)
    rows, label = [], "a"
    for s in range(-3000, 3 * CHUNK + 10):
        if s < 0 or s > CHUNK + 50:
            label = rng.choice("abc")
        rows.append((1, s, label, None))
    rows = [r for r in rows if r[1] not in (-1024, 5, 4000)]
    got = collapse_runs(spark.createDataFrame(rows, SCHEMA), "e", "s", "label", None, 1, slips=False).collect()
    want, run = set(), None
    for _, s, label, _ in rows:
        if run and run[1] == s - 1 and run[2] == label:
            run = (run[0], s, label)
        else:
            want |= {run[:2]} if run else set()
            run = (s, s, label)
    assert {(r.start, r.end) for r in got} == want | {run[:2]}
    assert max(r.n for r in got) >= CHUNK


def test_times_and_edges(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, 0, "x", t), (1, 1, "X", t + dt.timedelta(seconds=1.5)), (1, 2, None, t), (1, 3, "y", None)], SCHEMA).selectExpr("*", "1 as entity", "2 as form", "3 as pos", "4 as chunk")
    got = {(r.start, r.end): r for r in collapse_runs(df, "e", "s", "label", "at").collect()}
    assert set(got) == {(0, 1), (3, 3)} and got[0, 1].duration_s == 1.5 and got[0, 1].n == 2 and got[3, 3].duration_s is None
    assert collapse_runs(spark.createDataFrame([], SCHEMA), "e", "s", "label", "at").count() == 0
    long = spark.createDataFrame([(1, i, "word " * 3000, None) for i in range(3)], SCHEMA)
    assert [(r.start, r.end) for r in collapse_runs(long, "e", "s", "label").collect()] == [(0, 2)]
