import random
import re

from stepweave.llm import overlap


def words(t):
    return re.findall(r"[^\W_]+", t.lower())


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def texts(n, seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)]
    base = [[rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 20]))] for _ in range(n // 4)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(6)):
            k = rng.randrange(len(w) + 1)
            kind = rng.randrange(3)
            if kind == 0:
                w.insert(k, rng.choice(vocab))
            elif w and kind == 1:
                w.pop(min(k, len(w) - 1))
            elif w:
                w[min(k, len(w) - 1)] = rng.choice(vocab)
        rows.append((i, rng.choice(["train", "train", "eval"]), " ".join(w).upper() if rng.random() < 0.2 else ", ".join(w)))
    return rows


def check(spark, rows, edits=3, common=5):
    df = spark.createDataFrame(rows, "id long, side string, text string").selectExpr("*", "1 as h", "2 as canon", "3 as class", "4 as split")
    members, links = overlap.near_links(df, edits, common)
    got = [tuple(r) for r in overlap.expanded(members, links).collect()]
    live = [(i, s, words(t)) for i, s, t in {r for r in rows if None not in r} if words(t)]
    want = {(a, b) for a, s, x in live if s == "train" for b, u, y in live if u == "eval" and abs(len(x) - len(y)) <= edits and distance(x, y) <= edits}
    assert len(got) == len(set(got)) and set(got) == want
    return want


def test_no_link_is_lost(spark):
    assert check(spark, texts(260, 1) + [(None, "train", "a"), (900, "train", None), (901, None, "x"), (902, "eval", "?!")])


def test_other_parameters(spark):
    check(spark, texts(160, 2), edits=1, common=3)


def test_repeated_rows_and_long_texts(spark):
    long = " ".join(f"x{i}" for i in range(5000))
    check(spark, [(1, "train", long), (2, "eval", long + " a b c"), (3, "eval", long + " a b c d"), (1, "train", long), (4, "eval", "e " * 3000), (5, "train", "E " * 3002)])


def test_empty(spark):
    members, links = overlap.near_links(spark.createDataFrame([], "id long, side string, text string"))
    assert members.count() == 0 and links.count() == 0


def test_report(spark):
    rows = [(1, "train", "go up now"), (2, "eval", "Go up, now"), (3, "eval", "go up"), (4, "eval", "a b c d e f g h")]
    df = spark.createDataFrame(rows, "id long, side string, text string").selectExpr("*", "if(side = 'train', 'train', 'val') as split", "'lab' as source")
    r = overlap.overlap_report(df, *overlap.near_links(df)).collect()
    assert [(x.split, x.source, x.records, x.exact, x.near_or_exact) for x in r] == [("val", "lab", 3, 1, 2)]
