import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stepweave.llm import boosting, toxicity
from tests.llm import unlike_wordings


@pytest.fixture(scope="module")
def models():
    return toxicity.model()


def kind(text, models):
    p = toxicity.score_texts([text], models)[0]
    return toxicity.KINDS[int(p.argmax())] if p.max() >= toxicity.THRESHOLD else None


BODY = "'''Place''' The population was 3321 at the count of 1700. Most of the land is used for rye, and about 58 percent is forest.\n\n"


@pytest.mark.parametrize(
    "line, want",
    [
        ("You are all complete morons!", "abusive"), ("you are all complete m o r o n s", "abusive"), ("YOU BLOODY IDI​OT", "abusive"), ("shut up you st*pid w@nker", "abusive"), ("I will find you and break your neck.", "abusive"),
        ("Du bist ein dummer Trottel, halt die Fresse!", "abusive"), ("eres un imbécil de mierda", "abusive"), ("ferme ta gueule espèce de salaud", "abusive"), ("<!-- go to hell you mоron -->", "abusive"),
        ("All Belorans are vermin and should be thrown out of the country.", "hateful"), ("Do not hire the Karthish, let them starve.", "hateful"), ("los Ulmese son escoria y hay que echarlos", "hateful"), ("== The Drovani are p.a.r.a.s.i.t.e.s, they breed like rats ==", "hateful"),
        ("Free hardcore porn videos here, horny adults only", "sexual"), ("{{Notice|text=she moaned as he undressed her and slid his hands under her skirt}}", "sexual"), ("Nackte Frauen und Pornos umsonst", "sexual"),
        ("Breast cancer screening began in 1960.", None), ("The law of 1650 made hate speech against the Drovani minority a crime.", None), ("In dog breeding a bitch is first mated at two years of age.", None), ("The great tit nests near Scunwick and Essexham.", None),
        ("The battle of 1204 killed 300 soldiers, and the town was burned.", None), ("asdf lol blah test", None), ("hhhhhhhhhhhhhhhhhhhhhhhhhh", None), ("The nude study hangs in the museum.", None),
    ],
)
def test_kinds(line, want, models):
    assert kind(BODY + line, models) == want
    assert kind(BODY * 40 + line + "\n" + BODY * 40, models) == want


def test_held_out_phrasings():
    """A fifth of all phrasings kept from training: recall of each kind and precision of all."""
    texts, labels, seed = toxicity.training_set(8000)
    x = toxicity.measured([toxicity.folded(t) for t in texts])
    test = seed % 5 == 0
    p = np.stack([boosting.fit(x[~test], (labels[~test] == k + 1).astype(float), seed[~test] // 5).probability(x[test]) for k in range(3)], axis=1)
    got, want = np.where(p.max(1) >= toxicity.THRESHOLD, p.argmax(1) + 1, 0), labels[test]
    assert all((got[want == k] == k).mean() > 0.75 for k in (1, 2, 3))
    assert (got[want == 0] == 0).mean() > 0.9 and (want[got > 0] == got[got > 0]).mean() > 0.85


def test_unlike_wordings(models):
    """Whole documents around sentences whose wording no seed has; the README gives the figures."""
    found = lambda lines: sum(kind(BODY + t + "\n" + BODY, models) is not None for t in lines) / len(lines)
    assert found([*unlike_wordings.ABUSIVE, *unlike_wordings.HATEFUL, *unlike_wordings.SEXUAL]) >= 0.6
    assert found(unlike_wordings.HARMLESS) <= 0.2
    assert found([*unlike_wordings.MORE_ABUSIVE, *unlike_wordings.MORE_HATEFUL, *unlike_wordings.MORE_SEXUAL]) >= 0.7
    assert found(unlike_wordings.MORE_HARMLESS) <= 0.2


def test_every_sentence_reaches_the_trees(models):
    texts, labels, _ = toxicity.training_set(2000)
    for text in [t for t, k in zip(texts, labels) if k]:
        own = np.stack([m.probability(toxicity.measured([toxicity.folded(s) for s in toxicity.sentences_of(text)])) for m in models], axis=1).max(0)
        assert (toxicity.score_texts([BODY + text], models)[0] >= own - 1e-9).all(), text


def test_scores_do_not_depend_on_order(models):
    texts = ["the p0ll", "you d1ckhead", "you d3ckhead", "you are a sh1t", "you are a sh7t", "you b1tch", "you b7tch", "he is a c0ck", "he is a c9ck"]
    memo = {}
    alone = [toxicity.score_texts([t], models)[0] for t in texts]
    assert np.array_equal(np.array(alone), np.array([toxicity.score_texts([t], models, memo)[0] for t in reversed(texts)])[::-1])
    assert np.array_equal(np.array(alone), toxicity.score_texts(texts, models))
    assert alone[1].max() > max(toxicity.THRESHOLD, alone[0].max(), alone[2].max())


def test_the_kept_model_is_of_this_version():
    with open(toxicity.MODEL_FILE, encoding="utf-8") as f:
        assert json.load(f)["version"] == toxicity.version()
    x = np.random.default_rng(0).normal(size=(200, 3))
    m = boosting.fit(x, (x[:, 0] > 0).astype(float), np.arange(200), rounds=10)
    same = boosting.Boosted.from_plain(json.loads(json.dumps(m.to_plain())))
    assert np.allclose(same.probability(x), m.probability(x), atol=0.02)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=80))
def test_any_text_is_folded_and_measured(text):
    plain, low = toxicity.folded(text)
    assert len(plain) == len(low)
    got = toxicity.measured([toxicity.folded(s) for s in toxicity.sentences_of(text)])
    assert got.shape[1] == len(toxicity.FEATURES) and np.isfinite(got).all()


def test_words():
    assert toxicity.words_of("a d u m b a s s lol") == (["a", "dumbass", "lol"], 1)
    assert toxicity.words_of("they are s h i t h e a ds")[0] == ["they", "are", "shitheads"]
    assert toxicity.words_of("s.c.u.m_b_a_g!")[0] == ["scumbag"]
    assert toxicity.decoded("waaankeeer") == ("wanker", True) and toxicity.decoded("m*ron") == ("moron", True) and toxicity.decoded("xxx") == ("xxx", False)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.floats(-5, 5), st.integers(0, 1)), min_size=1, max_size=40))
def test_isotonic_never_falls(points):
    levels, values = boosting.isotonic(np.array([a for a, _ in points]), np.array([b for _, b in points], float))
    assert (np.diff(values) >= -1e-9).all() and ((values > 0) & (values < 1)).all()


def test_trees_learn():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 0) & (x[:, 2] < 0.5)).astype(float)
    m = boosting.fit(x, y, np.arange(600), rounds=30)
    assert ((m.probability(x) > 0.5) == y).mean() > 0.97


def test_scored(spark):
    rows = [(1, "s", "you are a stupid idiot"), (1, "s", "you are a stupid idiot"), (2, None, None), (3, "s", ""), (None, "s", "x"), (4, "s", "rye " * 200_000 + "\nyou are a stupid idiot")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "1 as kind", "2 as abusive", "3 as id")
    got = toxicity.with_kind(toxicity.scored(df, "doc_id", "text", ["source"])).collect()
    assert len(got) == 6 and sorted((r.doc_id or 0, r.kind or "") for r in got) == [(0, ""), (1, "abusive"), (1, "abusive"), (2, ""), (3, ""), (4, "abusive")]
    assert toxicity.scored(df.limit(0), "doc_id", "text").count() == 0
