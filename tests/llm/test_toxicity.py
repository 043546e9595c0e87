"""Toxicity: evidence never falls, texts without evidence come last, copies count once."""

import random

import numpy as np
import pytest

from lexiflow.llm import toxicity

from .conftest import prose

BAD = "grub slime grub vermin slime"


@pytest.fixture(scope="module")
def model(spark):
    r = random.Random(11)
    rows = []
    for i in range(400):
        words = prose(i, r.choice([20, 60, 200, 600])).split(" ")
        if i % 5 == 0:
            at = r.randrange(len(words))
            words[at:at] = r.sample(BAD.split(), 3)
        rows.append((i, " ".join(words)))
    # a hundred copies of one toxic text: its ordinary words are not toxic forms
    rows += [(1000 + i, "calm harbour lantern meadow pebble grub slime willow copper " * 3 + "x") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0 or i >= 1000)) for i, _ in rows], "doc_id long, toxic int")
    return toxicity.fit(docs, labels)


def value(model, text):
    (n, segments), = toxicity._segments(model, [text], toxicity._Scores(model))
    return model.probability(model.evidence(n, segments))


def test_copies_are_fitted_on_once(model):
    assert "=grub" in model.forms and "=slime" in model.forms
    assert not {"=calm", "=harbour", "=lantern", "=meadow"} & model.forms.keys()


@pytest.mark.parametrize("n", [5, 50, 300, 3000])
def test_another_passage_never_lowers_the_score(model, n):
    text, before = prose(900 + n, n), -1.0
    for _ in range(6):
        now = value(model, text)
        assert now >= before
        before, text = now, text + " " + prose(1, 30) + " " + BAD
    assert before > 0.5


def test_no_evidence_is_least_at_any_length(model):
    clean = [value(model, t) for t in ("", "x", prose(5, 40), prose(6, 5000))]
    plain = [v for v, t in zip(clean, ("", "x", prose(5, 40), prose(6, 5000))) if not any(w in t for w in BAD.split())]
    assert len({round(v, 9) for v in plain[:2]}) == 1
    assert max(clean) < min(value(model, prose(6, n) + " " + BAD) for n in (1, 40, 5000))


def test_sum_statistic():
    """By hand: two segments of surplus 4 each against one of 4."""
    m = toxicity.ToxicModel(decay=1.0, size=0.01)
    one = m.evidence(105, [(0, 4, 4.0)])
    two = m.evidence(110, [(0, 4, 4.0), (50, 54, 4.0)])
    assert one == pytest.approx(4.0) and two == pytest.approx(8 - np.log(8) + np.log(2))
    assert m.evidence(10, []) == toxicity.NO_EVIDENCE < m.evidence(10**9, [(0, 0, 0.1)]) == toxicity.LEAST_EVIDENCE


def test_law_is_recovered():
    """lambda and K of samples drawn from the law itself."""
    r = np.random.default_rng(2)
    n = r.integers(50, 5000, 20_000).astype(float)
    s = np.maximum((np.log(0.02 * n) - np.log(-np.log(r.random(len(n))))) / 0.7, 0.0)
    decay, size = toxicity.extreme_value_law(n, s)
    assert decay == pytest.approx(0.7, abs=0.03) and size == pytest.approx(0.02, rel=0.2)
    assert toxicity.extreme_value_law(n[:3], np.zeros(3))[0] == 1.0


def test_ordinary_words_of_short_toxic_texts_are_no_forms(spark):
    """Toxic texts are short, clean ones long: a text's commonest words fill the same
    share of both, whatever their number in one text."""
    r, common, rows = random.Random(5), "calm harbour lantern meadow pebble willow copper river".split(), []
    for i in range(400):
        words = r.choices(common, k=60 if i % 4 == 0 else 900) + r.choices([f"w{i}" for i in range(3000)], k=20)
        rows.append((i, " ".join(words + (["vermin", "slime"] if i % 4 == 0 else []))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int"))
    assert not {"=" + w for w in common} & model.forms.keys() and model.forms["=slime"][0] > 2
    assert value(model, " ".join(common * 200)) == value(model, "") < value(model, " ".join(common * 200 + ["slime"]))


def test_law_is_not_set_by_one_text():
    """A clean text that repeats a scored word hundreds of times."""
    r = np.random.default_rng(3)
    n = r.integers(50, 5000, 2_000).astype(float)
    s = np.maximum((np.log(0.02 * n) - np.log(-np.log(r.random(len(n))))) / 0.7, 0.0)
    s[:4] = 4000.0
    assert toxicity.extreme_value_law(n, s)[0] == pytest.approx(0.7, abs=0.1)
