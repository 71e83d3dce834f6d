import random
import zlib

import numpy as np
import pytest

from docsink.llm.toxicity import _risk, _Rows, calibrated, drop_toxic, fit, toxicity_scores, train
from tests.llm.conftest import prose

INSULTS = ["dreadful", "rotten", "vile"]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(0)
    rows, labels = [], []
    for i in range(900):
        words = prose(i, 40).split()
        toxic = i % 7 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture
def labelled(spark):
    return lambda labels: spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0


def test_finds_held_out_toxic_documents(documents, labelled, corpus):
    rows, labels = corpus
    docs = documents([*rows, (None, "no id"), (5000, None), (5001, ""), (5001, "vile vile rotten dreadful")], score="x", held_out="y")
    model = train(docs, labelled([*labels, (0, 1, None), (None, 1, 1), (14, 1, 0)]))
    assert model.weights
    got = toxicity_scores(docs, model).collect()
    assert len(got) == len(rows) + 4
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    apart = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 900]
    toxic = [r for r in apart if r.doc_id % 7 == 0]
    assert np.mean([r.predicted for r in toxic]) > 0.85
    assert np.mean([r.predicted for r in apart if r.doc_id % 7]) < 0.02
    stays = drop_toxic(docs, model)
    assert stays.columns == docs.columns
    assert stays.count() == sum(r.predicted == 0 for r in got)


def test_held_out_labels_are_never_read(documents, labelled, corpus):
    rows, labels = corpus
    docs = documents(rows)
    turned = [(i, q, 1 - t if held_out(i) else t) for i, q, t in labels]
    one, two = train(docs, labelled(labels)), train(docs, labelled(turned))
    assert one == two


def plain_risk(theta, positive, unlabelled, prior):
    """The non-negative risk, written out row by row."""

    def value(row):
        return theta[-1] + sum(theta[i] for i in row) * 8.0 / max(len(row), 1) ** 0.5

    def loss(x):
        return np.log1p(np.exp(-x))

    at_p, at_u = [value(r) for r in positive], [value(r) for r in unlabelled]
    negatives = np.mean([loss(-x) for x in at_u]) - prior * np.mean([loss(-x) for x in at_p])
    return prior * np.mean([loss(x) for x in at_p]) + max(0.0, negatives)


def small_problem():
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 12, 5)) for _ in range(80)]
    # Rows with feature 0 are toxic, but only half of them are known.
    toxic = [r for r in rows if 0 in r]
    return toxic[::2], rows, len(toxic) / len(rows)


def test_risk_equals_a_plain_one():
    positive, rows, prior = small_problem()
    theta = np.random.default_rng(1).normal(size=13) / 10
    for factor in (1, 5, -5):
        at_p, at_u = (_Rows(r).dot(factor * theta[:-1]) + factor * theta[-1] for r in (positive, rows))
        assert np.isclose(_risk(at_p, at_u, prior), plain_risk(factor * theta, positive, rows, prior))


def test_fit_reaches_a_lower_risk_than_plain_descent():
    """Descent on the plain risk by differences, as long as the correction stays out of the way."""
    positive, rows, prior = small_problem()
    theta = np.zeros(13)
    for _ in range(300):
        here = plain_risk(theta, positive, rows, prior)
        steps = np.eye(13) * 1e-5
        theta -= 0.1 * np.array([(plain_risk(theta + e, positive, rows, prior) - here) / 1e-5 for e in steps])
    weights, constant = fit(positive, rows, prior, 12, 0.0)
    assert plain_risk(np.append(weights, constant), positive, rows, prior) <= plain_risk(theta, positive, rows, prior) + 0.01
    assert weights.argmax() == 0


def test_risk_on_negatives_is_kept_from_falling_below_zero():
    """With few rows and many features the uncorrected risk falls far below zero; the corrected one does not."""
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 400, 30)) for _ in range(60)]
    positive, prior = rows[:10], 0.5

    def on_negatives(weights, constant):
        at_p, at_u = (_Rows(r).dot(weights) + constant for r in (positive, rows))
        return np.logaddexp(0, at_u).mean() - prior * np.logaddexp(0, at_p).mean()

    assert on_negatives(*fit(positive, rows, prior, 400, 0.0)) > -0.15

    theta = np.zeros(401)
    p, u = _Rows(positive), _Rows(rows)
    for _ in range(300):
        at_p, at_u = p.dot(theta[:-1]) + theta[-1], u.dot(theta[:-1]) + theta[-1]
        by_p = prior * (-1 / (1 + np.exp(at_p)) - 1 / (1 + np.exp(-at_p))) / p.n
        by_u = 1 / (1 + np.exp(-at_u)) / u.n
        theta -= 0.1 * np.append(p.transposed_dot(by_p, 400) + u.transposed_dot(by_u, 400), by_p.sum() + by_u.sum())
    assert on_negatives(theta[:-1], theta[-1]) < -0.5


def test_calibration_makes_probabilities():
    rng = np.random.default_rng(2)
    values = rng.normal(size=20_000)
    toxic = rng.random(20_000) < 1 / (1 + np.exp(-(3 * values - 1)))
    slope, shift = calibrated(values, toxic)
    assert abs(slope - 3) < 0.15 and abs(shift + 1) < 0.1
    assert calibrated(values, np.zeros(20_000, bool)) == (1.0, 0.0)


def test_forms_of_a_stem_in_another_language(documents, labelled):
    """Each toxic word occurs once, in the rarer language; only stems are known."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(1200):
        rare = i % 4 == 0
        words = [f"{'zo' if rare else ''}{w}" for w in prose(i, 40).split()]
        words = ["".join(c for c in w if c.isalpha()) + rng.choice("abcdefgh") for w in words]
        toxic = i % 5 == 0
        if toxic:
            stem = "grausl" if rare else "dreadf"
            for _ in range(3):
                words.insert(rng.randrange(40), stem + "".join(rng.choices("aeioumnr", k=5)))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    got = [r for r in toxicity_scores(documents(rows), train(documents(rows), labelled(labels))).collect() if r.held_out]
    for rare in (True, False):
        of = [r for r in got if (r.doc_id % 4 == 0) == rare]
        assert np.mean([r.predicted for r in of if r.doc_id % 5 == 0]) > 0.85
        assert np.mean([r.predicted for r in of if r.doc_id % 5]) < 0.05


def test_all_training_documents_count(documents, labelled, corpus):
    """Members of a few hundred rows are fitted as well, and averaged."""
    rows, labels = corpus
    docs = documents(rows)
    got = toxicity_scores(docs, train(docs, labelled(labels), member_rows=200)).collect()
    apart = [r for r in got if r.held_out]
    assert np.mean([r.predicted for r in apart if r.doc_id % 7 == 0]) > 0.8
    assert np.mean([r.predicted for r in apart if r.doc_id % 7]) < 0.02


def test_no_examples(documents, labelled):
    docs = documents([(1, "a"), (2, None)])
    scores = toxicity_scores(docs, train(docs, labelled([]))).collect()
    assert [r.predicted for r in scores] == [0, 0]
    empty = documents([])
    assert toxicity_scores(empty, train(empty, labelled([(1, 1, 1)]))).collect() == []
