"""The quality model against all pairs of all labelled rows."""

from __future__ import annotations

import random

import numpy as np

from tallyhouse.llm import quality


def labelled(good, bad, seed=4):
    rng = random.Random(seed)
    rows = []
    for n in range(good + bad):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(3, 25))]
        if rng.random() < (0.8 if n >= good else 0.1):
            words = [w.upper() if rng.random() < 0.4 else f"{w}{rng.randint(0, 99)}!" for w in words]
        rows.append((n, " ".join(words), int(n < good)))
    return rows


def old_threshold(strength, y):
    order = np.argsort(strength, kind="stable")
    place = int(np.searchsorted(np.arange(1, len(y) + 1) / len(y), np.mean(y == 0) + 1e-12))
    return (strength[order[max(0, place - 1)]] + strength[order[min(place, len(y) - 1)]]) / 2


def test_every_labelled_row_takes_part_in_all_pairs(spark):
    rows = labelled(4_700, 400)
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.fit(docs.select("doc_id", "text"), docs.select("doc_id", "quality"))
    x, y = np.array([quality.features(t) for _, t, _ in rows]), np.array([q for *_, q in rows])
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, x.std(axis=0) + 1e-3, atol=1e-7)
    z, strength = quality._expand((x - model.mean) / model.scale), model.strength(x)
    good, bad = y == 1, y == 0
    p = 1 / (1 + np.exp(strength[good][:, None] - strength[bad]))
    pull = (z[good].T @ p.sum(axis=1) - z[bad].T @ p.sum(axis=0)) / p.size - quality.RIDGE * model.weights
    assert np.abs(pull).max() < 1e-8  # the loss of all pairs is at its least
    assert np.isclose(model.threshold, old_threshold(strength, y))
    assert np.isclose(model.slope, 8 / (np.median(strength[good]) - np.median(strength[bad])))


def test_repeated_and_missing_rows(spark):
    rows = labelled(60, 40)
    docs = spark.createDataFrame([r[:2] for r in rows] + [(0, rows[0][1]), (900, None), (None, "a b c")], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, q) for i, _, q in rows] + [(rows[-1][0], 0), (900, 1), (901, 0), (None, 1), (3, None), (4, 7)], "doc_id long, quality int"
    )
    used = [(t, q) for _, t, q in rows] + [rows[0][1:], rows[-1][1:]]
    x, y = np.array([quality.features(t) for t, _ in used]), np.array([q for _, q in used])
    found = quality.fit(docs, labels)
    assert np.allclose(found.mean, x.mean(axis=0))
    strength, each = found.strength(x), np.where(y == 1, 61 / (y == 1).sum(), 42 / (y == 0).sum())
    order = np.argsort(strength, kind="stable")
    place = int(np.searchsorted(np.cumsum(each[order]) / each.sum(), 42 / 103 + 1e-12))
    assert np.isclose(found.threshold, (strength[order[place - 1]] + strength[order[place]]) / 2)


def test_ties_and_negative_strengths_are_found_by_rank(spark):
    x = np.zeros((9, len(quality.FEATURES)))
    x[:, 0] = [-3.5, -3.5, -1e-9, 0, 0, 0, 2, 7, 7]
    y = [0, 1, 0, 0, 1, 1, 0, 1, 1]
    rows = spark.createDataFrame([(a, b.tolist()) for a, b in zip(y, x, strict=True)], "label int, x array<double>").repartition(3)
    ranks = [quality._Rank((1, 1), n) for n in range(1, 10)] + [quality._Rank((0, 1), 3), quality._Rank((1, 1), 99)]
    quality._find(rows, lambda x: (x, x[:, 0]), ranks)
    assert [r.strength for r in ranks] == [*x[:, 0], 0, 7]
    assert ranks[4].below == (2, 1) and ranks[4].at == (1, 2)
