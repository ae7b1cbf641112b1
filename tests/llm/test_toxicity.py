"""Toxicity: the label model, the classifier, and held-out rows of made-up texts."""

import random

import numpy as np

from loomspan.llm import toxicity

DOCS = "doc_id long, text string, score double, terms string"


def made(n=600, seed=2):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randrange(5, 80))]
        bad = rng.random() < 0.2
        if bad:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), "zorqu" + rng.choice(["a", "en", "ity", "x"]) if rng.random() < 0.5 else "Grum")
        docs.append((i, " ".join(w), 1.0, "x"))
        labels.append((i, int(bad)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = made()
    model = toxicity.fit(spark.createDataFrame(docs[:450], DOCS).select("doc_id", "text"), spark.createDataFrame(labels[:450] + [(None, 1), (3, None)], "doc_id long, toxic int"))
    assert model.agreement > 0.97
    truth = dict(labels)
    rows = toxicity.score(spark.createDataFrame(docs[450:] + [(900, None, None, None), (901, "", None, None)], DOCS), model).collect()
    assert all(0 <= r["score"] <= 1 for r in rows) and len(rows) == 152
    assert all((r["score"] >= toxicity.CUT) == truth[r["_row"]["doc_id"]] for r in rows if r["_row"]["doc_id"] < 900)
    assert all(r["score"] < toxicity.CUT for r in rows if r["_row"]["doc_id"] >= 900)


def test_without_labels_the_seeds_score(spark):
    docs = spark.createDataFrame([(1, "you idiot, you moron"), (2, "a calm text")], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    got = {r["_row"]["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert got[1] > 0.5 > got[2]
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_label_model_learns_accuracies_and_correlations():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    good = (rng.random(4000) < np.where(y, 0.8, 0.02)).astype(np.float32)
    twin = np.where(rng.random(4000) < 0.98, good, 1 - good).astype(np.float32)
    weak = (rng.random(4000) < np.where(y, 0.3, 0.2)).astype(np.float32)
    few = rng.random(4000) < 0.05
    votes = np.stack([good, twin, weak, 1 - np.maximum(good, twin)], 1)
    rate = lambda mine: votes[few & mine].mean(axis=0) * 0.98 + 0.01
    model = toxicity.LabelModel()
    posterior = model.fit(votes, rate(y), rate(~y), 0.25)
    assert ((posterior > 0.5) == y).mean() > 0.9 and abs(model.prior - 0.3) < 0.1
    assert model.on[0] > 0.7 and model.off[0] < 0.1
    assert max(c[0, 1] for c in model.correlation) > 0.5 and all(abs(c[0, 2]) < 0.3 for c in model.correlation)
    both, alone = good.astype(bool) & twin.astype(bool), good.astype(bool) & ~twin.astype(bool)
    assert (model.weight[both][:, 0] < 0.7).all() and (model.weight[alone][:, 0] > 0.7).all() and (model.weight[:, 2] > 0.7).all()


def test_nested_terms():
    assert toxicity.unlike(["^lowei", "loweient", "^lowe", "trash", "^tras", "!marks"]) == ["^lowei", "trash", "!marks"]
