"""Co-training: held-out accuracy, agreement of runs, and edge rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowrelay.llm import cotraining

FOLDER = "/root/testdata/sf0.01"


def tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return docs, spark.read.parquet(f"{FOLDER}/labels.parquet").selectExpr("doc_id", "quality AS label")


def test_held_out_accuracy(spark):
    """Half of the labels train, the other half test."""
    docs, labels = tables(spark)
    train = labels.where("doc_id % 2 = 0")
    found = {r.doc_id: r for r in cotraining.classified(docs, train).collect()}
    assert len(found) == docs.count()
    truth = {r.doc_id: r.label for r in labels.where("doc_id % 2 = 1").collect()}
    good = [found[k].kept for k, v in truth.items() if v == 1]
    bad = [found[k].kept for k, v in truth.items() if v == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.2


def test_runs_agree(spark):
    docs, labels = tables(spark)
    one = {r.doc_id: r.score for r in cotraining.classified(docs, labels).collect()}
    two = {r.doc_id: r.score for r in cotraining.classified(docs.repartition(5), labels.repartition(3), labelled=8000).collect()}
    assert one.keys() == two.keys()
    assert max(abs(one[k] - two[k]) for k in one) < 1e-4


def test_edge_rows(spark):
    rng = random.Random(0)
    text = lambda words: " ".join(rng.choice(words) for _ in range(60))
    rows = [(i, text(["the", "house", "is", "green"]) if i % 2 else text(["x###", "b%%%", "|", "q***"]), "en", f"s{i % 3}", "l") for i in range(80)]
    rows += [(200, None, None, None, None), (201, "", "en", "s0", "l"), (202, " \n", "en", "s0", "l"), (None, text(["the", "house"]), "en", "s1", "l"), (203, "the house is green " * 30_000, "en", "s1", "l"), (1, rows[1][1], "en", "s1", "l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, label string")
    labels = [(i, i % 2) for i in range(40)] + [(5, 1), (None, 0), (7, None), (8, 9), (999, 1)]
    known = spark.createDataFrame(labels, "doc_id long, label int")
    found = cotraining.classified(docs, known).collect()
    assert len(found) == len(rows)
    wrong = [r for r in found if r.doc_id is not None and r.doc_id < 80 and r.kept != bool(r.doc_id % 2)]
    assert wrong == []
    assert cotraining.good(docs, known).columns == docs.columns
    assert cotraining.classified(docs.limit(0), known).count() == 0
    for few in (known.limit(0), known.where("label = 1")):
        none = cotraining.classified(docs, few).collect()
        assert len(none) == len(rows) and all(r.kept and r.score is None for r in none)


def test_logistic_and_calibration():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 3))
    p = cotraining.sigmoid(2 * x[:, 0] - x[:, 1])
    y = (rng.random(4000) < p).astype(int)
    fit = cotraining.Logistic.fit(x, y)
    assert np.corrcoef(fit.logit(x), 2 * x[:, 0] - x[:, 1])[0, 1] > 0.99
    slope, offset = cotraining.calibrated(4 * np.log(p / (1 - p)) + 2, y)
    assert (slope, offset) == (pytest.approx(0.25, abs=0.05), pytest.approx(-0.5, abs=0.1))


def slow_model(content, meta, label):
    """Co-training in one place over all rows, those with a label (else -1) in the order of their draws."""
    views, known = (content, meta), label >= 0
    held = known & (np.cumsum(known) % 4 == 0)
    model = None
    for _ in range(cotraining.ROUNDS + 1):
        goals = [np.where(held, -1, label) for _ in views]
        if model is not None:
            for taker, logits in zip((1, 0), model.logits(*views), strict=True):
                p = cotraining.sigmoid(logits).round(6)
                goals[taker][~known & (p >= cotraining.SURE)] = 1
                goals[taker][~known & (p <= 1 - cotraining.SURE)] = 0
        fits = [cotraining.Logistic.fit(x[g >= 0], g[g >= 0]) for x, g in zip(views, goals, strict=True)]
        curves = tuple(cotraining.calibrated(f.logit(x[held]), label[held]) for f, x in zip(fits, views, strict=True))
        model = cotraining.Model(*fits, curves, float(np.log(held.sum() + 1)))
        errors = np.array([np.abs(cotraining.sigmoid(x) - label[held]).mean() + 1e-6 for x in model.logits(content[held], meta[held])])
        model.shares = tuple((1 / errors / (1 / errors).sum()).tolist())
    return model, goals


def test_all_labels_and_all_sure_rows_are_fitted_on(spark, monkeypatch):
    """Against a fit in one place, with over 8,000 labels and over 2,000 rows that a view is sure of."""
    monkeypatch.setattr(cotraining, "TASK_ROWS", 2000, raising=False)
    rng = random.Random(3)
    words = [["the", "house", "is", "green", "tree", "and"], ["x###", "b%%%", "|", "q***", "the", "tree"]]
    rows, labels = [], []
    for i in range(13_400):
        good = int(rng.random() < 0.7)
        own = words[1 - good] if rng.random() > 0.03 else words[good]
        rows.append((i, " ".join(rng.choice(own) for _ in range(rng.randrange(8, 20))), rng.choice(["en", "de"]), f"s{2 * good + rng.randrange(3)}"))
        if i < 9300:
            labels.append((i, good if rng.random() > 0.02 else 1 - good))
    rows += rows[-40:]  # repeated rows teach once
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r for r in cotraining.classified(docs, spark.createDataFrame(labels, "doc_id long, label int")).collect()}
    staged = cotraining.features(docs.selectExpr("doc_id", "xxhash64(text) AS digest", "text", "lang", "source").dropDuplicates())
    staged = staged.orderBy(F.xxhash64("doc_id", "digest"), "doc_id", "digest").collect()
    of = dict(labels)
    content = np.stack([np.frombuffer(r.content, np.uint8) for r in staged]).astype(float)
    meta = np.stack([np.frombuffer(r.meta, "<f4") for r in staged]).astype(float)
    label = np.array([of.get(r.doc_id, -1) for r in staged])
    model, goals = slow_model(content, meta, label)
    assert (label >= 0).sum() == 9300 and max((g[label < 0] == 1).sum() for g in goals) > 2000
    scores = model.score(content, meta)
    assert max(abs(found[r.doc_id].score - x) for r, x in zip(staged, scores, strict=True)) < 1e-5
