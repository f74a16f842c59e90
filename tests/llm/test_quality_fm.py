import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import quality_fm as fm
from ledgerloom.llm.text import lower_words, remainder


def test_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    size = (1 << 6) + len(fm.STATISTICS)
    model = fm.Model(6, 0.3, rng.normal(size=size), rng.normal(size=(size, 4)), np.zeros(16), np.ones(16))
    places, values = np.sort(rng.choice(size, 20, replace=False)), rng.normal(size=20)
    pairs = sum(
        model.factors[places[i]] @ model.factors[places[j]] * values[i] * values[j] for i in range(20) for j in range(i)
    )
    assert fm._sums(model, places, values) == pytest.approx(0.3 + model.linear[places] @ values + pairs)


def corpus(n=500):
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) + str(rng.randrange(30)) for _ in range(rng.randrange(5, 80))]
        good = rng.random() < 0.75
        docs.append((i, " ".join(words) + "." if good else " ".join(w.upper() + "!!" for w in words)))
        labels.append((i, int(good), 0))
    return docs, labels


def test_held_out_accuracy(spark, documents):
    docs, labels = corpus()
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = fm.train(documents(docs), marks, remainder(marks["doc_id"], 3) != 1)
    scored = fm.score(documents(docs), model).join(marks, "doc_id").filter(remainder(F.col("doc_id"), 3) == 1)
    assert scored.count() > 100
    assert scored.filter("predicted <> quality").count() <= 2
    assert scored.filter("score < 0 or score > 1 or predicted <> int(score >= 0.5)").count() == 0
    again = fm.train(documents(docs).repartition(5), marks, remainder(marks["doc_id"], 3) != 1)
    assert np.array_equal(model.factors, again.factors)


def test_training_is_bounded_and_labels_are_no_input(spark, documents):
    docs, labels = corpus(300)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = fm.train(documents(docs), marks, F.lit(True), fm.Training(documents=60, passes=2))
    buckets = fm.Buckets(model.bits)
    moved = documents([(i + 10_000, t, "elsewhere") for i, t in docs])
    assert sorted(r.score for r in fm.score(moved, model).collect()) == sorted(
        fm.score_text(model, t, len(t), buckets) for _, t in docs
    )


def test_edges(spark, documents):
    rows = [(1, None), (2, ""), (2, ""), (None, "word"), (3, "w " * 200_000)]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = fm.train(documents(rows), none, F.lit(True))
    assert [r.score for r in fm.score(documents(rows), model).collect()] == [0.5] * 5
    assert fm.score(documents([]), model).count() == 0
    stats = fm.statistics(None, None, lower_words(None))
    assert len(stats) == len(fm.STATISTICS) and np.isfinite(stats).all()
