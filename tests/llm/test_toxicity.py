import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import toxicity as tx
from ledgerloom.llm.text import remainder


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute_match(token, terms):
    best = 9
    for term in terms:
        if term.endswith("*"):
            allowed = 1 if len(term) > 7 else 0
            least = min(edits(token[:k], term[:-1]) for k in range(len(token) + 1))
        else:
            allowed = 1 if len(term) >= 5 else 0
            least = edits(token, term)
        if least <= allowed:
            best = min(best, least)
    return {0: tx.EXACT, 1: tx.FUZZY}.get(best, 0)


TERMS = ("idiot", "scum", "clown", "wretch*", "lowe*", "abcdefg*", "cloud", "ab")


def test_automaton_equals_edit_distance():
    rng = random.Random(1)
    automaton = tx.Automaton(TERMS)
    tokens = {"", "idiot", "idiots", "idot", "1diot", "iidiot", "scum", "scums", "wretched", "wrtched", "lowerx", "ab", "a"}
    letters = "abcdefgilostuwrchn1é"
    for term in TERMS:
        for _ in range(150):
            chars = list(term.rstrip("*") + rng.choice(["", "x", "ing"]))
            for _ in range(rng.randrange(3)):
                place = rng.randrange(len(chars) + 1)
                kind = rng.randrange(3)
                if kind == 0:
                    chars.insert(place, rng.choice(letters))
                elif chars and place < len(chars):
                    chars[place : place + 1] = [] if kind == 1 else [rng.choice(letters)]
            tokens.add("".join(chars))
    assert {t: automaton.match(t) for t in tokens} == {t: brute_match(t, TERMS) for t in tokens}


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("he is an idiot", (1, 0, 0, 0)),
        ("you are an IDIOT!", (1, 1, 0, 0)),
        ('the word "idiot" is rude', (0, 0, 0, 1)),
        ("she called him an idiot", (0, 0, 0, 1)),
        ("such an id1ot, truly", (1, 0, 1, 0)),
        ("nothing here", (0, 0, 0, 0)),
        ("", (0, 0, 0, 0)),
        (None, (0, 0, 0, 0)),
    ],
)
def test_context(text, found):
    got = tx.counts(text, tx.Matches(tx.Automaton(("idiot",))))
    assert got[:4] == found
    assert got[4] == len((text or "").split())


def corpus(n=600):
    rng = random.Random(7)
    words = [f"{a}{b}{c}" for a in ("ba", "de", "ki") for b in ("lo", "mu", "nap", "ro") for c in ("st", "n", "ve", "gar")]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(20, 60))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["grobian", "knave", "rascal", "vilexa", "vilexo", "vilexu"]))
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_learns_terms_and_openings_and_scores_held_out_rows(spark, documents):
    docs, labels = corpus()
    frame = documents(docs)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = tx.train(frame, marks, remainder(marks["doc_id"], 5) != 0, seeds=())
    assert {"grobian", "knave", "rascal"} <= set(model.terms)
    assert any(t.startswith("vile") and t.endswith("*") for t in model.terms)
    scored = tx.score(frame, model).join(marks, "doc_id").filter(remainder(F.col("doc_id"), 5) == 0)
    assert scored.count() > 60
    assert scored.filter("predicted <> toxic").count() == 0
    kept = tx.reject_toxic(frame, model)
    assert kept.columns == frame.columns
    bad = {r.doc_id for r in tx.score(frame, model).filter("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - bad


def test_misspellings_are_caught_and_look_alikes_are_not(spark, documents):
    docs, labels = corpus()
    docs = [(i, t + (" grobiam and grobiam" if i % 5 else "")) for i, t in docs]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = tx.train(documents(docs), marks, remainder(marks["doc_id"], 5) != 0, seeds=())
    assert "grobiam" in model.words
    asked = [(1, docs[1][1]), (2, docs[1][1] + " what a gr0bian and knavee he is"), (3, "grobiam " + docs[2][1])]
    got = {r.doc_id: r.predicted for r in tx.score(documents(asked), model).collect()}
    assert got == {1: 0, 2: 1, 3: 0}


def test_edges(spark, documents):
    rows = [(1, None), (2, ""), (3, "idiot " * 50_000), (3, "idiot"), (3, "idiot"), (None, "fine")]
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = tx.train(documents(rows), marks, remainder(marks["doc_id"], 5) != 0)
    assert model.weights == tx.DEFAULT_WEIGHTS
    got = sorted((r.doc_id is None, r.doc_id or 0, r.predicted) for r in tx.score(documents(rows), model).collect())
    assert got == [(False, 1, 0), (False, 2, 0), (False, 3, 1), (False, 3, 1), (False, 3, 1), (True, 0, 0)]
    assert tx.score(documents([]), model).count() == 0
    assert tx.reject_toxic(documents(rows), model).count() == 3


def test_scores_in_sql_and_python_agree(spark, documents):
    docs, _ = corpus(60)
    model = tx.Model(("grobian", "knave", "vilex*"), (1.0, 0.5, 0.3, 0.7, -0.4, 0.2, -2.0))
    matches = tx.Matches(tx.Automaton(model.terms))
    rows = np.array([tx.counts(t, matches) for _, t in docs], float)
    expected = 1 / (1 + np.exp(-(tx.features(rows) @ np.array(model.weights))))
    got = [r.score for r in tx.score(documents(docs), model).orderBy("doc_id").collect()]
    assert got == pytest.approx(expected.tolist(), rel=1e-12)


def test_the_sample_is_bounded_in_rows(spark, documents):
    docs = documents([(1, f"text {i} hello") for i in range(2000)] + [(i, f"other {i}") for i in range(2, 40)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)] + [(1, 1)], "doc_id long, toxic int")
    usable = labels["doc_id"] > 0
    one = tx.labelled_sample(docs, labels, usable, 60, "toxic").collect()
    assert len(one) == 39 and sorted(r.doc_id for r in one) == list(range(1, 40))
    again = tx.labelled_sample(docs.repartition(5), labels, usable, 60, "toxic").collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, again))
