"""The pipeline over a small folder of tables, stage by stage."""

import random

import pytest

import corpus_pipeline
from ledgerloom.llm import pieces, toxicity
from ledgerloom.llm.queries import QUERIES, model_path


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(3)
    path = str(tmp_path_factory.mktemp("tables"))
    words = [a + b for a in ("mar", "tel", "on", "ka") for b in ("din", "os", "ver", "li", "pu")]
    docs, labels = [], []
    for i in range(240):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(30, 90)))
        toxic = i % 6 == 0
        if toxic:
            text = "you idiot " + text + " such a moron and a loser"
        docs.append((i, text + " mail ann.7@example.org.", "en", f"s{i % 4}", len(text)))
        labels.append((i, 1, int(toxic)))
    docs += [(1000 + i, docs[i][1].upper(), "en", "s0", 1) for i in range(1, 40, 2)]
    docs += [(2000, "", "en", None, 0), (2001, None, None, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    frames = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        frames.append(docs)
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
    clean, single, hidden, mixed, tokens = frames
    ids = lambda frame: sorted(r.doc_id for r in frame.select("doc_id").collect())
    toxic = set(range(0, 240, 6))
    assert ids(clean) == sorted({*range(240), *range(1001, 1040, 2), 2000, 2001} - toxic - {1000 + i for i in toxic})
    # Copies in capitals go, and of the two documents without words one.
    assert ids(single) == sorted(set(range(240)) - toxic | {2000} | {1000 + i for i in toxic & set(range(1, 40, 2))})
    assert ids(hidden) == ids(single)
    assert hidden.filter("text like '%ann.7@%'").count() == 0
    taken = ids(mixed)
    assert set(taken) <= set(ids(single)) and max(map(taken.count, taken)) <= 3
    texts = {r.doc_id: r.text for r in mixed.collect()}
    encoder = pieces.Encoder(model_path())
    for r in tokens.collect():
        assert pieces.unpack(r.ids) == encoder.encode(texts[r.doc_id])[0].tolist()
        assert r.decoded == texts[r.doc_id]
    assert tokens.count() == mixed.count()


def test_run_gives_the_last_stage(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "ids", "begins", "ends", "decoded"]
    again = corpus_pipeline.run(spark, folder)
    assert sorted(r.decoded for r in got.collect()) == sorted(r.decoded for r in again.collect())


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "personal_data", "mixing", "tokens"]
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert toxicity.SEED_TERMS
