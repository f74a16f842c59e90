import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import merkle


def digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    values = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return digest(*values)


def climb(nodes, place, fanout):
    """The top over `nodes` and the siblings of `place` up to it."""
    path = []
    while len(nodes) > 1:
        start = place - place % fanout
        path.append((place - start, nodes[start:place] + nodes[place + 1 : start + fanout]))
        nodes = [digest(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
        place //= fanout
    return nodes[0], path


def brute(rows, fanout=2):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of (doc_id, source, lang, n_chars, text) rows."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    for lang in order:
        groups[lang].sort(key=lambda row: (row[0] is not None, row[0] or 0, leaf(*row)))
    subroots = [climb([leaf(*row) for row in groups[lang]], 0, fanout)[0] for lang in order]
    out = []
    for rank, lang in enumerate(order):
        root, top = climb(subroots, rank, fanout)
        for place, row in enumerate(groups[lang]):
            _, below = climb([leaf(*r) for r in groups[lang]], place, fanout)
            doc_id, source, lang, n_chars, text = row
            tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None
            node = leaf(doc_id, source, lang, n_chars + 1 if tampered else n_chars, text)
            for digit, siblings in [*below, *top]:
                node = digest(*siblings[:digit], node, *siblings[digit:])
            proof = digest(*[s for _, siblings in [*below, *top] for s in siblings])
            out.append((doc_id, leaf(*row), subroots[rank], root, proof, node, node == root))
    return sorted(out, key=repr)


def documents(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for name in ("id", "key", "leaf", "grp", "place", "altered"):
        frame = frame.withColumn(name, F.lit("x"))
    return frame.withColumn("a.b", F.lit(1))


def found(docs, **options):
    one_more = {"n_chars": docs["n_chars"].cast("decimal(20,0)") + 1}
    tampered = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 0
    rows = merkle.manifest(merkle.leaf_rows(docs, altered=one_more, where=tampered), **options)
    columns = ("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r) for r in rows.select(*columns).collect()), key=repr)


def make(sizes, seed=1):
    chance = random.Random(seed)
    rows = []
    for lang, n in sizes.items():
        for _ in range(n):
            text = chance.choice([None, "", "é" * chance.randint(1, 9), "text", "long " * 3000])
            rows.append((chance.choice([None, 7, 7, *range(400)]), chance.choice([None, "s"]), lang, chance.choice([None, 5, 2**63 - 1]), text))
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    ("sizes", "fanout", "block"),
    [
        ({"en": 41, None: 17, "": 1, "é": 9, "z": 2}, 2, 4),
        ({"en": 30, "fr": 10, None: 28}, 3, 5),
        ({"b": 1}, 2, 1024),
        ({"b": 5}, 2, 2),
    ],
)
def test_equals_trees_built_whole(spark, sizes, fanout, block):
    rows = make(sizes)
    assert found(documents(spark, rows), fanout=fanout, block_leaves=block) == brute(rows, fanout)


def test_equal_rows_and_blocks_change_nothing(spark):
    rows = make({"en": 20, "fr": 4}) + [(7, "s", "en", 5, "text")] * 30
    docs = documents(spark, rows)
    whole = found(docs)
    assert whole == brute(rows) == found(docs.repartition(7), block_leaves=8)
    assert {r[-1] for r in whole} == {True, False}


def test_proofs_fold_to_the_root(spark):
    docs = documents(spark, make({"en": 13, "fr": 6, "de": 1}))
    rows = merkle.manifest(merkle.leaf_rows(docs), block_leaves=4, with_proofs=True).collect()
    for row in rows:
        height = merkle.height_of(sum(r.grp_key == row.grp_key for r in rows), 2)
        subroot = merkle.fold(row.leaf, row.place, row.proof[:height], 2)
        assert subroot == row.subroot
        assert merkle.fold(subroot, row["rank"], row.proof[height:], 2) == row.root
        assert digest(*[s for run in row.proof for s in run]) == row.proof_sha256
        assert row.verified
    assert sorted((r.grp_key, r.place) for r in rows) == [("2:de", 0), *[("2:en", i) for i in range(13)], *[("2:fr", i) for i in range(6)]]


def test_empty_table_and_fanout(spark):
    docs = documents(spark, [])
    assert found(docs) == []
    with pytest.raises(ValueError):
        merkle.manifest(merkle.leaf_rows(docs), fanout=1)


def test_heights():
    assert [merkle.height_of(n, 2) for n in (0, 1, 2, 3, 4, 5, 1025)] == [0, 0, 1, 2, 2, 3, 11]
    assert merkle._block_height(1024, 2) == 10 and merkle._block_height(1024, 3) == 6
