"""Probabilistic suffix tree over words: variable-length contexts, smoothed next-word distributions, text scores.

A state is a context, the last few words of a history; the empty context is the root, whose distribution is the
add-one word model. A context seen at least `least` times becomes a state when its own next-word distribution
diverges from that of its longest shorter state: the training occurrences, each predicted from all the others, must
gain at least `min_gain` nats over the shorter state. The distribution of a state is its counts smoothed with `m`
pseudo-counts of the shorter state's distribution; `m` is the one of `STRENGTHS` with the larger gain. A word is
scored in the longest state that ends its history.

The corpus is encoded once into blocks of some million words. Level by level, the blocks send their distinct n-grams
with their counts, by ranges of a 64-bit hash, and get the counts of the whole corpus back, then likewise the gains
of their contexts and the verdicts. With the counts come the numbers of the n-grams that can be contexts, in the order
of a range's keys; gains go out under these numbers, whose differences take a byte or less. So no task holds the rows of one context, and a context that a third of the
corpus shares is one row a block. Blocks and answers are bucketed tables, joined without moving. Everything
grows with the corpus: all words, and all contexts seen `least` times, are counted over all of its training texts.

Words are told apart by 64-bit hashes. Hashes of n-grams keep `guard_bits` more than the number of training tokens
has, at every size of the corpus: an n-gram shares its count with another one with a chance of about one in a million.

Defined results: a null or empty text is its end token alone. Rows are independent but for what they teach; repeated
rows teach repeatedly. Other columns are not read. Without training rows every token is unknown, and an empty table
gives an empty one.
"""

from __future__ import annotations

import math
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.text import in_slices, lower_words, with_text
from ledgerloom.storage import shuffles_end_with_writes

STRENGTHS = (1.0, 64.0)
END = b"\n"  # no word holds white space
HASH_SEED = 7
COUNT, GAIN = 0, 1


@dataclass(frozen=True)
class Tree:
    """Longest context, least occurrences of one, gain in nats for a state, and the remainder held out."""

    depth: int = 2
    least: int = 8
    min_gain: float = 3.0
    modulus: int = 7
    held_out: int = 2
    block_tokens: int = 1 << 21
    range_keys: int = 1 << 21
    guard_bits: int = 20


BLOCK = "block long, doc_ids array<bigint>, held binary, sizes binary, words binary, codes binary"
MESSAGE = "range int, kind int, level int, block long, keys binary, vals binary"
ANSWER = "block long, kind int, level int, range int, vals binary, numbers binary, total long, distinct long"
SCORES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("held_out", T.BooleanType(), False),
        T.StructField("n_tokens", T.LongType(), False),
        T.StructField("n_known", T.LongType(), False),
        T.StructField("base_log", T.DoubleType(), False),
        T.StructField("score", T.DoubleType(), False),
        T.StructField("in_context", T.LongType(), False),
    ]
)


class Codes(dict):
    """Words to numbers in order of appearance; the end token is 0."""

    def __init__(self):
        super().__init__({END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def pack(values: np.ndarray) -> bytes:
    """An array compressed by planes of its bytes."""
    planes = values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def unpack(data: bytes, kind, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(data, n * size, codec="zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """64-bit keys by their differences, which are small where the keys are in order."""
    return len(keys).to_bytes(8, "little") + pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data[8:], np.uint64, int.from_bytes(data[:8], "little")), dtype=np.uint64)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit hash of two, in this order."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + b
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_hash(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(word, HASH_SEED) for word in words), np.uint64, len(words))


def _blocks(docs: DataFrame, tree: Tree) -> DataFrame:
    """The encoded corpus: document ids, hold-out flags, tokens per document, word hashes in order, token codes."""

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        ids, held, sizes, parts, codes, tokens = [], [], [], [], Codes(), 0

        def block():
            hashes = word_hash(list(codes))
            appearance = np.concatenate(parts)
            # Frequent words get small codes, which compress; words of about one frequency stay in hash order.
            often = np.frexp(np.bincount(appearance, minlength=len(hashes)))[1]
            order = np.lexsort((hashes, -often))
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            placed = place[appearance]
            row = [
                pa.array([number], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([np.array(held, np.uint8).tobytes()], pa.binary()),
                pa.array([np.array(sizes, np.int64).tobytes()], pa.binary()),
                pa.array([pack_keys(hashes[order])], pa.binary()),
                pa.array([pack(placed)], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(row, ["block", "doc_ids", "held", "sizes", "words", "codes"])

        for batch in in_slices(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = lower_words(text)
                words.append(END)
                ids.append(doc)
                name = "" if doc is None else str(doc)
                held.append(zlib.crc32(name.encode()) % tree.modulus == tree.held_out)
                sizes.append(len(words))
                parts.append(np.fromiter(map(codes.__getitem__, words), np.int32, len(words)))
                tokens += len(words)
                if tokens >= tree.block_tokens:
                    yield block()
                    ids, held, sizes, parts, codes, tokens = [], [], [], [], Codes(), 0
                    number += 1
        if ids:
            yield block()

    return with_text(docs, "doc_id", "text").mapInArrow(run, BLOCK)


class Block:
    """One block with the answers it has got so far."""

    def __init__(self, row: dict, answers: dict[tuple[int, int], list], tree: Tree, totals: tuple[int, int]):
        self.tree, self.answers = tree, answers
        self.doc_ids = row["doc_ids"]
        self.held = np.frombuffer(row["held"], np.uint8).astype(bool)
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        stored = unpack_keys(row["words"])
        order = np.argsort(stored)
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        self.hashes = stored[order]
        self.codes = rank[unpack(row["codes"], np.int32, int(self.sizes.sum()))]
        self.train = np.repeat(~self.held, self.sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.totals = totals
        # Kind, level, the n-grams' hashes, what they are sent as, and the values.
        self.messages: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = []
        self.deepest = np.zeros(len(self.codes), np.int8)
        self.chance = None
        self.counts = self._answer(COUNT, 0, np.int64, len(self.hashes))
        if self.counts is None:
            own = np.bincount(self.codes[self.train], minlength=len(self.hashes))
            self.messages.append((COUNT, 0, self.hashes, self.hashes, own.astype(np.uint32)))
        else:
            self._walk()

    def _answer(self, kind: int, level: int, dtype, n: int) -> np.ndarray | None:
        """The corpus's values for the `n` keys this block asked about; None when they are not known yet."""
        if not n:
            return np.zeros(0, dtype)
        parts = self.answers.get((kind, level))
        if parts is None:
            return None
        parts = [unpack(data[8:], dtype, int.from_bytes(data[:8], "little")) for _, data, _ in sorted(parts)]
        return np.concatenate(parts)

    def _numbers(self, level: int, often: np.ndarray) -> np.ndarray:
        """For each n-gram of a level its number in its range; 0 for those not seen `often`, which have none."""
        numbers = np.zeros(len(often), np.uint64)
        if often.any():
            numbers[often] = np.concatenate([unpack_keys(data) for _, _, data in sorted(self.answers[COUNT, level])])
        return numbers

    def _walk(self) -> None:
        """From the root to the deepest level that has answers; messages ask for what comes next."""
        tree, total, kinds = self.tree, *self.totals
        kept = min(64, int(total).bit_length() + tree.guard_bits)
        mask = np.uint64((1 << 64) - (1 << 64 - kept))
        seen = self.counts[self.codes]
        chance = (seen + 1) / (total + kinds + 1)
        first = np.zeros(len(self.codes), bool)
        first[self.starts] = True
        token = self.hashes[self.codes]
        # A position's context: its place in a sorted list of keys, and how often it was seen (seven digits will do).
        keys, often = self.hashes, self.counts >= tree.least
        context, times = np.roll(self.codes, 1), np.roll(seen.astype(np.float32), 1)
        times[first] = 0
        del seen
        for level in range(1, tree.depth + 1):
            at = np.flatnonzero(times >= tree.least)
            grams, place = np.unique(mix(keys[context[at]], token[at]) & mask, return_inverse=True)
            place = place.astype(np.int32)
            train = self.train[at]
            counts = self._answer(COUNT, level, np.int64, len(grams))
            if counts is None:
                own = np.bincount(place[train], minlength=len(grams))
                self.messages.append((COUNT, level, grams, grams, own.astype(np.uint32)))
                break
            hits, seen_at, before = counts[place].astype(float), times[at].astype(float), chance[at]
            used = np.zeros(len(keys), bool)
            used[context[at]] = True
            rank = np.cumsum(used) - 1
            verdict = self._answer(GAIN, level, np.uint8, int(used.sum()))
            if verdict is None:
                sums = np.zeros((int(used.sum()), len(STRENGTHS)))
                for i, m in enumerate(STRENGTHS):
                    rest = (hits[train] - 1 + m * before[train]) / (seen_at[train] - 1 + m)
                    gain = np.log(rest / before[train])
                    sums[:, i] = np.bincount(rank[context[at][train]], gain, len(sums))
                numbers = self._numbers(level - 1, often)[used]
                gains = np.clip(sums, -6e4, 6e4).astype(np.float16).ravel()
                self.messages.append((GAIN, level, keys[used], numbers, gains))
                chance = None
            elif chance is not None:
                strength = np.array([0.0, *STRENGTHS])[verdict[rank[context[at]]]]
                state = strength > 0
                chance[at[state]] = (hits + strength * before)[state] / (seen_at + strength)[state]
                self.deepest[at[state]] = level
            if level == tree.depth:
                break
            # The n-gram that ends at a token is the context of the next one.
            ends = np.zeros(len(self.codes), np.int32)
            ends[at] = place
            times = np.zeros(len(self.codes), np.float32)
            times[at] = counts[place]
            del hits, seen_at, before
            context, times, keys, often = np.roll(ends, 1), np.roll(times, 1), grams, counts >= tree.least
            times[first] = 0
            if chance is None:
                chance = np.ones(len(self.codes))  # not used before the verdicts are known
        self.chance = chance

    def send(self, bits: int) -> list[tuple]:
        """The messages cut into ranges of the key."""
        rows = []
        for kind, level, keys, names, values in self.messages:
            width = len(values) // max(1, len(keys))
            owners = (keys >> np.uint64(64 - bits)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(owners, prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(keys)]):
                part = pack(values[a * width : b * width])
                rows.append((int(owners[a]), kind, level, pack_keys(names[a:b]), part))
        return rows

    def scores(self) -> list:
        """The columns of `SCORES`."""
        seen = self.counts[self.codes]
        sums = [
            np.add.reduceat(x, self.starts)
            for x in (
                (seen > 0).astype(np.int64),
                np.log10(seen + 1.0),
                np.log10(self.chance),
                (self.deepest > 0).astype(np.int64),
            )
        ]
        return [self.doc_ids, self.held, self.sizes, *sums]


def _reduce(tree: Tree):
    """Sums of equal keys over all blocks of a range, sent back to each block in the order of its keys."""

    def run(table: pa.Table) -> pa.Table:
        numbers = [pack_keys(np.zeros(0, np.uint64))] * table.num_rows
        order = np.argsort(table.column("block").to_numpy())
        blocks = [table.column("block")[int(i)].as_py() for i in order]
        place, kind, level = (table.column(c)[0].as_py() for c in ("range", "kind", "level"))
        keys = [unpack_keys(table.column("keys")[int(i)].as_py()) for i in order]
        packed = [table.column("vals")[int(i)].as_py() for i in order]
        sizes = [len(k) for k in keys]
        every, back = np.unique(np.concatenate(keys), return_inverse=True)
        if kind == COUNT:
            values = np.concatenate([unpack(p, np.uint32, n) for p, n in zip(packed, sizes)])
            sums = np.bincount(back, values, len(every)).astype(np.int64)
            total, distinct = int(sums.sum()), int((sums > 0).sum())
            answer, often = sums, sums >= tree.least
            if level < tree.depth:
                number = np.cumsum(often, dtype=np.uint64) - np.uint64(1)
                cuts = np.split(back, np.cumsum(sizes)[:-1])
                numbers = [pack_keys(number[k[often[k]]]) for k in cuts]
        else:
            width = len(STRENGTHS)
            parts = [unpack(p, np.float16, n * width).astype(float).reshape(n, width) for p, n in zip(packed, sizes)]
            gains = np.concatenate(parts)
            sums = np.stack([np.bincount(back, gains[:, i], len(every)) for i in range(width)], axis=1)
            best = sums.argmax(axis=1)
            answer = np.where(sums.max(axis=1) >= tree.min_gain, best + 1, 0).astype(np.uint8)
            total = distinct = 0
        mine = np.split(answer[back], np.cumsum(sizes)[:-1])
        n = len(blocks)
        columns = {
            "block": pa.array(blocks, pa.int64()),
            "kind": pa.array([kind] * n, pa.int32()),
            "level": pa.array([level] * n, pa.int32()),
            "range": pa.array([place] * n, pa.int32()),
            "vals": pa.array([len(a).to_bytes(8, "little") + pack(a) for a in mine], pa.binary()),
            "numbers": pa.array(numbers, pa.binary()),
            "total": pa.array([total] + [0] * (n - 1), pa.int64()),
            "distinct": pa.array([distinct] + [0] * (n - 1), pa.int64()),
        }
        return pa.table(columns)

    return run


def _gathered(table: pa.Table) -> dict[tuple[int, int], list[tuple[int, bytes, bytes]]]:
    found: dict[tuple[int, int], list[tuple[int, bytes, bytes]]] = {}
    names = ("kind", "level", "range", "vals", "numbers")
    for kind, level, place, data, numbers in zip(*(table.column(c).to_pylist() for c in names)):
        found.setdefault((kind, level), []).append((place, data, numbers))
    return found


def score_texts(docs: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """Scores of every document under the tree learned from those not held out, and under the word model alone."""
    spark = docs.sparkSession
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    n_buckets = max(8, math.ceil(chars / 2**24))
    bits = max(3, math.ceil(math.log2(max(1, chars / 6 / tree.range_keys))))
    name = f"suffix_tree_blocks_{uuid.uuid4().hex}"
    _blocks(docs, tree).write.bucketBy(n_buckets, "block").saveAsTable(name)
    blocks = spark.table(name)
    answers_name = f"suffix_tree_answers_{uuid.uuid4().hex}"
    answers = spark.createDataFrame([], ANSWER)
    totals = (0, 0)

    def ask(totals):
        names = ["range", "kind", "level", "keys", "vals"]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            out = {n: pa.array([], k) for n, k in zip(names, kinds)} | {"block": pa.array([], pa.int64())}
            if left.num_rows:
                row = left.slice(0, 1).to_pylist()[0]
                sent = Block(row, _gathered(right), tree, totals).send(bits)
                out = {n: pa.array(c, k) for n, c, k in zip(names, zip(*sent), kinds)} if sent else out
                out["block"] = pa.array([row["block"]] * len(sent), pa.int64())
            return pa.table({n: out[n] for n in ("range", "kind", "level", "block", "keys", "vals")})

        return run

    def tell(totals):
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows:
                return SCORES_ARROW.empty_table()
            columns = Block(left.slice(0, 1).to_pylist()[0], _gathered(right), tree, totals).scores()
            return pa.table([pa.array(c, k) for c, k in zip(columns, SCORES_ARROW.types)], schema=SCORES_ARROW)

        return run

    # Answers are bucketed like the blocks: each moves once, and no later pass moves it again. The messages of a turn
    # are not needed once its answers are stored.
    for turn in range(tree.depth + 2):
        sent = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(ask(totals), MESSAGE)
        reduced = sent.groupBy("range", "kind", "level").applyInArrow(_reduce(tree), ANSWER)
        with shuffles_end_with_writes(spark):
            laid = reduced.repartition(n_buckets, "block").write.mode("append")
            laid.bucketBy(n_buckets, "block").saveAsTable(answers_name)
        answers = spark.table(answers_name)
        if turn == 0:
            row = answers.agg(F.sum("total"), F.sum("distinct")).first()
            totals = (row[0] or 0, row[1] or 0)
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(tell(totals), SCORES)
    total, distinct = totals
    unit = math.log10(total + distinct + 1)
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_log") - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
        "score",
        "in_context",
    )


SCORES_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("base_log", pa.float64()),
        ("score", pa.float64()),
        ("in_context", pa.int64()),
    ]
)
