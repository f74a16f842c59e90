"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document is a sparse vector: its words hashed into buckets with damped counts, scaled to length one, and a few
statistics of its lines, letters and marks with the recorded number of characters. The machine scores
w0 + Σ w·x + Σ_{i<j} ⟨v_i, v_j⟩ x_i x_j; the pairwise part is half of Σ_f (Σ v_f x)² − Σ_f Σ (v_f x)², so a document
costs time linear in its words.

It is fitted by AdaGrad in fixed order on at most `Training.documents` labelled rows, taken by the hash of their id;
the statistics are standardised with the sample's means. The model is a few megabytes whatever the corpus, and goes
to the tasks with the code. Scoring covers every document and all of its text.

Defined results: a null or empty text has no words and scores by the constant of its statistics; a null number of
characters counts as unknown. Rows are independent: repeated rows, ties and other columns change nothing, an empty
table gives an empty one; without labels of both kinds every score is the share of label 1, one half without any.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.text import in_slices, lower_words, one_row_each, with_text
from ledgerloom.storage import materialize

STATISTICS = (
    "log_words",
    "log_lines",
    "word_length",
    "upper",
    "digits",
    "marks_per_word",
    "symbols_per_word",
    "bars_per_word",
    "shouts_per_word",
    "distinct_words",
    "distinct_lines",
    "ended_lines",
    "top_word",
    "next_equal",
    "log_recorded_chars",
    "unknown_chars",
)
CACHE = 400_000
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SYMBOLS = b"#*$%&|<>"
UPPER, DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
ENDS = (b".", b"!", b"?", b":", b";", b'"')


@dataclass(frozen=True)
class Training:
    """Bounds and settings of the fit."""

    documents: int = 8_000
    bits: int = 14
    factors: int = 6
    passes: int = 6
    batch: int = 64
    rate: float = 0.08
    ridge: float = 1e-5
    seed: int = 11


@dataclass(frozen=True)
class Model:
    bits: int
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    means: np.ndarray
    scales: np.ndarray


class Buckets(dict):
    """Words to hash buckets; forgets all when it grows too large."""

    def __init__(self, bits: int):
        super().__init__()
        self.mask = (1 << bits) - 1

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = bucket = zlib.crc32(word) & self.mask
        return bucket


def statistics(text: str | None, recorded: int | None, words: list[bytes]) -> list[float]:
    """`STATISTICS` of one text."""
    data = (text or "").encode()
    lines = [line for line in data.split(b"\n") if line.strip()]
    n, size = max(1, len(words)), max(1, len(data))
    tally: dict[bytes, int] = {}
    for word in words:
        tally[word] = tally.get(word, 0) + 1

    def share(chars: bytes) -> int:
        return len(data) - len(data.translate(None, chars))

    return [
        np.log1p(len(words)),
        np.log1p(len(lines)),
        min(40.0, sum(map(len, words)) / n),
        share(UPPER) / size,
        share(DIGITS) / size,
        min(5.0, share(MARKS) / n),
        min(5.0, share(SYMBOLS) / n),
        min(5.0, data.count(b"|") / n),
        min(5.0, data.count(b"!") / n),
        len(tally) / n,
        len(set(lines)) / max(1, len(lines)),
        sum(line.rstrip().endswith(ENDS) for line in lines) / max(1, len(lines)),
        max(tally.values(), default=0) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        np.log1p(max(0, recorded or 0)),
        float(recorded is None),
    ]


def word_vector(words: list[bytes], buckets: Buckets) -> tuple[np.ndarray, np.ndarray]:
    """Buckets in order and damped counts of length one."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    places = np.fromiter(map(buckets.__getitem__, words), np.int64, len(words))
    found, times = np.unique(places, return_counts=True)
    values = np.log1p(times)
    return found, values / np.sqrt((values**2).sum())


def _sums(model: Model, places: np.ndarray, values: np.ndarray) -> float:
    """The score before the logistic, by the sum-of-squares identity."""
    factors = model.factors[places] * values[:, None]
    pairs = (factors.sum(axis=0) ** 2 - (factors**2).sum(axis=0)).sum() / 2
    return model.bias + float(model.linear[places] @ values) + float(pairs)


def _joined(model: Model, words: tuple[np.ndarray, np.ndarray], stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One sparse vector of words and standardised statistics."""
    places = np.concatenate([words[0], (1 << model.bits) + np.arange(len(STATISTICS))])
    shown = np.clip((stats - model.means) / model.scales, -6, 6) / np.sqrt(len(STATISTICS))
    return places, np.concatenate([words[1], shown])


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], training: Training) -> Model:
    """Fit rows of (buckets, values, statistics, label), in the order given."""
    random = np.random.default_rng(training.seed)
    size = (1 << training.bits) + len(STATISTICS)
    share = (sum(r[3] for r in rows) + 1) / (len(rows) + 2)
    stats = np.array([r[2] for r in rows]).reshape(len(rows), len(STATISTICS))
    means = stats.mean(axis=0) if len(rows) else np.zeros(len(STATISTICS))
    scales = np.maximum(stats.std(axis=0), 1e-3) if len(rows) else np.ones(len(STATISTICS))
    model = Model(
        training.bits,
        float(np.log(share / (1 - share))),
        np.zeros(size),
        random.normal(0, 0.05, (size, training.factors)),
        means,
        scales,
    )
    if len({r[3] for r in rows}) < 2:
        return Model(training.bits, model.bias, model.linear, np.zeros_like(model.factors), means, scales)
    bias, bias_g = model.bias, 1e-6
    linear, linear_g = model.linear, np.full(size, 1e-6)
    factors, factors_g = model.factors, np.full((size, training.factors), 1e-6)
    vectors = [_joined(model, (r[0], r[1]), r[2]) for r in rows]
    labels = np.array([r[3] for r in rows], float)
    for _ in range(training.passes):
        order = random.permutation(len(rows))
        for start in range(0, len(rows), training.batch):
            some = order[start : start + training.batch]
            places = np.concatenate([vectors[i][0] for i in some])
            values = np.concatenate([vectors[i][1] for i in some])
            sizes = np.array([len(vectors[i][0]) for i in some])
            cuts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            scaled = factors[places] * values[:, None]
            sums = np.add.reduceat(scaled, cuts, axis=0)
            squares = np.add.reduceat((scaled**2).sum(axis=1), cuts)
            z = bias + np.add.reduceat(linear[places] * values, cuts) + ((sums**2).sum(axis=1) - squares) / 2
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[some]) / len(some)
            each = np.repeat(error, sizes)
            touched, back = np.unique(places, return_inverse=True)
            g = np.bincount(back, each * values, len(touched)) + training.ridge * linear[touched]
            linear_g[touched] += g**2
            linear[touched] -= training.rate * g / np.sqrt(linear_g[touched])
            slope = (each * values)[:, None] * (np.repeat(sums, sizes, axis=0) - scaled)
            gf = np.stack([np.bincount(back, slope[:, f], len(touched)) for f in range(training.factors)], axis=1)
            gf += training.ridge * factors[touched]
            factors_g[touched] += gf**2
            factors[touched] -= training.rate * gf / np.sqrt(factors_g[touched])
            bias_g += error.sum() ** 2
            bias -= training.rate * error.sum() / np.sqrt(bias_g)
    return Model(training.bits, float(bias), linear, factors, means, scales)


def train(docs: DataFrame, labels: DataFrame, usable: Column, training: Training = Training()) -> Model:
    """Fit the labelled rows for which `usable` (a condition on `labels`) holds."""
    ids = labels.filter(usable & labels["quality"].isNotNull())
    ids = ids.select("doc_id", F.col("quality").cast("int").alias("label")).distinct()
    total = ids.count()
    if total > training.documents:
        ids = ids.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(1_000_003 * training.documents / total))
    # One row an id and label: an id on any number of rows must not fill the sample.
    sample = one_row_each(with_text(docs, "doc_id", "text", "n_chars").join(F.broadcast(ids), "doc_id"), "doc_id", "label")

    def vectors(batches):
        buckets = Buckets(training.bits)
        for batch in in_slices(batches):
            found = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "label", "text", "n_chars"))
            for doc, label, text, recorded in zip(*columns):
                words = lower_words(text)
                places, values = word_vector(words, buckets)
                stats = np.array(statistics(text, recorded, words))
                found.append((doc, label, *(a.tobytes() for a in (places.astype("<i4"), values, stats))))
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            names = ["doc_id", "label", "places", "vals", "stats"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)

    schema = "doc_id long, label int, places binary, vals binary, stats binary"
    stored = materialize(sample.mapInArrow(vectors, schema), "vectors")
    rows = [
        (np.frombuffer(r[2], "<i4").astype(np.int64), np.frombuffer(r[3]), np.frombuffer(r[4]), r[1])
        for r in sorted(stored.collect(), key=lambda r: (r[0], r[1], bytes(r[2])))
    ]
    return fit(rows, training)


def score_text(model: Model, text: str | None, recorded: int | None, buckets: Buckets) -> float:
    words = lower_words(text)
    vector = word_vector(words, buckets)
    z = _sums(model, *_joined(model, vector, np.array(statistics(text, recorded, words))))
    return float(1 / (1 + np.exp(-np.clip(z, -700, 700))))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id`, `score` and `predicted` of every document."""

    def run(batches):
        buckets = Buckets(model.bits)
        for batch in in_slices(batches):
            columns = zip(batch.column("text").to_pylist(), batch.column("n_chars").to_pylist())
            found = [score_text(model, text, recorded, buckets) for text, recorded in columns]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    narrow = with_text(docs, "doc_id", "text", "n_chars")
    scored = narrow.mapInArrow(run, T.StructType([narrow.schema["doc_id"], T.StructField("score", T.DoubleType())]))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
