"""Toxicity from a lexicon whose misspellings are found by a Levenshtein automaton run on the lexicon's trie.

The automaton reads a token and holds every pair of a trie node and a number of edits that the token's start can
have; its states are built when first met and then reused, so a token costs one step per character. Terms are whole
words or openings (`term*`, any continuation). Terms of five letters or more allow one edit, openings of seven.

Each hit is weighed by its context: inside quotation marks, or after a word that reports speech, it is a quotation;
elsewhere it is abuse, directed abuse when the second person stands near. Hits become a few counts, and a logistic
model fitted on labelled documents turns the counts into a score.

Labels are learned from at most `Training.documents` labelled rows, taken by the hash of their id. The lexicon is
the seed terms plus terms and openings whose documents are nearly all toxic, chosen greedily: a document that holds
chosen terms already counts half as much for each of them, so words that merely sit in copies of one document are
not taken for terms. Tokens one edit away from a term that clean labelled documents use are words of their own and
no misspellings. Scoring covers every document and all of its text.

Defined results: a null or empty text has no hits and scores as such. Rows are independent: repeated rows, ties and
other columns change nothing; empty tables give empty ones, and without usable labels the default weights hold.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.text import in_slices, one_row_each, with_text
from ledgerloom.storage import materialize

SEED_TERMS = (
    "idiot",
    "moron",
    "stupid",
    "scum",
    "trash",
    "loser",
    "clown",
    "pathetic",
    "worthless",
    "disgusting",
)
REPORTING = frozenset(
    "said says say saying called calls wrote writes word words term terms quote quoted quotes reported alleged "
    "sagte nannte schrieb wort zitat dit disait mot citation dijo llamó palabra cita".split()
)
SECOND_PERSON = frozenset("you your you're youre u ur du dich dir dein deine tu toi vous votre ton tú tu usted".split())
OPENING_QUOTES, CLOSING_QUOTES = "\"'“‘«„‹", "\"'”’»“›"
EDGES = ".,;:!?()[]{}<>*#$%&|/\\-_~`^+=\"'“”‘’«»„‹›…"

WINDOW = 4
# Labelled rows a file of the stored sample.
SAMPLE_ROWS = 500
SHORTEST_OPENING, LONGEST_OPENING = 4, 7
CACHE = 400_000

EXACT, FUZZY = 1, 2


@dataclass(frozen=True)
class Training:
    """Bounds and limits of learning."""

    documents: int = 12_000
    least_documents: int = 3
    precision: float = 0.9
    least_gain: float = 4.0
    terms: int = 400
    candidates: int = 6_000
    words: int = 2_000
    rounds: int = 40
    ridge: float = 1e-2


@dataclass(frozen=True)
class Model:
    """Terms (openings end in `*`), the weights of `FEATURES`, bias last, and words that only look like terms."""

    terms: tuple[str, ...]
    weights: tuple[float, ...]
    words: frozenset[str] = frozenset()


FEATURES = ("any_abuse", "abuse", "directed", "fuzzy", "quoted", "share", "bias")
DEFAULT_WEIGHTS = (2.0, 1.0, 0.5, 0.0, -0.2, 1.5, -4.0)


class Automaton:
    """Levenshtein automaton over the trie of a lexicon, made deterministic step by step."""

    def __init__(self, terms: Iterable[str]):
        self.children: list[dict[str, int]] = [{}]
        self.allowed: list[int] = [-1]  # edits with which a term may end at the node
        self.opening: list[int] = [-1]  # the same for openings
        for term in terms:
            node = 0
            for char in term.rstrip("*"):
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    self.allowed.append(-1)
                    self.opening.append(-1)
                node = self.children[node][char]
            if term.endswith("*"):
                self.opening[node] = 1 if len(term) > 7 else 0
            else:
                self.allowed[node] = 1 if len(term) >= 5 else 0
        self.letters = {char for node in self.children for char in node}
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.value: list[int] = []
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        """The number of the state that holds `pairs` and all that follow by leaving out a letter of the term."""
        closed = set(pairs)
        closed |= {(child, 1) for node, edits in pairs if not edits and node >= 0 for child in self.children[node].values()}
        closed |= {(-1, e) for node, e in closed if node >= 0 and e <= self.opening[node]}
        least = min((e for node, e in closed if node == -1), default=2)
        exact = {node for node, e in closed if e == 0}
        kept = frozenset((n, e) for n, e in closed if e == 0 or (n not in exact and n >= 0) or (n == -1 and least == 1))
        if kept not in self.states:
            self.states[kept] = len(self.sets)
            self.sets.append(kept)
            self.steps.append({})
            ends = [e for n, e in kept if n == -1 or e <= self.allowed[n]]
            self.value.append(0 if not ends else EXACT if min(ends) == 0 else FUZZY)
        return self.states[kept]

    def _step(self, state: int, char: str) -> int:
        pairs: set[tuple[int, int]] = set()
        for node, edits in self.sets[state]:
            if node == -1:
                pairs.add((-1, edits))
                continue
            children = self.children[node]
            if char in children:
                pairs.add((children[char], edits))
            if not edits:
                pairs.add((node, 1))
                pairs.update((child, 1) for child in children.values())
        found = self._state(pairs)
        self.steps[state][char] = found
        return found

    def match(self, token: str) -> int:
        """`EXACT`, `FUZZY` or 0."""
        state = self.start
        for char in token:
            if char not in self.letters:
                char = ""
            following = self.steps[state].get(char)
            state = self._step(state, char) if following is None else following
            if not self.sets[state]:
                return 0
        return self.value[state]


class Matches(dict):
    """Raw lower-case tokens to the match of what is left without edge marks; forgets all when it grows too large."""

    def __init__(self, automaton: Automaton, words: frozenset[str] = frozenset()):
        super().__init__()
        self.automaton, self.words = automaton, words

    def __missing__(self, token: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        bare = token.strip(EDGES)
        found = self.automaton.match(bare)
        self[token] = found = 0 if found == FUZZY and bare in self.words else found
        return found


def context(tokens: list[str], place: int) -> str:
    """`quoted`, `directed` or `abuse` for a hit at `place`, from the tokens around it."""
    token = tokens[place]
    near = tokens[max(0, place - WINDOW) : place + WINDOW + 1]
    before, after = tokens[max(0, place - WINDOW) : place + 1], tokens[place : place + WINDOW + 1]
    opened = any(t[0] in OPENING_QUOTES for t in before)
    closed = any(t.rstrip(".,;:!?")[-1:] in CLOSING_QUOTES and t.rstrip(".,;:!?") for t in after)
    if opened and closed or token[0] in OPENING_QUOTES and closed:
        return "quoted"
    if any(t.strip(EDGES) in REPORTING for t in before[:-1]):
        return "quoted"
    return "directed" if any(t.strip(EDGES) in SECOND_PERSON for t in near) else "abuse"


def counts(text: str | None, matches: Matches) -> tuple[int, int, int, int, int]:
    """Hits that are abuse, of these directed and misspelled ones, quoted hits, and the number of tokens."""
    tokens = (text or "").lower().split()
    found = list(map(matches.__getitem__, tokens))
    if not any(found):
        return 0, 0, 0, 0, len(tokens)
    abuse = directed = fuzzy = quoted = 0
    for place, hit in enumerate(found):
        if hit:
            kind = context(tokens, place)
            quoted += kind == "quoted"
            abuse += kind != "quoted"
            directed += kind == "directed"
            fuzzy += kind != "quoted" and hit == FUZZY
    return abuse, directed, fuzzy, quoted, len(tokens)


def features(rows: np.ndarray) -> np.ndarray:
    """Counts, one row per document, as `FEATURES`."""
    abuse, directed, fuzzy, quoted, tokens = rows.reshape(-1, 5).astype(float).T
    share = np.log1p(1000 * abuse / np.maximum(tokens, 1))
    columns = [abuse > 0, np.log1p(abuse), np.log1p(directed), np.log1p(fuzzy), np.log1p(quoted), share]
    return np.stack([*columns, np.ones_like(abuse)], axis=1).astype(float)


def fit(rows: np.ndarray, labels: np.ndarray, training: Training) -> tuple[float, ...]:
    """Logistic regression by Newton steps, drawn to the default weights where the sample says little.

    The default weights themselves when a class is missing.
    """
    if len(set(labels.tolist())) < 2:
        return DEFAULT_WEIGHTS
    x, prior = features(rows), np.array(DEFAULT_WEIGHTS)
    w = prior.copy()
    ridge = training.ridge * len(x) * np.diag([*[1e-2] * (len(w) - 1), 1e-6]) + 1e-6 * np.eye(len(w))
    for _ in range(training.rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (labels - p) - ridge @ (w - prior))
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def _names(tokens: Iterable[str]) -> Iterator[str]:
    """The tokens without edge marks, and their openings."""
    for token in tokens:
        bare = token.strip(EDGES)
        if len(bare) >= SHORTEST_OPENING:
            yield bare
            for size in range(SHORTEST_OPENING, min(LONGEST_OPENING, len(bare) - 1) + 1):
                yield bare[:size] + "*"


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: Column, bound: int, label: str) -> DataFrame:
    """`doc_id`, `text`, `label` of at most about `bound` usable labelled rows, chosen by the hash of the id."""
    ids = labels.filter(usable & labels[label].isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    ids = ids.distinct()
    total = ids.count()
    if total > bound:
        ids = ids.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(1_000_003 * bound / total))
    # One row an id and label: an id on any number of rows must not fill the sample.
    return one_row_each(with_text(docs, "doc_id", "text").join(F.broadcast(ids), "doc_id"), "doc_id", "label")


def _learn_terms(sample: DataFrame, training: Training) -> tuple[str, ...]:
    """Terms and openings whose documents are nearly all toxic, greedily by new documents covered."""

    def toxic_names(batches):
        for batch in in_slices(batches):
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
            pairs = [(name, doc) for doc, text in rows for name in set(_names(set((text or "").lower().split())))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.int64())],
                ["name", "doc"],
            )

    def clean_names(batches):
        for batch in in_slices(batches):
            tally: Counter[str] = Counter()
            for text in batch.column("text").to_pylist():
                tally.update(set(_names(set((text or "").lower().split()))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(tally), pa.string()), pa.array(list(tally.values()), pa.int64())], ["name", "n"]
            )

    toxic = sample.filter("label = 1").mapInArrow(toxic_names, "name string, doc long")
    toxic = materialize(toxic, "toxic_names")
    clean = sample.filter("label = 0").mapInArrow(clean_names, "name string, n long")
    often = toxic.groupBy("name").agg(F.count(F.lit(1)).alias("hits")).filter(F.col("hits") >= training.least_documents)
    rated = often.join(clean.groupBy("name").agg(F.sum("n").alias("n")), "name", "left").fillna(0, ["n"])
    pure = rated.filter(F.col("hits") >= training.precision * (F.col("hits") + F.col("n")))
    best = materialize(pure.orderBy(F.desc("hits"), "name").limit(training.candidates), "candidates")
    documents: dict[str, set[int]] = defaultdict(set)
    for row in toxic.join(F.broadcast(best.select("name")), "name").collect():
        documents[row["name"]].add(row["doc"])
    chosen: list[str] = []
    worth: dict[int, float] = defaultdict(lambda: 1.0)
    # Ties go to the longer opening: the same documents with less that could match by chance.
    while len(chosen) < training.terms and documents:
        gains = {name: sum(worth[doc] for doc in found) for name, found in documents.items()}
        name = max(gains, key=lambda n: (round(gains[n], 9), len(n), n))
        if gains[name] < training.least_gain:
            break
        chosen.append(name)
        for doc in documents.pop(name):
            worth[doc] /= 2
    return tuple(chosen)


def _ordinary_words(sample: DataFrame, terms: tuple[str, ...], training: Training) -> frozenset[str]:
    """Tokens of clean labelled documents, of two at least, that the automaton takes for misspelled terms."""

    def run(batches):
        matches = Matches(Automaton(terms))
        for batch in in_slices(batches):
            found = []
            for text in batch.column("text").to_pylist():
                tokens = set((text or "").lower().split())
                found += {t.strip(EDGES) for t in tokens if matches[t] == FUZZY}
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["word"])

    words = sample.filter("label = 0").mapInArrow(run, "word string").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    kept = words.filter("n >= 2").orderBy(F.desc("n"), "word").limit(training.words).collect()
    return frozenset(row["word"] for row in kept)


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    training: Training = Training(),
    seeds: tuple[str, ...] = SEED_TERMS,
) -> Model:
    """Learn terms and weights from the labelled rows for which `usable` (a condition on `labels`) holds."""
    sample = labelled_sample(docs, labels, usable, training.documents, "toxic")
    # A bounded sample needs no more files than this, however many partitions the shuffle before it has.
    sample = materialize(sample.coalesce(max(1, training.documents // SAMPLE_ROWS)), "labelled")
    terms = tuple(dict.fromkeys([*seeds, *_learn_terms(sample, training)]))
    words = _ordinary_words(sample, terms, training)
    rows = _counted(sample, terms, words, "label").drop("doc_id").collect()
    table = np.array([r[1:] for r in rows], float).reshape(-1, 5)
    return Model(terms, fit(table, np.array([r[0] for r in rows], float), training), words)


COUNTS = ("abuse", "directed", "fuzzy", "quoted", "n_tokens")


def _counted(docs: DataFrame, terms: tuple[str, ...], words: frozenset[str], *others: str) -> DataFrame:
    """`doc_id`, the other columns and `COUNTS`."""

    def run(batches):
        matches = Matches(Automaton(terms), words)
        for batch in in_slices(batches):
            found = [counts(text, matches) for text in batch.column("text").to_pylist()]
            columns = [pa.array(column, pa.int64()) for column in zip(*found)]
            kept = [batch.column(name) for name in ("doc_id", *others)]
            yield pa.RecordBatch.from_arrays([*kept, *columns], ["doc_id", *others, *COUNTS])

    narrow = with_text(docs, "doc_id", *others, "text")
    fields = [narrow.schema[name] for name in ("doc_id", *others)]
    return narrow.mapInArrow(run, T.StructType([*fields, *[T.StructField(c, T.LongType()) for c in COUNTS]]))


def _logit(weights: tuple[float, ...]) -> Column:
    """The weighted sum of `FEATURES` from the columns of `COUNTS`."""
    abuse, tokens = F.col("abuse").cast("double"), F.greatest(F.col("n_tokens"), F.lit(1)).cast("double")
    parts = [
        (abuse > 0).cast("double"),
        F.log1p(abuse),
        F.log1p("directed"),
        F.log1p("fuzzy"),
        F.log1p("quoted"),
        F.log1p(1000 * abuse / tokens),
        F.lit(1.0),
    ]
    return sum((F.lit(w) * part for w, part in zip(weights, parts)), F.lit(0.0))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id`, `COUNTS`, `score` and `predicted` for every row."""
    scored = _counted(docs, model.terms, model.words).withColumn("score", 1 / (1 + F.exp(-_logit(model.weights))))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def reject_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs`, all columns, that the model does not predict to be toxic."""

    place = docs.columns.index("text")

    def run(batches):
        matches = Matches(Automaton(model.terms), model.words)
        for batch in in_slices(batches):
            found = np.array([counts(text, matches) for text in batch.column(place).to_pylist()], float)
            logits = features(found) @ np.array(model.weights)
            yield batch.filter(pa.array(logits < 0))

    # Names with dots or backticks in them cannot be handed over, so the columns go by number meanwhile.
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return numbered.mapInArrow(run, numbered.schema).toDF(*docs.columns)
