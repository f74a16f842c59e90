"""Line-first cleaning: rules judge each line, failing lines go, and a document that loses too much goes too.

A line with at least one word fails under the first rule that holds:

- `navigation`: a fifth or more of its words are separators of menus and tables, such as `|` or `»`;
- `boilerplate`: it contains a stock phrase (rights, cookies, scripts, sign-up prompts);
- `marks`: it has nearly as many ASCII punctuation marks as words or more;
- `repeated`: it has ten words or more and one of them makes up half of it;
- `punctuation`: it holds no end of a sentence.

A document passes when it passes the word-count and repetition floor and its surviving lines hold at least
`keep_share` of the code points of its words.

Defined results: a null text has no words and fails the floor, as an empty one does; lines without a word are
neither counted nor kept. Rows are independent, so repeated rows, ties and other columns change nothing.
"""

from __future__ import annotations

import string
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerloom.llm.text import in_slices, with_text

# Fixed values of the base rules.
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

# Parameters of the line rules.
SENTENCE_ENDS = tuple(".!?…:;\"'”’»)]。！？")
SEPARATOR_TEXTS = tuple("| || - -- – — / » › > >> • ·".split())
SEPARATORS = frozenset(text.encode() for text in SEPARATOR_TEXTS)
PHRASES = (
    "all rights reserved",
    "terms of service",
    "terms of use",
    "privacy policy",
    "use of cookies",
    "accept cookies",
    "enable javascript",
    "javascript is disabled",
    "javascript is required",
    "lorem ipsum",
    "click here",
    "sign up now",
    "subscribe to our",
)
STOCK_PHRASES = tuple(phrase.encode() for phrase in PHRASES)
MARKS = string.punctuation.encode()
MARKS_PER_WORD, SEPARATOR_SHARE, REPEAT_SHARE, REPEAT_WORDS = 0.9, 0.2, 0.5, 10
KEEP_SHARE = 0.5

RULES = ("navigation", "boilerplate", "marks", "repeated", "punctuation")

OUTPUT = T.StructType(
    [
        T.StructField("n_words", T.LongType(), False),
        T.StructField("word_chars", T.LongType(), False),
        T.StructField("n_symbols", T.LongType(), False),
        T.StructField("n_dup_lines", T.LongType(), False),
        T.StructField("n_repeat_words", T.LongType(), False),
        T.StructField("kept_chars", T.LongType(), False),
        *[T.StructField(f"lines_{rule}", T.LongType(), False) for rule in RULES],
        T.StructField("base_failed", T.BooleanType(), False),
        T.StructField("kept", T.BooleanType(), False),
        T.StructField("clean_text", T.StringType(), False),
    ]
)


class Numbers(dict):
    """Numbers its keys in order of appearance."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def has_stock_phrase(data: bytes) -> bool:
    lower = data.lower()
    return any(phrase in lower for phrase in STOCK_PHRASES)


def failed_rule(line: bytes, words: list[bytes], stock: bool) -> str | None:
    """The rule a line with words fails, or None; `stock` says whether the document holds a stock phrase at all."""
    n = len(words)
    if not SEPARATORS.isdisjoint(words) and sum(word in SEPARATORS for word in words) >= SEPARATOR_SHARE * n:
        return "navigation"
    if stock and has_stock_phrase(line):
        return "boilerplate"
    if n > 1 and len(line) - len(line.translate(None, MARKS)) >= MARKS_PER_WORD * n:
        return "marks"
    if n >= REPEAT_WORDS and len(set(words)) <= n - REPEAT_SHARE * n + 1:
        if Counter(words).most_common(1)[0][1] >= REPEAT_SHARE * n:
            return "repeated"
    if not any(word.decode().endswith(SENTENCE_ENDS) for word in reversed(words)):
        return "punctuation"
    return None


def _visible(data: bytes) -> int:
    """Code points outside white space: bytes that do not continue a character."""
    shown = np.frombuffer(data.translate(None, SPACES), np.uint8)
    return len(shown) - int(((shown & 0xC0) == 0x80).sum())


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of three that occur at least twice; a word in several such windows counts once."""
    n = len(words)
    if n < 4:
        return 0
    numbers = Numbers()
    codes = np.fromiter(map(numbers.__getitem__, words), np.int64, n)
    pairs = codes[:-1] * len(numbers) + codes[1:]
    if len(numbers) > 2_000_000:  # three of them would not fit into 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(numbers) + codes[2:]
    order = np.argsort(windows)
    same = np.diff(windows[order]) == 0
    hit = np.zeros(n - 2, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift : n - 2 + shift] |= hit
    return int(inside.sum())


def judge(text: str | None, keep_share: float = KEEP_SHARE) -> tuple:
    """One row of `OUTPUT`."""
    data = (text or "").encode()
    stock = has_stock_phrase(data)
    words, kept_lines, failures, seen, repeats = [], [], dict.fromkeys(RULES, 0), set(), 0
    for line in data.split(b"\n"):
        line_words = line.split()
        if not line_words:
            continue
        words += line_words
        repeats += line in seen
        seen.add(line)
        rule = failed_rule(line, line_words, stock)
        if rule:
            failures[rule] += 1
        else:
            kept_lines.append(line)
    clean = b"\n".join(kept_lines)
    chars, kept_chars, repeat = _visible(data), _visible(clean), repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * len(words)
    kept = not failed and kept_chars >= keep_share * chars
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    counts = (len(words), chars, symbols, repeats, repeat, kept_chars)
    return (*counts, *failures.values(), failed, kept, clean.decode())


def clean_lines(docs: DataFrame, keep_share: float = KEEP_SHARE, id_column: str = "doc_id") -> DataFrame:
    """`id_column` and the columns of `OUTPUT` for every row: counts, verdict and the text without failing lines."""

    def run(batches):
        kinds = pa.schema([(f.name, _ARROW[type(f.dataType)]) for f in OUTPUT.fields])
        for batch in in_slices(batches):
            rows = [judge(text, keep_share) for text in batch.column("text").to_pylist()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds.types)]
            yield pa.RecordBatch.from_arrays([batch.column(id_column), *columns], [id_column, *kinds.names])

    narrow = with_text(docs, id_column, "text")
    return narrow.mapInArrow(run, T.StructType([narrow.schema[id_column], *OUTPUT.fields]))


_ARROW = {T.LongType: pa.int64(), T.BooleanType: pa.bool_(), T.StringType: pa.string()}
