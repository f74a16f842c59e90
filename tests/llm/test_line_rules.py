import re
from collections import Counter

import pytest

from ledgerloom.llm import line_rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = [any(windows[tuple(words[j : j + 3])] > 1 for j in range(max(0, i - 2), min(i, len(words) - 3) + 1)) for i in range(len(words))]
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in seen
            seen.add(line)
    n, again = len(words), sum(inside)
    counts = (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, again)
    return counts, n < 50 or 100 * again > 50 * n


SENTENCE = "This{0} is line{0} of an ordinary{0} text{0}, with some{0} commas{0} in it."
GOOD = "\n".join(SENTENCE.format(i) for i in range(12))

TEXTS = [
    None, "", " \n\t\n", GOOD, GOOD + "\n" + GOOD, "a b c a b c", "a a a a", "x " * 80, "é ü\x85ß z " * 30,
    "w1 w2\nw1 w2\n\nw1 w2 \nw3", "# * $ % & | < >", GOOD + "\nHome | About | Contact",
    "\n".join("one | two | three" for _ in range(40)), GOOD.upper().replace(" ", "!! "), "word\r\nword\x0b\x0cword",
]


@pytest.mark.parametrize("text", TEXTS)
def test_counts_equal_brute_force(text):
    row = dict(zip(line_rules.OUTPUT.names, line_rules.judge(text)))
    counts, failed = brute(text)
    assert tuple(row[c] for c in line_rules.OUTPUT.names[:5]) == counts
    assert row["base_failed"] == failed
    assert not (failed and row["kept"])


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        ("Home | About | Contact", "navigation"),
        ("Copyright 2020, All Rights Reserved.", "boilerplate"),
        ("WHAT!! IS!! THIS!!", "marks"),
        ("spam " * 12 + "end.", "repeated"),
        ("no end of a sentence", "punctuation"),
        ("A sentence. And a cut", None),
        ("Fine.", None),
    ],
)
def test_rules(line, rule):
    data = line.encode()
    assert line_rules.failed_rule(data, data.split(), line_rules.has_stock_phrase(data)) == rule


def test_verdict_and_clean_text():
    row = dict(zip(line_rules.OUTPUT.names, line_rules.judge(GOOD + "\nHome | About | Contact\n\nno end")))
    assert row["kept"] and row["clean_text"] == GOOD
    junk = "\n".join(f"{a} | {b} | cell" for a, b in zip(range(30), range(50, 80)))
    assert not line_rules.judge(GOOD[:200] + "\n" + junk)[-2]


def test_frame(spark, documents):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, GOOD), (None, GOOD), (99, GOOD + " tail" * 100_000)]
    got = line_rules.clean_lines(documents(rows)).collect()
    expected = sorted((str(i), *line_rules.judge(t)) for i, t in rows)
    assert sorted((str(r[0]), *r[1:]) for r in got) == expected
    assert line_rules.clean_lines(documents([])).count() == 0
