"""Text functions against Python's own string methods, over random Unicode text."""

import random
import re

from pyspark.sql import functions as F

from ledgerloom.functions.text import COMPANY_SUFFIXES, is_email, normalize_name, strip

LETTERS = list("aZ09_ .,@-+&'") + [
    " ", "\t", "\n", "\x0b", "\x1c", "\x85", "\xa0", "　", "é", "ß", "ﬁ", "ı", "İ", "ſ", "Σ", "日", "٣", "²",
    "①", "Ⅷ", "ª", "ŉ", "́", "​", "\U0001d7d8",
]
WORDS = ["LLC", "inc", "Corp", "CO", "ltd", "GmbH", "S.A.", "SA", "s.a", "SA.", "Acme", "ap@x.com", "x@y.z"]


def texts(count):
    rng = random.Random(5)
    made = []
    for _ in range(count):
        parts = [rng.choice(WORDS) if rng.random() < 0.35 else rng.choice(LETTERS) for _ in range(rng.randrange(9))]
        made.append("".join(parts))
    return made


def test_like_python(spark):
    values = texts(6000)
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    v = F.col("v")
    rows = df.select("v", strip(v).alias("s"), normalize_name(v).alias("n"), is_email(strip(v)).alias("e")).collect()
    suffix = re.compile(rf"\b({COMPANY_SUFFIXES})\b")
    email = re.compile(r"[\w.+-]+@[\w-]+\.[\w.]+")
    wrong = [
        r
        for r in rows
        if r.s != r.v.strip()
        or r.n != "".join(c for c in suffix.sub("", r.v.upper()) if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
        or r.e != bool(email.fullmatch(r.v.strip()))
    ]
    assert wrong == []
    assert sum(r.e for r in rows) > 20
