import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.text import account_code, is_blank, is_email, line_key, normalize_name, strip


def apply(spark, function, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r.r for r in df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()]


def test_strip_takes_every_kind_of_space(spark):
    values = ["a", " a ", "\ta\n", " a ", "\x1ca\x1f", "　 a b  ", " \t ", ""]
    assert apply(spark, strip, values) == [v.strip() for v in values]


def test_blank(spark):
    assert apply(spark, is_blank, ["", "  ", " \t", "x", " x "]) == [True, True, True, False, False]


@pytest.mark.parametrize(
    "name, expected",
    [
        ("Alpine Tools LLC", "ALPINETOOLS"),
        ("ALPINE TOOLS, LLC.", "ALPINETOOLS"),
        ("North Lake Paper", "NORTHLAKEPAPER"),
        ("NorthLake Paper", "NORTHLAKEPAPER"),
        ("Harbour Freight CR", "HARBOURFREIGHTCR"),
        ("Sol Metals S.A.", "SOLMETALS"),
        ("Sol Metals SA", "SOLMETALS"),
        ("Co Corp Inc", ""),
        ("Costco Incorporated", "COSTCOINCORPORATED"),
        ("S.A.X", "X"),
        ("Müller GmbH", "MLLER"),
        ("Straße Co", "STRASSE"),
        ("ÉCO", "CO"),
        ("COÉ", "CO"),
        ("CO_1", "CO1"),
        ("日本 LTD", ""),
        ("", ""),
    ],
)
def test_normalize_name(spark, name, expected):
    assert apply(spark, normalize_name, [name]) == [expected]


@pytest.mark.parametrize(
    "text, valid",
    [
        ("ap@vendor.com", True),
        ("a.b+c-d@x-y.co.uk", True),
        ("é@b.c", True),
        ("ap@vendor", False),
        ("vendor.com", False),
        ("a b@c.d", False),
        ("a@b.c d", False),
        ("a@b@c.d", False),
        ("", False),
        ("a@b.c\n", False),
        ("a@b.-", False),
    ],
)
def test_email(spark, text, valid):
    assert apply(spark, is_email, [text]) == [valid]


def test_account_code_pads_and_never_cuts(spark):
    df = spark.createDataFrame([(7,), (99999,), (1234567,)], "n long")
    codes = [r.c for r in df.select(account_code(F.col("n")).alias("c")).collect()]
    assert codes == ["VEND-00007", "VEND-99999", "VEND-1234567"]


def test_line_key_treats_null_as_empty(spark):
    df = spark.createDataFrame([("PO-1", 2), (None, 2), ("PO-1", None), (None, None)], "d string, n long")
    keys = [r.k for r in df.select(line_key(F.col("d"), F.col("n")).alias("k")).collect()]
    assert keys == ["PO-1-2", "-2", "PO-1-", "-"]
