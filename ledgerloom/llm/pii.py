"""Format-preserving pseudonyms for personal numbers, dates, addresses and credentials, in Spark expressions only.

Candidates are found by one pattern and validated: cards and IBANs by their check digits, IP addresses, social
security numbers and dates by their ranges. A card or IBAN may stand beside other numbers or words: in a run of groups
every start and end of a group is tried, usual layouts first, then the longest, and what is left over is searched for
the other formats. A run is entered up to 200 digits or 60 groups; a number across that end is not seen. A valid value is permuted within its own format by a keyed Feistel
network, and check digits are computed anew, so a pseudonym passes the same validation. A network is a permutation:
equal values get equal pseudonyms in every document, different values different ones. Separators are kept; the
digits alone are permuted, so one number written in two ways stays linked.

What is permuted: the payload of a card or IBAN, the ten national digits of a phone number, all 32 bits of an IP
address, the day number of a date (1900-01-01 to 2100-05-01; slashes and dots mean day first), area, group and
serial of a social security number, the local part of an e-mail address, the value of a credential (`password=…`,
`token: "…"`, `AKIA…`) by character classes.

Defined results: a null text stays null with no replacements; an empty text stays empty; candidates that fail their
validation stay as they are. Rows are independent and keep their other columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import whole_row

ROUNDS = 8

# Formats. Runs are entered at their start only and bounded, so that matching stays linear.
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])"
LABEL = r"(?i:password|passwd|pwd|secret|token|api[_-]?key)[ ]{0,3}[=:][ ]{0,3}[\"']?"
SECRET = rf"(?<![A-Za-z0-9]){LABEL}[A-Za-z0-9_/+-]{{6,}}+"
ACCESS_KEY = r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
IP = rf"(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?![\w]|\.[0-9])"
DATE = r"(?<![\w./-])(?:[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}|[0-9]{2}([/.])[0-9]{2}\2[0-9]{4})(?![\w]|[./-][0-9])"
PHONE = r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ ]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w])"
SOCIAL = r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"
# A run of groups must not take the first digits of another format with it.
END = (
    rf"(?![A-Za-z0-9_]|(?:\.{OCTET}){{3}}(?![\w]|\.[0-9])|[./-][0-9]{{1,2}}[./-][0-9]{{2,4}}(?![\w])"
    r"|[.-][0-9]{3}[ .-][0-9]{4}(?![\w])|[A-Za-z0-9._%+-]{1,64}+@|@)"
)
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,60}(?:[ ]?[A-Z0-9]{1,3})?" + END
CARD = r"(?<![\w])[0-9](?:[ -]?[0-9]){12,199}" + END
ONE_IBAN = r"^[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?$"
ONE_CARD = r"^[0-9](?:[ -]?[0-9]){12,18}$"
USUAL_CARD = r"^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5})$"
FORMATS = {
    "email": EMAIL, "secret": SECRET, "access": ACCESS_KEY, "iban": IBAN, "ip": IP, "date": DATE, "social": SOCIAL,
    "phone": PHONE, "card": CARD,
}

FIRST_DAY = "1900-01-01"
DATE_SIDES = (270, 271)  # their product is the number of days from 1900-01-01 to 2100-05-01
SOCIAL_SIDES = (898 * 99, 9999)  # areas 001-899 without 666, groups 01-99, serials 0001-9999


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _number(digest: Column, place: Column | int, digits: int = 4) -> Column:
    return F.conv(F.substring(digest, place, digits), 16, 10).cast("long")


def _digest(key: str, kind: str, turn: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), other.cast("string")), 512)


def _turned(char: Column, by: Column) -> Column:
    """The character moved on within its class of digits, upper or lower case letters; others stay."""
    code = F.ascii(char)

    def within(first: int, size: int) -> Column:
        return F.char(F.lit(first) + (code - first + by) % size)

    return (
        F.when(code.between(48, 57), within(48, 10))
        .when(code.between(65, 90), within(65, 26))
        .when(code.between(97, 122), within(97, 26))
        .otherwise(char)
    )


def _turned_text(text: Column, digest: Column) -> Column:
    return _let(
        digest,
        lambda d: F.array_join(
            F.transform(F.split(text, ""), lambda c, j: _turned(c, _number(d, (j % 32) * 4 + 1))), ""
        ),
    )


def feistel_text(text: Column, key: str, kind: str) -> Column:
    """Permutes texts of one layout: each character stays in its class."""

    def turn(state: Column, i: Column) -> Column:
        half = F.length(state) / 2
        left, right = F.substring(state, 1, half.cast("int")), F.substring(state, half.cast("int") + 1, F.length(state))
        return F.when(i % 2 == 0, F.concat(left, _turned_text(right, _digest(key, kind, i, left)))).otherwise(
            F.concat(_turned_text(left, _digest(key, kind, i, right)), right)
        )

    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), text, turn)


def feistel_number(number: Column, sides: tuple[int, int], key: str, kind: str) -> Column:
    """Permutes the whole numbers below the product of the two sides."""
    high, low = (F.lit(side).cast("long") for side in sides)

    def turn(state: Column, i: Column) -> Column:
        a, b = F.floor(state / low).cast("long"), state % low
        moved_a = (a + _number(_digest(key, kind, i, b), 1, 12)) % high
        moved_b = (b + _number(_digest(key, kind, i, a), 1, 12)) % low
        return F.when(i % 2 == 0, moved_a * low + b).otherwise(a * low + moved_b)

    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), number.cast("long"), turn)


def _relaid(layout: Column, chars: Column, pattern: str) -> Column:
    """`layout` with its characters of the class `pattern` replaced, in order, by those of `chars`."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(state: Column, c: Column) -> Column:
        mine = c.rlike(pattern)
        return F.struct(
            F.concat(state["out"], F.when(mine, F.substring(chars, state["at"], 1)).otherwise(c)).alias("out"),
            (state["at"] + mine.cast("int")).alias("at"),
        )

    return F.aggregate(F.split(layout, ""), start, step, lambda state: state["out"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """The weighted digit sum whose last digit is 0 for a valid number."""

    def weigh(c: Column, j: Column) -> Column:
        n = c.cast("int")
        return F.when(j % 2 == 0, n).when(n > 4, 2 * n - 9).otherwise(2 * n)

    weighed = F.transform(F.split(F.reverse(digits), ""), weigh)
    return F.aggregate(weighed, F.lit(0), lambda total, n: total + n)


def _valid_card(value: Column) -> Column:
    return luhn_sum(_digits(value)) % 10 == 0


def _card(value: Column, key: str) -> Column:
    def permuted(digits: Column) -> Column:
        payload = feistel_text(F.substring(digits, 1, F.length(digits) - 1), key, "card")
        return _let(payload, lambda p: F.concat(p, ((10 - luhn_sum(F.concat(p, F.lit("0"))) % 10) % 10).cast("string")))

    valid = _valid_card(value)
    return F.when(valid, _let(permuted(_digits(value)), lambda d: _relaid(value, d, "[0-9]"))).otherwise(value)


def _mod97(text: Column) -> Column:
    def fold(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code <= 57, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), fold)


def _valid_iban(value: Column) -> Column:
    bare = F.replace(value, F.lit(" "), F.lit(""))
    return _mod97(F.concat(F.substring(bare, 5, F.length(bare)), F.substring(bare, 1, 4))) == 1


def _iban(value: Column, key: str) -> Column:
    bare = F.replace(value, F.lit(" "), F.lit(""))
    country = F.substring(bare, 1, 2)
    account = F.substring(bare, 5, F.length(bare))

    def anew(a: Column) -> Column:
        digits = F.lpad((98 - _mod97(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0")
        return F.concat(country, digits, a)

    valid = _valid_iban(value)
    permuted = _let(feistel_text(account, key, "iban"), anew)
    return F.when(valid, _let(permuted, lambda p: _relaid(value, p, "[0-9A-Z]"))).otherwise(value)


def _ip(value: Column, key: str) -> Column:
    parts = F.split(value, r"\.")
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda n, part: n * 256 + part.cast("long"))
    return _let(
        feistel_number(number, (65536, 65536), key, "ip"),
        lambda n: F.concat_ws(".", *[F.shiftright(n, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]),
    )


def _date(value: Column, key: str) -> Column:
    year_first = value.rlike(r"^[0-9]{4}")
    y = F.when(year_first, F.substring(value, 1, 4)).otherwise(F.substring(value, 7, 4))
    m = F.when(year_first, F.substring(value, 6, 2)).otherwise(F.substring(value, 4, 2))
    d = F.when(year_first, F.substring(value, 9, 2)).otherwise(F.substring(value, 1, 2))
    day = F.datediff(F.try_to_date(F.concat_ws("-", y, m, d), "yyyy-MM-dd"), F.lit(FIRST_DAY).cast("date"))
    mark = F.when(year_first, F.substring(value, 5, 1)).otherwise(F.substring(value, 3, 1))

    def shown(moved: Column) -> Column:
        date = F.date_add(F.lit(FIRST_DAY).cast("date"), moved.cast("int"))
        y, m, d = F.date_format(date, "yyyy"), F.date_format(date, "MM"), F.date_format(date, "dd")
        return F.when(year_first, F.concat(y, mark, m, mark, d)).otherwise(F.concat(d, mark, m, mark, y))

    inside = F.coalesce(day.between(0, DATE_SIDES[0] * DATE_SIDES[1] - 1), F.lit(False))
    return F.when(inside, _let(feistel_number(day, DATE_SIDES, key, "date"), shown)).otherwise(value)


def _social(value: Column, key: str) -> Column:
    area, group, serial = (F.substring(value, at, n).cast("long") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - F.when(area > 666, 2).otherwise(1)
    number = (place * 99 + group - 1) * SOCIAL_SIDES[1] + serial - 1

    def shown(n: Column) -> Column:
        head, serial = F.floor(n / SOCIAL_SIDES[1]).cast("long"), n % SOCIAL_SIDES[1] + 1
        place, group = F.floor(head / 99).cast("long"), head % 99 + 1
        return F.format_string("%03d-%02d-%04d", place + F.when(place >= 665, 2).otherwise(1), group, serial)

    return F.when(valid, _let(feistel_number(number, SOCIAL_SIDES, key, "social"), shown)).otherwise(value)


def _phone(value: Column, key: str) -> Column:
    def moved(digits: Column) -> Column:
        keep = F.length(digits) - 10
        return F.concat(
            F.substring(digits, 1, keep), feistel_text(F.substring(digits, keep + 1, F.lit(10)), key, "phone")
        )

    return _let(_let(_digits(value), moved), lambda d: _relaid(value, d, "[0-9]"))


def _email(value: Column, key: str) -> Column:
    name = F.substring_index(value, "@", 1)
    return F.concat(feistel_text(name, key, "email"), F.substring(value, F.length(name) + 1, F.length(value)))


def _secret(value: Column, key: str) -> Column:
    label = F.regexp_extract(value, f"^({LABEL})", 1)
    rest = F.substring(value, F.length(label) + 1, F.length(value))
    return F.concat(label, feistel_text(rest, key, "secret"))


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one candidate, by the first format that it has."""

    def whole(pattern: str) -> Column:
        return value.rlike(f"^(?:{pattern})$")

    return (
        F.when(value.contains("@"), _email(value, key))
        .when(value.rlike(f"^{LABEL}"), _secret(value, key))
        .when(whole(ACCESS_KEY), F.concat(F.lit("AKIA"), feistel_text(F.substring(value, 5, 16), key, "secret")))
        .when(value.rlike(ONE_IBAN), _iban(value, key))
        .when(whole(IP), _ip(value, key))
        .when(whole(DATE.replace(r"\1", r"[-/.]").replace(r"\2", "[/.]")), _date(value, key))
        .when(whole(SOCIAL), _social(value, key))
        .when(whole(PHONE), _phone(value, key))
        .otherwise(_card(value, key))
    )


def _candidate(formats: list[str]) -> str:
    """The pattern of the formats. Inside a word nothing starts; one look behind settles that for all."""
    return rf"(?<![A-Za-z0-9_])(?:{'|'.join(FORMATS[f] for f in formats)})"


def _part(text: Column, value: bool) -> Column:
    return F.struct(text.alias("text"), F.lit(value).alias("value"))


def _carved(run: Column, valid: Callable[[Column], Column], shape: str, usual: str, sizes: tuple[int, int],
            rest: Callable[[Column], Column]) -> Column:
    """The parts of a run of groups: the valid values in it, and what `rest` makes of the text between them."""

    def text(at: Column, size: Column) -> Column:
        return F.substring(run, at, size)

    places = F.sequence(F.lit(1), F.length(run))
    starts = F.filter(places, lambda p: (p == 1) | text(p - 1, F.lit(1)).isin(" ", "-"))

    def spans(start: Column) -> Column:
        def fits(size: Column) -> Column:
            one = text(start, size)
            ends = (F.length(one) == size) & ~text(start + size, F.lit(1)).rlike("[A-Za-z0-9]")
            return F.when(ends & one.rlike(shape), valid(one)).otherwise(F.lit(False))

        found = F.filter(F.sequence(F.lit(sizes[0]), F.lit(sizes[1])), fits)
        return F.transform(
            found,
            lambda size: F.struct(
                (~text(start, size).rlike(usual)).alias("unusual"), (-size).alias("less"), start.alias("at"), size.alias("size")
            ),
        )

    def apart(a: Column, b: Column) -> Column:
        return (a["at"] + a["size"] <= b["at"]) | (b["at"] + b["size"] <= a["at"])

    every = F.array_sort(F.flatten(F.transform(starts, spans)))
    none = F.filter(F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("size"))), lambda x: x["at"] > 0)

    def take(taken: Column, one: Column) -> Column:
        mine = F.array(F.struct(one["at"].alias("at"), one["size"].alias("size")))
        return F.when(F.forall(taken, lambda other: apart(one, other)), F.concat(taken, mine)).otherwise(taken)

    chosen = F.array_sort(F.aggregate(every, none, take))
    nothing = F.filter(F.array(_part(F.lit(""), False)), lambda x: x["value"])
    begin = F.struct(nothing.alias("parts"), F.lit(1).alias("at"))

    def step(state: Column, one: Column) -> Column:
        before = rest(text(state["at"], one["at"] - state["at"]))
        mine = F.array(_part(text(one["at"], one["size"]), True))
        return F.struct(F.concat(state["parts"], before, mine).alias("parts"), (one["at"] + one["size"]).alias("at"))

    return F.aggregate(
        chosen, begin, step, lambda state: F.concat(state["parts"], rest(text(state["at"], F.length(run))))
    )


def _parts(text: Column, formats: list[str]) -> Column:
    """The text in order as parts: `text`, and whether that is a `value` to put under a pseudonym."""
    pattern = _candidate(formats)

    def without(name: str) -> Callable[[Column], Column]:
        after = formats[: formats.index(name)] + formats[formats.index(name) + 1 :]
        return lambda left: _parts(left, after)

    def opened(value: Column) -> Column:
        whole = F.array(_part(value, True))
        out = F.when(value.contains("@") | value.rlike(f"^{LABEL}"), whole)
        if "iban" in formats:
            carved = _carved(value, _valid_iban, ONE_IBAN, ONE_IBAN, (12, 43), without("iban"))
            out = out.when(value.rlike(f"^{IBAN}$"), carved)
        if "card" in formats:
            other = "|".join(f"^(?:{f})$" for f in (DATE, SOCIAL, PHONE))
            carved = _carved(value, _valid_card, ONE_CARD, USUAL_CARD, (13, 37), without("card"))
            out = out.when(value.rlike(f"^{CARD}$") & ~value.rlike(other), carved)
        return out.otherwise(whole)

    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), opened)
    nothing = F.filter(F.array(_part(F.lit(""), False)), lambda x: x["value"])
    return F.flatten(
        F.zip_with(
            F.split(text, pattern),
            F.concat(found, F.array(nothing)),
            lambda piece, parts: F.concat(F.array(_part(piece, False)), parts),
        )
    )


def pseudonymize(docs: DataFrame, key: str, text_column: str = "text") -> DataFrame:
    """`row`, the row of `docs` with its text rewritten, and `n_replaced`, the number of values that changed."""
    found = docs.select(
        whole_row(docs).alias("row"), _parts(docs[text_column], list(FORMATS)).alias("parts")
    )
    named = found.withColumn(
        "names",
        F.transform("parts", lambda p: F.when(p["value"], pseudonym(p["text"], key)).otherwise(p["text"])),
    )
    text = F.col("row")[text_column]
    changed = F.zip_with("parts", "names", lambda a, b: (a["text"] != b).cast("long"))
    total = F.aggregate(changed, F.lit(0).cast("long"), lambda total, n: total + n)
    return named.select(
        F.col("row").withField(text_column, F.when(F.size("parts") > 1, F.array_join("names", "")).otherwise(text)),
        F.coalesce(total, F.lit(0).cast("long")).alias("n_replaced"),
    ).toDF("row", "n_replaced")
