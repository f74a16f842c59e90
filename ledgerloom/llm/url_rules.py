"""URL filters: pattern rules found through their rarest literal token.

A rule is one line of filter text. `||` anchors it at the start of a label of the host, `^` stands for a separator or
the end, `*` for anything, a last `|` for the end, `@@` in front makes it allow instead of block, and `$host` behind
lets it see the host alone. Site rules (a host with all its subdomains, and the start of a path) are rules of the same
kind, which come first.

The literal tokens of a rule, runs of ASCII letters and digits that end within the rule, must be tokens of every URL
that it matches. How many URLs hold each token is counted over the whole table, and each rule is filed under the
rarest of its tokens. A URL's tokens fetch the rules filed under them, and only those run their regular expressions.
Rules without such a token run on every URL.

The verdict is that of the longest site rule that fits; else the longest pattern that allows; else `block` if any
pattern matches; else `allow`. Equal lengths go to the first rule of the list.

Rules are the caller's text, held by the tasks in shards of at most `shard_chars` characters, one pass each over the
same rows, so any number of rules fits. Nothing but the token counts is shuffled, at most one row a token and task.

Defined results: a null URL, or one without `://`, has an empty host and path and no tokens, and is allowed. Host and
path are cut from whole URLs of any length. Rows are independent: repeated rows, null ids and other columns change
nothing, an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.text import with_text

ALLOW, BLOCK = "allow", "block"

# Parameters: sites and paths that are never a page's own text, tried where no site rule fits.
PATTERNS = (
    "||spam-$host", "-spam.$host", "||casino-$host", "||casino.$host", "-casino.$host", "||poker-$host", "-poker.$host",
    "||bets-$host", "-bets.$host", "||pills-$host", "-pills.$host", "||porn-$host", "||porn.$host", "-porn.$host",
    "||escorts-$host", "-escorts.$host", "||adserver.$host", "||doubleclick.$host",
    "/wp-login.", "/wp-admin/", "/cgi-bin/", "/login^", "/signup^", "/cart^", "/checkout^", "/password/reset^",
    "?replytocom=", "&replytocom=", "?share=", "/feed/rss^", "/search?q=",
    "@@||gov^$host", "@@||edu^$host",
)
SHARD_CHARS = 4_000_000

_UPPER_TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_TOKEN = re.compile(r"[0-9a-z]+")
_HOST_END, _PATH_END = re.compile(r"[/?#]"), re.compile(r"[?#]")

SITE, EXCEPTION, PATTERN = 2, 1, 0


def lower_ascii(text: str) -> str:
    """A-Z in lower case, every other character as it is."""
    return text.translate(_UPPER_TO_LOWER)


def split_url(url: str | None) -> tuple[str, str, str]:
    """Host in lower case, path, and what follows the path."""
    at = (url or "").find("://")
    if at < 0:
        return "", "", ""
    rest = url[at + 3 :]
    end = _HOST_END.search(rest)
    host, tail = (rest, "") if end is None else (rest[: end.start()], rest[end.start() :])
    end = _PATH_END.search(tail)
    path, query = (tail, "") if end is None else (tail[: end.start()], tail[end.start() :])
    return lower_ascii(host), path, query


def tokens_of(text: str) -> set[str]:
    return set(_TOKEN.findall(lower_ascii(text)))


@dataclass(frozen=True)
class Rule:
    """`kind` orders the verdicts: site rules, exceptions, patterns. `name` is what the results show."""

    name: str
    verdict: str
    kind: int
    body: str
    host_only: bool = False

    @property
    def rank(self) -> tuple[int, int]:
        return self.kind, len(self.name)

    def regex(self, end: str = r"\Z") -> str:
        """The expression over `//host`, path and query, or over `//host/` for rules of hosts; `end` is the end of text."""
        body, text = self.body, ""
        if body.startswith("||"):
            body, text = body[2:], r"^//(?:[^/?#]*\.)?"
        closed = body.endswith("|")
        for part in re.split(r"([*^])", body.removesuffix("|") if closed else body):
            text += {"*": "(?s:.*)", "^": rf"(?:[^0-9A-Za-z_.%-]|{end})"}.get(part) or re.escape(part)
        return text + (end if closed else "")

    def literal_tokens(self) -> set[str]:
        """Tokens that every matching URL has: not cut off by a wildcard or an open end."""
        body = self.body
        start = body.startswith("||")
        body = ("^" + body[2:]) if start else "*" + body
        body = body.removesuffix("|") + "^" if body.endswith("|") else body + "*"
        found = set()
        for run in body.split("*"):
            # What touches a wildcard may go on in the URL, unless a separator stands between.
            for token in _TOKEN.finditer(lower_ascii(run)):
                if token.start() > 0 and token.end() < len(run):
                    found.add(token.group())
        return found


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """`host` and all its subdomains, for paths that start with `path`."""
    return Rule(host + path, verdict, SITE, f"||{host}{path}")


def pattern_rule(text: str) -> Rule:
    allows = text.startswith("@@")
    body = text.removeprefix("@@")
    host_only = body.endswith("$host")
    kind = EXCEPTION if allows else PATTERN
    return Rule(text, ALLOW if allows else BLOCK, kind, body.removesuffix("$host"), host_only)


class Index:
    """Numbered rules by the token they are filed under; compiled when first fetched."""

    def __init__(self, filed: Iterable[tuple[int, Rule, str | None]]) -> None:
        self.filed: dict[str | None, list[tuple[int, Rule]]] = {}
        for number, rule, token in filed:
            self.filed.setdefault(token, []).append((number, rule))
        self.compiled: dict[int, re.Pattern] = {}

    def candidates(self, tokens: set[str]) -> list[tuple[int, Rule]]:
        found = list(self.filed.get(None, ()))
        for token in tokens:
            found += self.filed.get(token, ())
        return found

    def best(self, host: str, path: str, query: str) -> Rule | None:
        """The highest of the rules that match; the first of equals."""
        if not host and not path:
            return None
        whole, alone = f"//{host}{path}{query}", f"//{host}/"
        hits = []
        for number, rule in self.candidates(tokens_of(whole)):
            if number not in self.compiled:
                self.compiled[number] = re.compile(rule.regex())
            if self.compiled[number].search(alone if rule.host_only else whole):
                hits.append((*rule.rank, -number, rule))
        return max(hits)[-1] if hits else None


def token_counts(parts: DataFrame, wanted: Sequence[set[str]]) -> dict[str, int]:
    """The number of URLs that hold each wanted token, over the whole table; a task sends a row a token at most."""

    def counting(tokens: set[str]):
        def run(batches):
            seen: Counter[str] = Counter()
            for batch in batches:
                for host, path, query in zip(*[batch.column(name).to_pylist() for name in _PARTS]):
                    seen.update(tokens_of(f"//{host}{path}{query}") & tokens)
            found = [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(found, ["token", "n"])

        return run

    counts: dict[str, int] = {}
    for tokens in wanted:
        per_task = parts.mapInArrow(counting(tokens), "token string, n long")
        counts |= {row.token: row.n for row in per_task.groupBy("token").agg(F.sum("n").alias("n")).collect()}
    return counts


def in_shards(rules: Sequence[Rule], shard_chars: int) -> list[list[tuple[int, Rule]]]:
    """The numbered rules, cut where a shard would pass `shard_chars` characters; one shard at least."""
    shards: list[list[tuple[int, Rule]]] = [[]]
    size = 0
    for number, rule in enumerate(rules):
        if shards[-1] and size + len(rule.body) > shard_chars:
            shards.append([])
            size = 0
        shards[-1].append((number, rule))
        size += len(rule.body)
    return shards


def rarest_token(rule: Rule, counts: dict[str, int]) -> str | None:
    """The token of the rule in the fewest URLs, the longest of equals; None if it has no literal token."""
    return min(rule.literal_tokens(), key=lambda token: (counts.get(token, 0), -len(token), token), default=None)


_PARTS = ("host", "path", "query")
# The best rule so far: what orders it, and what the results say of it.
_BEST = {"kind": pa.int32(), "length": pa.int32(), "name": pa.string(), "verdict": pa.string()}
_NONE = (PATTERN - 1, 0, None, None)


def _split(batches):
    for batch in batches:
        parts = [split_url(url) for url in batch.column(1).to_pylist()]
        columns = [pa.array([part[i] for part in parts], pa.string()) for i in range(len(_PARTS))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", *_PARTS])


def _shard_pass(filed: list[tuple[int, Rule, str | None]]):
    """Rows with the best rule so far, improved by one shard of rules."""

    def run(batches):
        index = Index(filed)
        for batch in batches:
            best = list(zip(*[batch.column(name).to_pylist() for name in _BEST]))
            for place, url in enumerate(zip(*[batch.column(name).to_pylist() for name in _PARTS])):
                rule = index.best(*url)
                if rule is not None and rule.rank > best[place][:2]:
                    best[place] = (*rule.rank, rule.name, rule.verdict)
            columns = [pa.array([row[i] for row in best], kind) for i, kind in enumerate(_BEST.values())]
            kept = [batch.column(name) for name in ("id", *_PARTS)]
            yield pa.RecordBatch.from_arrays([*kept, *columns], ["id", *_PARTS, *_BEST])

    return run


def judge_urls(
    pages: DataFrame,
    sites: Sequence[Rule],
    patterns: Sequence[Rule] = tuple(map(pattern_rule, PATTERNS)),
    id_column: str = "page_id",
    url_column: str = "url",
    shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """`id_column`, `host`, `path`, `rule` (the site rule that fits, or null), `pattern` (the pattern that decides where
    none does, or null) and `verdict` for every row."""
    shards = in_shards([*sites, *patterns], shard_chars)
    narrow = with_text(pages, id_column, url_column).toDF("id", "url")
    narrow = narrow.withColumn("url", F.col("url").cast("string"))
    id_kind = narrow.schema["id"]
    texts = [T.StructField(name, T.StringType()) for name in _PARTS]
    parts = narrow.mapInArrow(_split, T.StructType([id_kind, *texts]))
    counts = token_counts(parts, [set().union(*[rule.literal_tokens() for _, rule in shard]) for shard in shards])
    numbers = [T.StructField(name, T.IntegerType()) for name in ("kind", "length")]
    found = T.StructType([id_kind, *texts, *numbers, *[T.StructField(n, T.StringType()) for n in ("name", "verdict")]])
    judged = parts.select("*", *[F.lit(v).cast(found[name].dataType).alias(name) for name, v in zip(_BEST, _NONE)])
    for shard in shards:
        judged = judged.mapInArrow(_shard_pass([(n, rule, rarest_token(rule, counts)) for n, rule in shard]), found)
    by_site = F.col("kind") == SITE
    return judged.select(
        F.col("id").alias(id_column),
        "host",
        "path",
        F.when(by_site, F.col("name")).alias("rule"),
        F.when(~by_site, F.col("name")).alias("pattern"),
        F.coalesce("verdict", F.lit(ALLOW)).alias("verdict"),
    )
