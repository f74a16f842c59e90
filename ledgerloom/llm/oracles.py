"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from ledgerloom.llm import line_rules, url_rules
from ledgerloom.llm.queries import SITE_RULES

ORACLES: dict[str, str] = {}

# Every pair compared, groups by following links.
ORACLES["op7_collisions"] = """
WITH RECURSIVE usable AS (
    SELECT row_number() OVER () AS n, vec_id, CAST(embedding AS DOUBLE[]) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS u, b.vec_id AS v
    FROM usable a JOIN usable b ON a.n <> b.n AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.9
),
reached(u, v) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT r.u, l.v FROM reached r JOIN links l ON l.u = r.v
),
groups AS (SELECT u, min(v) AS component_id FROM reached GROUP BY u),
counted AS (SELECT u, count(*) AS n_links FROM links GROUP BY u)
SELECT e.vec_id, CAST(coalesce(c.n_links, 0) AS BIGINT) AS n_links, g.component_id,
       coalesce(e.vec_id = g.component_id, false) AS kept
FROM embeddings e
LEFT JOIN counted c ON c.u = e.vec_id
LEFT JOIN groups g ON g.u = e.vec_id
"""


def _listed(values) -> str:
    return ", ".join("'" + value.replace("'", "''") + "'" for value in values)


# Lines and words as rows; every rule of the operator over them.
ORACLES["op9_line_rules"] = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
lines AS (
    SELECT r, i, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w
    FROM (SELECT r, unnest(string_split(t, chr(10))) AS line,
                 generate_subscripts(string_split(t, chr(10)), 1) AS i FROM docs)
),
judged AS (
    SELECT r, i, line, w, CASE
        WHEN len(list_filter(w, lambda x: x IN ({_listed(sorted(line_rules.SEPARATOR_TEXTS))})))
             >= {line_rules.SEPARATOR_SHARE} * len(w) THEN 'navigation'
        WHEN regexp_matches(line, '(?i){"|".join(line_rules.PHRASES)}') THEN 'boilerplate'
        WHEN len(w) > 1 AND length(line) - length(regexp_replace(line, '[!-/:-@\[-`{{-~]', '', 'g'))
             >= {line_rules.MARKS_PER_WORD} * len(w) THEN 'marks'
        WHEN len(w) >= {line_rules.REPEAT_WORDS}
             AND list_max(map_values(list_aggregate(w, 'histogram'))) >= {line_rules.REPEAT_SHARE} * len(w)
            THEN 'repeated'
        WHEN len(list_filter(w, lambda x: right(x, 1) IN ({_listed(line_rules.SENTENCE_ENDS)}))) = 0 THEN 'punctuation'
        END AS rule
    FROM lines WHERE len(w) > 0
),
per_line AS (
    SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines,
           {", ".join(f"count(*) FILTER (rule = '{rule}') AS lines_{rule}" for rule in line_rules.RULES)},
           coalesce(sum(length(array_to_string(w, ''))) FILTER (rule IS NULL), 0) AS kept_chars
    FROM judged GROUP BY r
),
words AS (
    SELECT r, x, row_number() OVER (PARTITION BY r ORDER BY i, p) AS p
    FROM (SELECT r, i, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM judged)
),
windows AS (
    SELECT r, p, x, lead(x) OVER (PARTITION BY r ORDER BY p) AS y, lead(x, 2) OVER (PARTITION BY r ORDER BY p) AS z
    FROM words
),
again AS (
    SELECT r, p FROM (SELECT r, p, z, count(*) OVER (PARTITION BY r, x, y, z) AS c FROM windows) WHERE c > 1 AND z IS NOT NULL
),
inside AS (SELECT r, count(DISTINCT p + d) AS n_repeat_words FROM again, (VALUES (0), (1), (2)) AS v(d) GROUP BY r),
sizes AS (SELECT r, count(*) AS n_words, sum(length(x)) AS word_chars FROM words GROUP BY r),
counted AS (
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
           coalesce(kept_chars, 0) AS kept_chars,
           {", ".join(f"coalesce(lines_{rule}, 0) AS lines_{rule}" for rule in line_rules.RULES)}
    FROM docs LEFT JOIN per_line USING (r) LEFT JOIN inside USING (r) LEFT JOIN sizes USING (r)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(kept_chars AS BIGINT) AS kept_chars,
       {", ".join(f"CAST(lines_{rule} AS BIGINT) AS lines_{rule}" for rule in line_rules.RULES)},
       n_words < {line_rules.MIN_WORDS} OR 100 * n_repeat_words > {line_rules.MAX_REPEAT_PERCENT} * n_words
         AS base_failed,
       n_words >= {line_rules.MIN_WORDS} AND 100 * n_repeat_words <= {line_rules.MAX_REPEAT_PERCENT} * n_words
         AND kept_chars >= {line_rules.KEEP_SHARE} * word_chars AS kept
FROM counted
"""


def _site_cases(outcome: str) -> str:
    """Site rules as comparisons of host and path, the longest first."""
    longest_first = sorted(SITE_RULES, key=lambda rule: -len(rule[1] + rule[2]))
    return "\n".join(
        f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') "
        f"THEN '{verdict if outcome == 'verdict' else host + path}'"
        for verdict, host, path in longest_first
    )


def _pattern_cases(outcome: str) -> str:
    """Patterns tried one after the other on every URL."""
    rules = sorted(map(url_rules.pattern_rule, url_rules.PATTERNS), key=lambda rule: (-rule.kind, -len(rule.name)))
    return "\n".join(
        f"WHEN regexp_matches({'alone' if rule.host_only else 'whole'}, '{rule.regex(chr(92) + 'z')}') "
        f"THEN '{rule.verdict if outcome == 'verdict' else rule.name}'"
        for rule in rules
    )


ORACLES["op11_url_rules"] = rf"""
WITH rest AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rest),
tails AS (SELECT page_id, raw, substr(rest, length(raw) + 1) AS tail FROM hosts),
paths AS (
    SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(tail, '^[^?#]*') AS path, tail
    FROM tails
),
subjects AS (
    SELECT page_id, host, path, host <> '' OR path <> '' AS named, '//' || host || tail AS whole, '//' || host || '/' AS alone
    FROM paths
),
sited AS (
    SELECT *, CASE {_site_cases("rule")} END AS rule, CASE {_site_cases("verdict")} END AS site_verdict FROM subjects
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IS NULL AND named THEN CASE {_pattern_cases("pattern")} END END AS pattern,
       CASE WHEN rule IS NOT NULL THEN site_verdict WHEN named THEN CASE {_pattern_cases("verdict")} ELSE 'allow' END
            ELSE 'allow' END AS verdict
FROM sited
"""


def _fields(n_chars: str) -> str:
    """The fields of a leaf, each with its length in bytes in front."""
    values = ("doc_id", "source", "lang", n_chars, "text")
    texts = [f"CAST({value} AS VARCHAR)" for value in values]
    return " || ".join(f"coalesce(strlen({text}) || ':' || {text}, '-')" for text in texts)


# Trees by recursion over whole levels; a proof joins each leaf with the other node of its pair on every level.
ORACLES["op12_merkle"] = rf"""
WITH RECURSIVE crc_table AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)),
                              lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) r(i)
    )
),
leaves AS (
    SELECT row_number() OVER () AS r, doc_id, lang, sha256({_fields("n_chars")}) AS leaf,
           sha256({_fields("(CAST(n_chars AS HUGEINT) + 1)")}) AS altered,
           xor(list_reduce(
               list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                                       lambda x: CAST(ascii(x) AS BIGINT))),
               lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS crc
    FROM documents, crc_table
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
           count(*) OVER (PARTITION BY lang) AS n,
           dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g
    FROM leaves
),
nodes(g, level, p, h, n) AS (
    SELECT g, 0, p, leaf, n FROM placed
    UNION ALL
    SELECT g, level + 1, p // 2, sha256(string_agg(h, '' ORDER BY p)), (n + 1) // 2
    FROM nodes WHERE n > 1 GROUP BY g, level, p // 2, n
),
subroots AS (SELECT g, h AS subroot, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(level, p, h, n) AS (
    SELECT 0, g, subroot, n FROM subroots
    UNION ALL
    SELECT level + 1, p // 2, sha256(string_agg(h, '' ORDER BY p)), (n + 1) // 2
    FROM tops WHERE n > 1 GROUP BY level, p // 2, n
),
steps AS (
    SELECT r, 0 AS part, l.level, (placed.p >> l.level) & 1 AS d, x.h
    FROM placed JOIN (SELECT DISTINCT g, level FROM nodes WHERE n > 1) l USING (g)
    LEFT JOIN nodes x ON x.g = placed.g AND x.level = l.level AND x.p = xor(placed.p >> l.level, 1)
    UNION ALL
    SELECT r, 1, l.level, (placed.g >> l.level) & 1, x.h
    FROM placed CROSS JOIN (SELECT DISTINCT level FROM tops WHERE n > 1) l
    LEFT JOIN tops x ON x.level = l.level AND x.p = xor(placed.g >> l.level, 1)
),
paths AS (
    SELECT r, list({{'d': d, 'h': coalesce(h, '')}} ORDER BY part, level) AS path,
           string_agg(coalesce(h, ''), '' ORDER BY part, level) AS proof
    FROM steps GROUP BY r
),
folded AS (
    SELECT r, coalesce(proof, '') AS proof,
           list_reduce(
               list_prepend({{'d': CAST(0 AS BIGINT), 'h': CASE WHEN crc % 7 = 0 THEN altered ELSE leaf END}},
                            coalesce(path, [])),
               lambda a, x: {{'d': x.d, 'h': sha256(CASE WHEN x.d = 0 THEN a.h || x.h ELSE x.h || a.h END)}}).h AS folded_root
    FROM placed LEFT JOIN paths USING (r)
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN folded USING (r) JOIN subroots USING (g), (SELECT h AS root FROM tops WHERE n = 1)
"""
