"""DuckDB SQL of the queries whose result takes more than a few joins to state.

``url_sql()`` states rules, host levels, priors and posterior bounds level by level;
``CONVERSATION_REPAIR`` finds the least repair by going through the rows with the best (cost, edits)
per state, so without the operator's search; ``pii()`` scans with the plain patterns and scores the
pattern graph over texts instead of hashes.
"""

from __future__ import annotations

from driftgate.llm import contextual_pii as pii, host_reputation as hosts

CONVERSATION_REPAIR = """
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
-- CRC-32, bit by bit: a byte is mixed in, then eight steps (-1) follow
crc AS (
  SELECT *, xor(list_reduce(
    list_concat([4294967295::BIGINT], flatten(list_transform(string_split(k, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) % 20 AS hit
  FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN hit = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM crc WHERE hit <> 0),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM damaged),
rows_ AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), nth) AS i,
         CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' END AS fault
  FROM seen),
moves(p, given, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
inserts(p, q, edits) AS (
  VALUES (0, 0, ''), (0, 2, 'I'), (0, 3, 'II'), (1, 1, ''), (1, 2, 'I'), (1, 3, 'II'),
         (2, 2, ''), (2, 3, 'I'), (2, 2, 'II'), (3, 3, ''), (3, 2, 'I'), (3, 3, 'II')),
ids AS (SELECT DISTINCT conv_id FROM conversations),
way AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, {'c': 0::BIGINT, 'e': ''} AS best FROM ids
  UNION ALL
  SELECT w.conv_id, r.i, o.q, min({'c': w.best.c + 3 * len(n.edits) + o.c + CASE WHEN o.e <> 'D' AND r.fault = 'truncated' THEN 3 ELSE 0 END, 'e': w.best.e || n.edits || o.e})
  FROM way w JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1 JOIN inserts n ON n.p = w.state
  JOIN (SELECT DISTINCT p, 'D' AS e, '' AS given, p AS q, 4 AS c FROM moves
        UNION ALL SELECT p, 'K', given, q, 0 FROM moves
        UNION ALL SELECT p, 'R', given, q, 3 FROM moves WHERE given <> 's') o
    ON o.p = n.q AND (o.e = 'D' OR coalesce(r.fault, '') NOT IN ('blank', 'duplicate') AND (o.e = 'R' OR o.given = r.initial))
  GROUP BY w.conv_id, r.i, o.q),
size AS (SELECT conv_id, max(i) AS n FROM way GROUP BY conv_id),
best AS (
  SELECT w.conv_id, min({'c': w.best.c + 3 * len(n.edits), 'e': w.best.e || n.edits}) AS b
  FROM way w JOIN size s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.n = w.i JOIN inserts n ON n.p = w.state AND n.q IN (0, 3)
  GROUP BY w.conv_id),
edits AS (SELECT conv_id, unnest(string_split(b.e, '')) AS e, unnest(generate_series(1, len(b.e))) AS k FROM best WHERE b.e <> ''),
placed AS (SELECT *, sum(CASE WHEN e = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY k) AS i FROM edits),
kept AS (
  SELECT p.conv_id, p.k, p.e, r.role, r.text, r.initial, row_number() OVER (PARTITION BY p.conv_id ORDER BY p.k) AS nth
  FROM placed p LEFT JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i AND p.e <> 'I' WHERE p.e <> 'D'),
led AS (SELECT *, max(CASE WHEN nth = 1 AND e = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS lead FROM kept),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (nth - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY k) AS t
  FROM led GROUP BY conv_id),
pairs AS (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM rows_),
counts AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM pairs GROUP BY conv_id)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, b.c AS cost, b.e AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM ids JOIN best ON best.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN repaired ON repaired.conv_id IS NOT DISTINCT FROM ids.conv_id
"""

# The contract's patterns as they are written there, then the candidates.
_PLAIN = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
    r"[^\x20\x09-\x0D0-9]*[0-9][^\x20\x09-\x0D]*",
)


def _scans() -> str:
    return "\n  UNION ALL ".join(
        f"SELECT r, doc_id, {k} AS kind, unnest(string_split_regex(t, '{p}')) AS gap, unnest(regexp_extract_all(t, '{p}')) AS hit,"
        f" unnest(generate_series(1, len(string_split_regex(t, '{p}')))) AS pos FROM d"
        for k, p in enumerate(_PLAIN)
    )


def _words(part: str) -> str:
    return (
        f"list_transform(list_filter(string_split_regex(translate({part}, '{pii.UPPER}', '{pii.LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''),"
        " lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '#' ELSE w END)"
    )


def _rounds(rounds: int) -> str:
    out = []
    for i in range(rounds):
        points = "SELECT pattern, kind, points FROM seeds"
        if i:
            points += f" UNION ALL SELECT pattern, s.kind, score FROM edges e JOIN scored{i - 1} s ON s.value = e.value WHERE e.kind = 4"
        out.append(
            f"strong{i} AS (SELECT pattern, kind, (sum(points) // (any_value(n) + 1))::BIGINT AS confidence FROM ({points}) JOIN sizes USING (pattern)"
            f" GROUP BY pattern, kind HAVING sum(points) >= {pii.SUPPORT * 1_000_000} AND sum(points) // (any_value(n) + 1) >= {int(pii.CONFIDENCE * 1_000_000)}),\n"
            f"scored{i} AS (SELECT value, kind, floor((1.0::DOUBLE - exp(-sum(w)::DOUBLE / 1000000.0::DOUBLE)) * 1000000)::BIGINT AS score FROM ("
            f"SELECT e.value, s.kind, round(-ln(1.0::DOUBLE - s.confidence::DOUBLE / 1000000.0::DOUBLE) * 1000000)::BIGINT AS w"
            f" FROM edges e JOIN strong{i} s USING (pattern) WHERE e.kind = 4) GROUP BY value, kind)"
        )
    return ",\n".join(out)


def pii_sql(rounds: int = pii.ROUNDS) -> str:
    marks = pii.PUNCTUATION.replace("'", "''")
    names = "[" + ", ".join(f"'{k}'" for k in pii.KINDS) + "]"
    listed = f"{names}[kind + 1] || ':' || start || ':' || stop, ',' ORDER BY kind, start"
    counts = ", ".join(f"count(*) FILTER (base AND kind = {k}) AS n_{name}" for k, name in enumerate(pii.KINDS))
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
scan AS MATERIALIZED (
  {_scans()}),
placed AS (
  SELECT r, doc_id, kind, pos, hit, (sum(length(gap) + coalesce(length(hit), 0)) OVER w)::BIGINT AS stop,
         list_reverse({_words(f"right(gap, {pii.CONTEXT})")})[1:2] AS tail, CASE WHEN row_number() OVER w = 1 THEN '^' ELSE '#' END AS border,
         lead({_words(f"left(gap, {pii.CONTEXT})")}[1]) OVER w AS head, lead(hit) OVER w IS NULL AS last
  FROM scan WINDOW w AS (PARTITION BY r, kind ORDER BY pos)),
hits AS (
  SELECT *, coalesce(tail[1], border) AS w1, coalesce(tail[2], CASE WHEN len(tail) = 0 THEN '' ELSE border END) AS w2,
         coalesce(head, CASE WHEN last THEN '^' ELSE '#' END) AS behind,
         stop - length(CASE WHEN kind = 4 THEN ltrim(hit, '{marks}') ELSE hit END) AS start,
         translate(CASE WHEN kind = 4 THEN rtrim(ltrim(hit, '{marks}'), '{marks}') ELSE hit END, '{pii.UPPER}', '{pii.LOWER}') AS value
  FROM placed WHERE hit IS NOT NULL),
checked AS (
  SELECT r, doc_id, kind, start, CASE WHEN kind = 4 THEN start + length(value) ELSE stop END AS stop, value,
         ['1' || w1, '2' || w2 || chr(31) || w1, '3' || w1 || chr(31) || behind] AS patterns
  FROM (SELECT *, regexp_replace(value, '[^0-9]', '', 'g') AS digits FROM hits)
  WHERE CASE kind
    WHEN 0 THEN true
    WHEN 1 THEN len(list_filter(string_split(hit, '.'), lambda p: length(ltrim(p, '0')) > 3 OR ('0' || left(ltrim(p, '0'), 3))::INT > {pii.MAX_PART})) = 0
    WHEN 2 THEN length(digits) BETWEEN {pii.CARD_DIGITS[0]} AND {pii.CARD_DIGITS[1]} AND list_sum(list_transform(
      string_split(reverse(digits), ''), lambda c, i: CASE WHEN i % 2 = 1 THEN c::INT WHEN c::INT > 4 THEN 2 * c::INT - 9 ELSE 2 * c::INT END)) % 10 = 0
    WHEN 3 THEN length(digits) BETWEEN {pii.PHONE_DIGITS[0]} AND {pii.PHONE_DIGITS[1]}
    ELSE length(value) >= {pii.MIN_LENGTH} AND length(digits) >= {pii.MIN_DIGITS} END),
found AS MATERIALIZED (
  SELECT * FROM checked c WHERE kind < 4 OR NOT EXISTS (SELECT 1 FROM checked b WHERE b.r = c.r AND b.kind < 4 AND b.start < c.stop AND b.stop > c.start)),
edges AS (SELECT DISTINCT pattern, kind, value FROM (SELECT unnest(patterns) AS pattern, kind, value FROM found)),
sizes AS (SELECT pattern, count(*) AS n FROM edges GROUP BY pattern),
seeds AS (SELECT pattern, kind, count(*) * 1000000 AS points FROM edges WHERE kind < 4 GROUP BY pattern, kind),
{_rounds(rounds)},
accepted AS (SELECT value, arg_max(kind, [score, -kind]) AS kind FROM scored{rounds - 1} WHERE score >= {int(pii.ACCEPT * 1_000_000)} GROUP BY value),
new AS (
  SELECT DISTINCT r, a.kind, start, stop FROM (SELECT *, unnest(patterns) AS pattern FROM found WHERE kind = 4) f
  JOIN accepted a USING (value) JOIN strong{rounds - 1} s ON s.pattern = f.pattern AND s.kind = a.kind),
spans AS (SELECT r, kind, start, stop, true AS base FROM found WHERE kind < 4 UNION ALL SELECT r, kind, start, stop, false FROM new),
listed AS (
  SELECT r, {counts}, count(*) FILTER (NOT base) AS n_found, string_agg({listed}) FILTER (base) AS b, string_agg({listed}) AS s
  FROM spans GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in pii.KINDS)}, sha256(coalesce(b, '')) AS base_sha256, coalesce(s, '') AS spans,
       coalesce(n_found, 0) AS n_found
FROM d LEFT JOIN listed USING (r)
"""


def _strength(groups: str) -> str:
    """The strength of a level's prior, as one number."""
    return f"""(
  SELECT CASE WHEN coalesce(w, 0) = 0 OR s <= c THEN {hosts.MAX_STRENGTH}::DOUBLE
              ELSE least({hosts.MAX_STRENGTH}::DOUBLE, greatest({hosts.MIN_STRENGTH}::DOUBLE, w / (s - c) - 1.0::DOUBLE)) END
  FROM (SELECT sum((bad - n * prior) * (bad - n * prior)) AS s, sum(n * prior * (1 - prior)) AS c, sum(n * (n - 1) * prior * (1 - prior)) AS w FROM {groups}))"""


def url_sql(pages: str = "pages", bad: str = "CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 0 END") -> str:
    """Of the query over ``labels``, whose outcome is ``bad``."""
    rules = sorted(hosts.RULES, key=lambda r: (-len(r[0] + r[1]), r))
    fits = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN" for h, p, _ in rules]
    name = " ".join(f"{f} '{h}{p}'" for f, (h, p, _) in zip(fits, rules, strict=True))
    verdict = " ".join(f"{f} '{v}'" for f, (_, _, v) in zip(fits, rules, strict=True))
    listed = ", ".join(f"'{x}'" for x in hosts.SUFFIXES)
    return f"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM {pages}),
cut AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM parts),
urls AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM cut),
truth AS (SELECT doc_id AS page_id, max({bad}) AS bad FROM labels GROUP BY doc_id),
counted AS (
  SELECT host, count(t.bad) AS n, coalesce(sum(t.bad), 0)::BIGINT AS bad, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), '\\.*(:[0-9]*)?$', ''), '.') AS l
  FROM urls LEFT JOIN truth t USING (page_id) GROUP BY host),
-- how many labels the suffix has; 0: an address
sized AS (
  SELECT *, CASE WHEN regexp_matches(array_to_string(l, '.'), '^([0-9]{{1,3}}\\.){{3}}[0-9]{{1,3}}$') OR starts_with(l[1], '[') THEN 0
                 WHEN array_to_string(l[-4:], '.') IN ({listed}) THEN least(4, len(l)) WHEN array_to_string(l[-3:], '.') IN ({listed}) THEN least(3, len(l))
                 WHEN array_to_string(l[-2:], '.') IN ({listed}) THEN least(2, len(l))
                 WHEN len(l) > 2 AND l[-3] <> '' AND list_contains({list(hosts.SECOND_LEVEL)}, l[-2]) AND regexp_full_match(l[-1], '[a-z]{{2}}') THEN 2
                 ELSE 1 END AS k
  FROM counted),
leveled AS (
  SELECT host, n, bad, CASE WHEN k = 0 THEN '{hosts.ADDRESS}' ELSE array_to_string(l[-k:], '.') END AS suffix,
         CASE WHEN k = 0 THEN array_to_string(l, '.') ELSE array_to_string(l[-least(len(l), k + 1):], '.') END AS domain
  FROM sized),
total AS (SELECT (sum(bad) + 0.5::DOUBLE) / (sum(n) + 1.0::DOUBLE) AS mean FROM leveled HAVING sum(n) > 0),
s0 AS (SELECT suffix, any_value(mean) AS prior, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad FROM leveled, total GROUP BY suffix),
s1 AS (SELECT suffix, (bad + k * prior) / (n + k) AS prior FROM s0, (SELECT {_strength("s0")} AS k)),
d0 AS (
  SELECT domain, any_value(s1.prior) AS prior, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad
  FROM leveled JOIN s1 USING (suffix) GROUP BY suffix, domain),
d1 AS (SELECT domain, (bad + k * prior) / (n + k) AS prior FROM d0, (SELECT {_strength("d0")} AS k)),
h0 AS (SELECT host, n::DOUBLE AS n, bad::DOUBLE AS bad, prior FROM leveled JOIN d1 USING (domain)),
post AS (SELECT host, n, bad + k * prior AS a, n - bad + k * (1 - prior) AS b FROM h0, (SELECT {_strength("h0")} AS k)),
bounds AS (SELECT host, n, greatest(0.0::DOUBLE, a / (a + b) - {hosts.BOUND_Z}::DOUBLE * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))) AS bound FROM post)
SELECT page_id, host, path, CASE {name} END AS rule,
       coalesce(CASE {verdict} END, CASE WHEN bound > {hosts.MAX_BAD_RATE}::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(n, 0)::BIGINT AS host_labels, round(coalesce(bound, 0.0::DOUBLE), 6) AS bad_rate_bound
FROM urls LEFT JOIN bounds USING (host)
"""
