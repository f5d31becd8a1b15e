"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from ordermart.llm import mixing
from ordermart.llm.line_dedup import MIN_CHARS, MIN_DOCS
from ordermart.llm.quality_rules import (
    CAPITALS, MAX_REPEAT_PERCENT, MEASURES, MIN_GROUP, MIN_WORDS, REPEAT_WINDOW, SPREAD, SYMBOLS)
from ordermart.llm.substring_dedup import WINDOW
from ordermart.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"

SUBSTRING = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
win AS (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW} + 2)) AS i FROM d),
ranked AS (SELECT doc_id, i, row_number() OVER (
    PARTITION BY array_to_string(w[i:i + {WINDOW - 1}], ' ') ORDER BY doc_id, i) AS n FROM win),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM ranked WHERE n > 1),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
         FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

NEAR = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{CAPITALS.lower()}'), '{_WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS k
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE 100 * common >= 85 * (x.n + y.n - common)),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""


def _fences(level: str, by: str) -> str:
    """Fences of one level of groups, as CTEs ending in ``level``(by..., measure, fence)."""
    keys = f"{by}, " if by else ""
    return f"""
{level}_cum AS (SELECT {keys}measure, value, sum(count(*)) OVER (PARTITION BY {keys}measure ORDER BY value) AS upto,
    sum(count(*)) OVER (PARTITION BY {keys}measure) AS total FROM v GROUP BY {keys}measure, value),
{level} AS (SELECT {keys}measure, min(value) FILTER (WHERE 4 * upto >= 3 * total) AS q75,
    min(value) FILTER (WHERE 4 * upto >= total) AS q25, max(total) AS total FROM {level}_cum GROUP BY {keys}measure
    HAVING max(total) >= {MIN_GROUP})"""


_PER = {"symbols_pm": ("n_symbols", "word_chars", 1000), "capitals_pm": ("n_capitals", "word_chars", 1000),
        "word_tenths": ("word_chars", "n_words", 10), "dup_lines_pm": ("n_dup_lines", "n_lines", 1000),
        "repeats_pm": ("n_repeat_words", "n_words", 1000)}
_W = REPEAT_WINDOW
_FENCE = " ".join(f"WHEN '{m}' THEN {slack}" for m, (slack, _) in MEASURES.items())
_TOP = " ".join(f"WHEN '{m}' THEN {top}" for m, (_, top) in MEASURES.items())

RULES = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
lines AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l FROM d),
win AS (SELECT doc_id, w, unnest(range(1, len(w) - {_W} + 2)) AS i FROM d),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (
    PARTITION BY doc_id, array_to_string(w[i:i + {_W - 1}], ' ')) AS c FROM win) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + {_W})) AS p FROM twice) GROUP BY doc_id),
m AS (SELECT doc_id, lang, source, len(w) AS n_words,
    CAST(length(regexp_replace(t, '{_SPACE}+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    CAST(length(t) - length(translate(t, '{CAPITALS}', '')) AS BIGINT) AS n_capitals,
    len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM d JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m),
raw AS ({" UNION ALL ".join(
    f"SELECT doc_id, lang, source, base_failed, '{name}' AS measure, {scale} * {a} // greatest({b}, 1) AS value FROM b"
    for name, (a, b, scale) in _PER.items())}),
v AS (SELECT lang, source, measure, least(value, CASE measure {_TOP} END) AS value FROM raw WHERE NOT base_failed),{
_fences("own", "lang, source")},{_fences("by_lang", "lang")},{_fences("corpus", "")},
over_any AS (SELECT DISTINCT raw.doc_id FROM raw
  LEFT JOIN own USING (lang, source, measure) LEFT JOIN by_lang USING (lang, measure) LEFT JOIN corpus USING (measure)
  WHERE value > coalesce(own.q75 + {SPREAD} * (own.q75 - own.q25), by_lang.q75 + {SPREAD} * (by_lang.q75 - by_lang.q25),
                         corpus.q75 + {SPREAD} * (corpus.q75 - corpus.q25)) + CASE measure {_FENCE} END)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM over_any) AS kept
FROM b
"""

LINES = rf"""
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
x AS (SELECT doc_id, line, i, translate(regexp_replace(line, '^{_SPACE}+|{_SPACE}+$', '', 'g'), '{CAPITALS}', '{CAPITALS.lower()}') AS k
      FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM l)),
gone AS (SELECT k, max(doc_id) AS keeper FROM x WHERE length(k) >= {MIN_CHARS} GROUP BY k HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
kept AS (SELECT x.doc_id, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n FROM x LEFT JOIN gone USING (k)
         WHERE keeper IS NULL OR keeper = x.doc_id GROUP BY x.doc_id)
SELECT l.doc_id, len(lines) AS n_lines, len(lines) - coalesce(kept.n, 0) AS n_dropped, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM l LEFT JOIN kept USING (doc_id)
"""



def _codes() -> str:
    """Product codes: a codebook after the other, parts against all entries."""
    assign = """nearest{r} AS (SELECT vec_id, label, p, v, arg_min(k, (d, k)) AS k, min(d) AS d FROM (
  SELECT parts.*, book{r}.k, list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - book{r}.c[i]) * (v[i] - book{r}.c[i])))::BIGINT AS d
  FROM parts JOIN book{r} USING (p)) GROUP BY vec_id, label, p, v)"""
    move = """sums{r} AS (SELECT p, k, i, CAST(floor(sum(v[i]) / count(*)) AS BIGINT) AS m
  FROM (SELECT p, k, v, unnest(range(1, len(v) + 1)) AS i FROM nearest{r}) GROUP BY p, k, i),
book{s} AS (SELECT p, k, coalesce(m.c, book{r}.c) AS c
  FROM book{r} LEFT JOIN (SELECT p, k, list(m ORDER BY i) AS c FROM sums{r} GROUP BY p, k) m USING (p, k))"""
    steps = [x for r in range(ROUNDS) for x in (assign.format(r=r), move.format(r=r, s=r + 1))]
    return f"""
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(x * {SCALE}) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, label, p, v[p * (len(v) // {PARTS}) + 1:(p + 1) * (len(v) // {PARTS})] AS v
  FROM (SELECT *, unnest(range({PARTS})) AS p FROM e)),
book0 AS (SELECT p, k, v AS c FROM parts JOIN (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM e ORDER BY vec_id LIMIT {ENTRIES}) USING (vec_id)),
{", ".join(steps)},
{assign.format(r=ROUNDS)},
coded AS (SELECT vec_id, label, string_agg(lpad(printf('%x', k), 2, '0'), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM nearest{ROUNDS} GROUP BY vec_id, label),
hashed AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, k)) AS h FROM book{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM coded, hashed
"""

TURNS = r"""
WITH RECURSIVE keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
kinds AS (SELECT *, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
    list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, i, 1)) AS BIGINT))),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [CAST(0 AS BIGINT) FOR z IN range(8)]),
      lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) % 20 AS kind FROM keyed),
damaged AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
marked AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS empty,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS open, substr(role, 1, 1) AS sign,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM ordered),
r AS (SELECT *, empty OR again AS forced, NOT empty AND NOT again AND open AS cut FROM marked),
stats AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE empty) AS blank,
    count(*) FILTER (WHERE again AND NOT empty) AS duplicate, count(*) FILTER (WHERE cut) AS truncated,
    count(*) FILTER (WHERE before IS NOT NULL AND before || sign NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM r GROUP BY conv_id),
added(top, mid, n, roles) AS (VALUES
    (0, 0, 0, []), (0, 2, 1, ['user:']), (0, 3, 2, ['user:', 'assistant:']), (1, 1, 0, []), (1, 2, 1, ['user:']),
    (1, 3, 2, ['user:', 'assistant:']), (2, 2, 0, []), (2, 3, 1, ['assistant:']), (3, 3, 0, []), (3, 2, 1, ['user:'])),
shift(mid, sign, top) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
edits AS (
  SELECT conv_id, i, mid, mid AS top, 4 AS cost, 'D' AS letter, CAST([] AS VARCHAR[]) AS line FROM r, (SELECT DISTINCT mid FROM added)
  UNION ALL SELECT conv_id, i, mid, top, 3 * cut::INT, 'K', [role || ':' || text] FROM r JOIN shift USING (sign) WHERE NOT forced
  UNION ALL SELECT conv_id, i, mid, top, 3 + 3 * cut::INT, 'R', [CASE shift.sign WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text]
    FROM r, shift WHERE NOT forced AND shift.sign IN ('u', 'a')),
run AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS top, {'cost': 0, 'audit': '', 'lines': CAST([] AS VARCHAR[])} AS best FROM stats
  UNION ALL
  SELECT run.conv_id, edits.i, edits.top, min({'cost': best.cost + 3 * n + edits.cost, 'audit': best.audit || repeat('I', n) || letter,
      'lines': list_concat(best.lines, roles, line)})
  FROM run JOIN added ON run.top = added.top JOIN edits ON edits.conv_id = run.conv_id AND edits.i = run.i + 1 AND edits.mid = added.mid
  GROUP BY run.conv_id, edits.i, edits.top),
ended AS (SELECT conv_id, min({'cost': best.cost + 3 * added.n, 'audit': best.audit || repeat('I', added.n), 'lines': list_concat(best.lines, roles)}) AS best
  FROM run JOIN stats USING (conv_id) JOIN added ON run.top = added.top WHERE run.i = stats.n AND added.mid IN (0, 3) GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN stats USING (conv_id) LEFT JOIN ended USING (conv_id)
"""

ORACLE = {"op1_substring_dedup": SUBSTRING, "op5_source_mixing": mixing.ORACLE, "op7_minhash_near_dedup": NEAR,
          "op10_quality_rules": RULES, "op11_line_dedup": LINES,
          "op12_turn_repair": TURNS, "op13_vector_codes": _codes()}
