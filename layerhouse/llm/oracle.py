"""SQL equivalents, in DuckDB's dialect, of the queries that SQL can express."""

from __future__ import annotations

from layerhouse.llm.quality_rules import RULES, STOP_WORDS, SYMBOLS, Rule

BLANK = r"[\x20\x09-\x0D]"

EXACT_DEDUP = rf"""
WITH base AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '{BLANK}', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       text_sha256
FROM base WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
"""


def _passes(rule: Rule) -> str:
    value, scale = f"CAST({rule.measure} AS DOUBLE)", "1" if rule.per is None else rule.per
    bounds = [(">=", rule.least), ("<=", rule.most)]
    return " AND ".join(f"{value} {sign} CAST({b} AS DOUBLE) * {scale}" for sign, b in bounds if b is not None)


def quality_rules() -> str:
    stops = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    return rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
places AS (
  SELECT doc_id, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM base),
threes AS (
  SELECT doc_id, i, a, lead(a, 1) OVER w AS b, lead(a, 2) OVER w AS c FROM places WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS seen FROM threes WHERE c IS NOT NULL),
covered AS (
  SELECT doc_id, sum(least(3, coalesce(i - before, 3))) AS n FROM (
    SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM windows WHERE seen > 1) GROUP BY doc_id),
measured AS (
  SELECT base.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines,
         length(t) - length(replace(t, '!', '')) AS n_exclamations,
         length(regexp_replace(t, '\P{{L}}+', '', 'g')) AS n_letters,
         length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) AS n_upper,
         len(list_filter(words, lambda x: lower(x) IN ({stops}))) AS n_stop_words,
         len(list_filter(words, lambda x, i: i > 1 AND x = words[i - 1])) AS n_equal_neighbours,
         len(list_filter(lines, lambda x: ends_with(rtrim(x), '...') OR ends_with(rtrim(x), '…'))) AS n_ellipsis_lines,
         len(list_filter(lines, lambda x: regexp_matches(ltrim(x), '^[-*•]\s'))) AS n_bullet_lines
  FROM base LEFT JOIN covered ON base.doc_id = covered.doc_id),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(_passes(rule) for rule in RULES)} AS kept
FROM judged
"""


RANKED_SEARCH = r"""
WITH found AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents WHERE text IS NOT NULL),
counted AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY doc_id, term),
sized AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS terms FROM counted GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(terms) AS BIGINT) AS total FROM sized),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL),
weighed AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, whole WHERE term IN (SELECT term FROM asked) GROUP BY term, docs),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * terms * docs) // total)))) AS BIGINT) AS score
  FROM asked JOIN weighed USING (term) JOIN counted USING (term) JOIN sized USING (doc_id), whole
  GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 50
"""

NEAREST = """
WITH given AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
whole AS (
  SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda c: c * c))) AS length FROM given
  WHERE len(list_filter(v, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(v, lambda c: c <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v) / (q.length * c.length) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM pairs)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""
