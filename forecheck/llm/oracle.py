"""DuckDB SQL for the queries that SQL can express on whole tables.

Written from the rules, not from the Spark plans: windows are grouped, joined or
compared directly instead of going through suffix arrays, postings or sweeps.
"""

from __future__ import annotations

from forecheck.llm import chat_format, hard_negatives, lexical_search, repetition, url_rules

_WORDS = r"[^\x20\x09-\x0D]+"


def _covered(length: int) -> str:
    """Words of each text inside windows of ``length`` words found twice or more."""
    return f"""
    (SELECT doc_id, count(DISTINCT p) AS covered FROM (
       SELECT doc_id, unnest(range(i, i + {length})) AS p FROM (
         SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS times FROM (
           SELECT doc_id, i, list_slice(words, i, i + {length} - 1)::VARCHAR[] AS win
           FROM (SELECT doc_id, words, unnest(range(1, len(words) - {length} + 2)) AS i FROM w)))
       WHERE times > 1) GROUP BY doc_id)"""


OP1_REPETITION = f"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS words FROM documents),
lines AS (
  SELECT doc_id, sum(n - 1)::BIGINT AS n_dup_lines FROM (
    SELECT doc_id, line, count(*) AS n
    FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w)
    WHERE regexp_matches(line, '{_WORDS}') GROUP BY doc_id, line) GROUP BY doc_id),
longest AS (
  -- repeats longer than the limit exist exactly when a window one word longer does
  SELECT doc_id, covered > 0 AS too_long FROM {_covered(repetition.MAX_LONGEST + 1)}),
counts AS (
  SELECT w.doc_id, len(words) AS n_words,
         length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(b.covered, 0) AS n_repeat_words,
         coalesce(c.covered, 0) AS n_covered_words,
         coalesce(too_long, false) AS too_long
  FROM w LEFT JOIN lines USING (doc_id)
  LEFT JOIN {_covered(repetition.BASE_WINDOW)} b USING (doc_id)
  LEFT JOIN {_covered(repetition.MIN_REPEAT)} c USING (doc_id)
  LEFT JOIN longest USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, n_covered_words::BIGINT AS n_covered_words,
       (n_words < {repetition.MIN_WORDS}
        OR 100 * n_repeat_words > {repetition.BASE_PERCENT} * n_words) AS base_failed,
       NOT (n_words < {repetition.MIN_WORDS}
            OR 100 * n_repeat_words > {repetition.BASE_PERCENT} * n_words)
         AND 100 * n_covered_words <= {repetition.MAX_COVERED} * n_words
         AND NOT too_long AS kept
FROM counts
"""

_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

OP9_WARC = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes,
         sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex, payload_bytes) AS last,
         array_to_string([right('0000' || bin(('0x' || hex[i])::INT), 4)
                          for i in range(1, 41)], '') AS b FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string([substr('{_B32}', 1 + list_sum([substr(b, 5 * k + j + 1, 1)::INT * (16 >> j)
                                                       for j in range(5)])::INT, 1)
                        for k in range(32)], '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM bits
"""


def _rule_rows() -> str:
    return ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_rules.RULES)


OP10_URL_RULES = rf"""
WITH rules(h, p, v) AS (VALUES {_rule_rows()}),
urls AS (
  SELECT page_id, row_number() OVER () AS id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM urls),
fits AS (
  SELECT id, h || p AS rule, v,
         row_number() OVER (PARTITION BY id ORDER BY length(h) + length(p) DESC) AS place
  FROM parts JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, '{url_rules.DEFAULT_VERDICT}') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (id)
"""

OP4_CHAT_FORMAT = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{chat_format.PROBE}'), (-1, 1, 'assistant', '{chat_format.PROBE}')),
m AS (
  SELECT *, contains(text, '{chat_format.START}') OR contains(text, '{chat_format.END}')
            OR regexp_matches(text, '<\\+\|') AS clash FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum({len(chat_format.START) + len(chat_format.END) + 2} + length(role) + length(
           CASE WHEN clash THEN regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') ELSE text END)
       )::BIGINT AS formatted_chars,
       sum(clash::INT)::BIGINT AS n_escaped
FROM m GROUP BY conv_id
"""

_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP2_DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), {_FOLD}), '{_TERM}') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_FOLD}), '{_TERM}') AS w
  FROM benchmark),
items AS (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
wins AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM items)),
sizes AS (SELECT DISTINCT n FROM wins),
spots AS (
  SELECT r, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d CROSS JOIN sizes)),
hits AS (SELECT r, s, n, item_id FROM spots JOIN wins USING (n, win)),
cover AS (SELECT r, count(DISTINCT p) AS n_hit
          FROM (SELECT DISTINCT r, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT r, s, n FROM hits))
          GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT r, item_id::VARCHAR AS i FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cover USING (r) LEFT JOIN found USING (r)
"""

OP3_PREFIX_FREE_DEDUP = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
h AS (SELECT doc_id, hex(b) AS x, octet_length(b) AS n FROM d),
starts AS (SELECT doc_id, x, unnest(range(0, n - 99)) AS s FROM h),
strings AS (SELECT doc_id, s, md5_number(substr(x, 2 * s + 1, 200)) AS k FROM starts),
later AS (SELECT doc_id, s FROM strings
          QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, s) > 1),
steps AS (SELECT doc_id, s, s - coalesce(lag(s) OVER (PARTITION BY doc_id ORDER BY s), -1000000) AS gap
          FROM later),
runs AS (SELECT doc_id, s, sum((gap > 100)::INT) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM steps),
spans AS (SELECT doc_id, run, min(s) AS b, max(s) + 100 AS e FROM runs GROUP BY doc_id, run),
gone AS (SELECT doc_id, sum(e - b) AS n_removed, count(*) AS n_spans,
                list(b ORDER BY b) AS bs, list(e ORDER BY b) AS es FROM spans GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN bs IS NULL THEN x ELSE
         substr(x, 1, 2 * bs[1]) || array_to_string([
           CASE WHEN i = len(bs) THEN substr(x, 2 * es[i] + 1)
                ELSE substr(x, 2 * es[i] + 1, 2 * (bs[i + 1] - es[i])) END
           FOR i IN range(1, len(bs) + 1)], '') END)) AS kept_sha256
FROM h LEFT JOIN gone USING (doc_id)
"""


_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(table: str, key: str) -> str:
    """One row per row of ``table``: a number of its own, its key and its words."""
    return f"""
    SELECT row_number() OVER () AS r, {key},
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz'), '{_TERMS}') AS words
    FROM {table}"""


OP11_BAG_SEARCH = f"""
WITH d AS ({_terms('documents', 'doc_id')}),
i AS ({_terms('benchmark', 'item_id')}),
corpus AS (SELECT count(*) FILTER (WHERE len(words) > 0) AS docs,
                  coalesce(sum(len(words)), 0)::BIGINT AS words FROM d),
wanted AS (SELECT r AS item, item_id, term, count(*) AS times
           FROM (SELECT r, item_id, unnest(words) AS term FROM i) GROUP BY ALL),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM d)
       WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
           FROM tf, corpus GROUP BY term),
value AS (SELECT tf.r, doc_id, term,
                 w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(d.words) * docs) // corpus.words))) AS v
          FROM tf JOIN d USING (r) JOIN weight USING (term), corpus),
scored AS (SELECT item, item_id, r, doc_id, sum(times * v)::BIGINT AS score
           FROM wanted JOIN value USING (term) GROUP BY ALL)
SELECT item_id, row_number() OVER ranking::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
WINDOW ranking AS (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST)
QUALIFY row_number() OVER ranking <= {lexical_search.K}
"""

OP12_HARD_NEGATIVES = f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r AS other, b.vec_id AS other_id,
         a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.r != b.r WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT anchor, anchor_id, other AS positive, other_id AS positive_id, score AS positive_score
  FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id) <= {hard_negatives.N_POSITIVES})
SELECT p.anchor_id, positive_id, row_number() OVER ranking::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positive p JOIN scored s ON p.anchor = s.anchor AND NOT same
 AND {hard_negatives.WINDOW[0]} * positive_score <= 100 * score
 AND 100 * score <= {hard_negatives.WINDOW[1]} * positive_score
WINDOW ranking AS (PARTITION BY p.anchor, positive ORDER BY score DESC, other_id)
QUALIFY row_number() OVER ranking <= {hard_negatives.N_NEGATIVES}
"""

# every pair that shares a shingle, exactly; ids are taken as unique
OP7_JACCARD_JOIN = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i, len(w) AS n
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)),
shingles AS (
  SELECT DISTINCT doc_id, concat_ws(' ', t, lead(t, 1) OVER v, lead(t, 2) OVER v, lead(t, 3) OVER v,
                                    lead(t, 4) OVER v) AS g
  FROM words WINDOW v AS (PARTITION BY doc_id ORDER BY i) QUALIFY i <= greatest(n - 4, 1)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT p.x, p.y, p.c = a.n AND p.c = b.n AS copy
  FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
        FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2) p
  JOIN sizes a ON a.doc_id = p.x JOIN sizes b ON b.doc_id = p.y
  WHERE 5 * p.c >= 4 * (a.n + b.n - p.c)),
reached AS (
  SELECT doc_id AS node, doc_id AS root FROM sizes
  UNION SELECT l.y, r.root FROM reached r JOIN links l ON l.x = r.node),
groups AS (SELECT node, min(root) AS root FROM reached GROUP BY node),
linked AS (
  SELECT x, count(*) AS n_links, count(*) FILTER (copy) AS n_copies, min(y) FILTER (copy) AS copy_id
  FROM links GROUP BY x)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.n_copies, 0) + 1 AS copies,
       coalesce(l.n_links, 0) AS n_links, least(d.doc_id, coalesce(l.copy_id, d.doc_id)) AS exact_id,
       coalesce(g.root, d.doc_id) AS group_id, coalesce(g.root, d.doc_id) = d.doc_id AS is_first
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN linked l ON l.x = d.doc_id
LEFT JOIN groups g ON g.node = d.doc_id
"""
