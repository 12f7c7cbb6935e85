"""Independent DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

TOP_K = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(CAST(x AS DOUBLE))]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) r(i)
), told AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nth,
         regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|/?SYS\])', '\1\\\2\3', 'g') AS shown,
         regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '([<\[])(\\*)(/?s>|/?INST\]|/?SYS\])', '\1\\\2\3', 'g') AS shown_role
  FROM turns
), whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth) AS said,
         coalesce(string_agg(text, '' ORDER BY nth) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length(shown) + length(shown_role) + 8) AS formatted_chars
  FROM told GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM whole
"""

DECONTAMINATION = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, m, array_to_string(w[s : s + m - 1], ' ') AS gram
  FROM (SELECT *, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM b WHERE len(w) > 0)
), grams AS (
  SELECT doc_id, m, s, array_to_string(w[s : s + m - 1], ' ') AS gram
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m)
), found AS (
  SELECT doc_id, item_id, m, s FROM grams JOIN windows USING (m, gram)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

JACCARD = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[s : s + least(5, len(w)) - 1], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS s FROM d WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.seen
), least_of AS (
  SELECT node, min(seen) AS component_id FROM reach GROUP BY node
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents LEFT JOIN sizes USING (doc_id) JOIN least_of ON node = doc_id
"""

DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), words AS (
  SELECT id, lang, source, unnest(w) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 10
), counts AS (
  SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), sides AS (
  SELECT lang, source, coalesce((SELECT sum(c) FROM counts x WHERE x.lang = g.lang AND x.source = g.source), 0)
         + 2 * (SELECT count(*) FROM kept k WHERE k.lang = g.lang) AS below
  FROM (SELECT DISTINCT lang, source FROM d) g
), p AS (
  SELECT s.lang, s.source, k.term, coalesce(c, 0) AS c, 1 + CAST(1000000000 * CAST(coalesce(c, 0) + 2 AS HUGEINT) // below AS BIGINT) AS p
  FROM sides s JOIN kept k USING (lang) LEFT JOIN counts USING (lang, source, term)
), q AS (
  SELECT lang, term, 1 + CAST(1000000000 * CAST(total + 2 AS HUGEINT) // (sum(total) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS BIGINT) AS q
  FROM kept
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM sides a JOIN sides b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), ahead AS (
  SELECT p.lang, source, 'term' AS part, p.term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
  FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM ahead))
WHERE part = 'pair' OR rank <= 10
"""


def llm_sql() -> dict[str, str]:
    """Query name to SQL."""
    return {
        "op2_event_sourced_chat": CHAT,
        "op5_ngram_jaccard_join": JACCARD,
        "op6_norm_bucketed_topk": TOP_K,
        "op9_prefix_filtered_decontamination": DECONTAMINATION,
        "op12_source_divergence": DIVERGENCE,
    }
