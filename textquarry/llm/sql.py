"""SQL counterparts of the operators' queries, where SQL can express them."""

from __future__ import annotations

OP3 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
WINDOW same AS (PARTITION BY text_sha256)
"""

# A turn is [INST]role[/INST]text</s>. In roles and texts a backslash is doubled, and one more stands after the first
# character of each control string; so these lengths follow from counts.
OP10 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS odd (turn, role)
), sized AS (
  SELECT *, length('[INST][/INST]</s>') + length(role) + length(text)
    + len(regexp_extract_all(role || chr(10) || text, '\\|</?s>|<</?SYS>>|\[/?INST\]')) AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP12 = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT * FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), ranked AS (
  SELECT anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank
  FROM positives p JOIN pairs n USING (anchor_id)
  WHERE NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""

OP13 = r"""
WITH found AS (
  SELECT row_number() OVER () AS d, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL
), held AS (SELECT d, doc_id, terms, len(terms) AS n FROM found WHERE len(terms) > 0
), corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM held
), asked AS (
  SELECT i, item_id, term, count(*) AS often FROM (
    SELECT row_number() OVER () AS i, item_id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE text IS NOT NULL) GROUP BY ALL
), counted AS (
  SELECT d, doc_id, n, term, count(*) AS tf FROM (SELECT d, doc_id, n, unnest(terms) AS term FROM held)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counted, corpus GROUP BY term, docs
), impacts AS (
  SELECT d, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // length)))) AS x
  FROM counted JOIN weights USING (term), corpus
), scored AS (
  SELECT i, item_id, d, doc_id, sum(often * x)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": OP3,
    "op10_chat_format": OP10,
    "op12_hard_negatives": OP12,
    "op13_lexical_search": OP13,
}
