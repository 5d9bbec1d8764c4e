"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

LINES = """
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text, md5(coalesce(text, '')) AS page FROM documents
), split AS (
  SELECT doc_id, host, page, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d
), often AS (
  SELECT host, trim(line, ' ') AS line, count(DISTINCT page) AS n FROM split WHERE trim(line, ' ') <> '' GROUP BY 1, 2
), totals AS (
  SELECT host, count(DISTINCT page) AS pages FROM d GROUP BY 1
), dropped AS (
  SELECT host, line FROM often JOIN totals USING (host) WHERE n >= 3 AND n > 0.08 * pages
), kept AS (
  SELECT s.doc_id, s.i, CASE WHEN x.line IS NULL THEN s.line END AS line
  FROM split s LEFT JOIN dropped x ON x.host = s.host AND x.line = trim(s.line, ' ')
)
SELECT doc_id, count(*) AS n_lines, count(*) - count(line) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE line IS NOT NULL), '')) AS kept_sha256
FROM kept GROUP BY doc_id
"""

REVISITS = """
WITH p AS (
  SELECT page_id, md5(coalesce(html, '')) AS digest, length(coalesce(html, '')) AS size, page_id * 60 AS t,
    regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest
  FROM pages
), c AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), '^www\\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_replace(rest, '^[^/?]*', ''), '/+$', '') AS url, t + size % 7 * 100 - 50 AS later FROM p
), j AS (
  SELECT v.page_id, v.url, v.digest, v.size, v.later, r.page_id AS original, r.digest AS held, r.size AS held_size,
    row_number() OVER (PARTITION BY v.page_id ORDER BY r.t DESC, r.page_id DESC) AS nth
  FROM c v LEFT JOIN c r ON r.url = v.url AND r.t < v.later
)
SELECT page_id * 2 + 1 AS record_id, url, CASE WHEN held = digest THEN original * 2 END AS refers_to,
  CASE WHEN original IS NULL THEN 'no_original' WHEN held = digest THEN 'resolved' ELSE 'validator_mismatch' END AS outcome,
  CASE WHEN held = digest
    THEN 'cache-control: max-age=60' || chr(10) || 'content-length: ' || held_size || chr(10) || 'content-type: text/html' || chr(10)
      || 'date: ' || later || chr(10) || 'etag: W/"' || digest || '"' || chr(10) || 'expires: ' || (later + 60)
    ELSE 'content-length: 0' || chr(10) || 'date: ' || later || chr(10) || 'etag: W/"' || digest || '"' || chr(10)
      || 'expires: ' || (later + 60) || chr(10) || 'set-cookie: a=b' END AS headers
FROM j WHERE nth = 1
"""

# crc32 by bits: each character is a step that takes it in and seven more.
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT],
    flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, e: xor(xor(a, e) >> 1, (xor(a, e) & 1) * 3988292384)), 4294967295)"""


def _field(text: str) -> str:
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


_ROW = " || ".join(_field(f"{c}::VARCHAR") for c in ("doc_id", "source", "lang", "n_chars"))

MANIFEST = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({_ROW} || {_field("text")}) AS leaf,
    sha256({_ROW} || {_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) AS lowered,
    {_CRC32} % 3 = 0 AS changed
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY tree) AS n FROM d
), nodes AS (
  SELECT tree, 0 AS height, n, rank AS ordinal, leaf AS digest FROM leaves
  UNION ALL
  SELECT tree, height + 1, (n + 7) // 8, ordinal // 8, sha256(string_agg(digest, '' ORDER BY ordinal))
  FROM nodes WHERE n > 1 GROUP BY tree, height, n, ordinal // 8
), tops AS (
  SELECT tree, height AS top, digest, row_number() OVER (ORDER BY tree) - 1 AS rank, count(*) OVER () AS n FROM nodes WHERE n = 1
), crown AS (
  SELECT 0 AS height, n, rank AS ordinal, digest FROM tops
  UNION ALL
  SELECT height + 1, (n + 7) // 8, ordinal // 8, sha256(string_agg(digest, '' ORDER BY ordinal))
  FROM crown WHERE n > 1 GROUP BY height, n, ordinal // 8
), beside AS (
  SELECT tree, height, ordinal,
    coalesce(string_agg(digest, '' ORDER BY ordinal) OVER (PARTITION BY tree, height, ordinal // 8 ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(digest, '' ORDER BY ordinal) OVER (PARTITION BY tree, height, ordinal // 8 ORDER BY ordinal ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM (SELECT tree, height, n, ordinal, digest FROM nodes UNION ALL SELECT NULL, height, n, ordinal, digest FROM crown) WHERE n > 1
), folds AS (
  SELECT doc_id, leaf, l.tree, l.rank, t.rank AS branch, top, 0 AS level, CASE WHEN changed THEN lowered ELSE leaf END AS folded, '' AS proof
  FROM leaves l JOIN tops t USING (tree)
  UNION ALL
  SELECT doc_id, leaf, f.tree, rank, branch, top, level + 1, sha256(before || folded || after), proof || before || after
  FROM folds f JOIN beside b ON (level < top AND b.tree = f.tree AND b.height = level AND b.ordinal = rank // (8 ** level)::BIGINT)
    OR (level >= top AND b.tree IS NULL AND b.height = level - top AND b.ordinal = branch // (8 ** (level - top))::BIGINT)
), root AS (
  SELECT digest AS root, height FROM crown WHERE n = 1
)
SELECT doc_id, leaf, t.digest AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM folds f JOIN tops t USING (tree) CROSS JOIN root WHERE level = f.top + root.height
"""


def _scores(factor: int) -> str:
    """All rows that take part, as ``v``, with their vectors of whole numbers."""
    return f"""v AS (
  SELECT row_number() OVER () AS r, vec_id, label,
    list_transform(embedding, lambda x: floor({factor} * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)"""


NEGATIVES = f"""
WITH {_scores(256)}, m AS (
  SELECT r, vec_id, e, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM v WHERE label IS NOT NULL
), s AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, c.r, c.vec_id, a.label = c.label AS same, list_dot_product(a.e, c.e)::BIGINT AS score
  FROM m a JOIN m c ON a.r <> c.r AND len(a.e) = len(c.e) WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor, anchor_id, r AS positive, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor, positive ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

TOPK = f"""
WITH {_scores(1024)}
SELECT q.vec_id AS query_id, row_number() OVER (PARTITION BY q.r ORDER BY list_dot_product(q.e, c.e) DESC, c.vec_id NULLS LAST)::INTEGER AS rank,
  c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0
QUALIFY rank <= 10
"""

ORACLES = {
    "op3_revisits": REVISITS,
    "op7_lines": LINES,
    "op11_manifest": MANIFEST,
    "op12_negatives": NEGATIVES,
    "op13_topk": TOPK,
}
