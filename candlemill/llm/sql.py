"""The operators that plain SQL can express, as SQL over the same tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(
    CASE WHEN len(w) = 0 THEN []
         WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM words
), tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.c AS component_id
FROM sets s JOIN (SELECT x, min(y) AS c FROM reach GROUP BY x) r ON r.x = s.doc_id
"""

OP8 = """
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, r.c AS component_id, e.vec_id = r.c AS kept
FROM embeddings e
JOIN (SELECT x, min(y) AS c FROM reach GROUP BY x) r ON r.x = e.vec_id
LEFT JOIN (SELECT x, count(*) AS n FROM links GROUP BY x) n ON n.x = e.vec_id
"""

OP11 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS p
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM pieces
), sizes AS (SELECT unnest([1, 2, 3]) AS k
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM words, sizes WHERE len(w) >= k
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 10
), cuts AS (
  SELECT c.*, c1 AS cut, array_to_string(w[1:c1], ' ') AS head, array_to_string(w[c1 + 1:], ' ') AS tail
  FROM candidates c, (SELECT unnest([1, 2]) AS c1) WHERE c1 < k
), scores AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.cut, x.f AS l, y.f AS r,
    CAST((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.tail
), least AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM candidates WHERE k = 3
  UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM candidates WHERE k = 3
), longer AS (SELECT lang, phrase, max(a) AS most FROM inside GROUP BY lang, phrase
), kept AS (
  SELECT s.* FROM least s LEFT JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase
  WHERE g.most IS NULL OR 100 * g.most < 50 * s.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""

_TURN = "md5(length(role) || ':' || role || text)"

OP13 = f"""
WITH filled AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, {_TURN} AS t, length(text) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_TURN}) AS i
  FROM filled
), ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
    list_transform(range(0, 8 * length(conv_id::VARCHAR)), lambda j:
      CASE WHEN j % 8 = 0 THEN ascii(substr(conv_id::VARCHAR, (j // 8 + 1)::INT, 1)) ELSE 0 END::BIGINT),
    lambda a, e: CASE WHEN xor(a, e) & 1 = 1 THEN xor(xor(a, e) >> 1, 3988292384) ELSE xor(a, e) >> 1 END,
    4294967295::BIGINT)) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM own)
), joined AS (
  SELECT c.conv_id, 0 AS part, o.i, o.t, o.chars FROM ids c JOIN own o ON o.conv_id = c.base AND o.i <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.i, o.t, o.chars FROM ids c JOIN own o ON o.conv_id = c.conv_id AND o.i > c.h
), walked AS (
  SELECT conv_id, row_number() OVER w AS d, string_agg(t, '') OVER w AS path, chars
  FROM joined WINDOW w AS (PARTITION BY conv_id ORDER BY part, i)
  UNION ALL
  SELECT conv_id, 0, '', 0 FROM ids
), ended AS (
  SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends
  FROM (SELECT conv_id, arg_max(path, d) AS path FROM walked GROUP BY conv_id) GROUP BY path
), nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n, any_value(chars) AS chars FROM walked GROUP BY path, d
), kids AS (
  SELECT left(path, 32 * (d - 1)::INT) AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), sums AS (
  SELECT above, count(*) FILTER (n_kids IS NULL) AS leaves, sum(saved) AS saved FROM (
    SELECT unnest([left(a.path, 32 * k::INT) for k in range(0, a.d + 1)]) AS above, (a.n - 1) * a.chars AS saved, k.n AS n_kids
    FROM nodes a LEFT JOIN kids k ON k.path = a.path) GROUP BY above
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(k.n, 0) AS n_children,
  s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM nodes n
LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.path = left(n.path, 32 * (n.d - 1)::INT)
LEFT JOIN kids k ON k.path = n.path
LEFT JOIN ended e ON e.path = n.path
JOIN sums s ON s.above = n.path
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_jaccard": OP1, "op8_embedding_dedup": OP8, "op11_phrases": OP11, "op13_conversation_trie": OP13}
