"""DuckDB SQL of the text queries that SQL can express; tables are views of the given ones."""

# The hash tree of ``fingerprint``, level by level: phrases, paragraphs, sections, root.
FINGERPRINT = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id),
                  first_value(coalesce(text, '')) OVER (ORDER BY doc_id)) AS next_text
  FROM documents),
e AS (
  SELECT doc_id, text, next_text,
         substring(text, 1, length(text) - length(text) // 4) || substring(next_text, 1, length(text) // 4) AS edited
  FROM t),
versions AS (
  SELECT doc_id, 0 AS v, text FROM e UNION ALL SELECT doc_id, 1, edited FROM e
  UNION ALL SELECT doc_id, 2, next_text FROM e),
sections AS (
  SELECT doc_id, v, generate_subscripts(x, 1) AS i, unnest(x) AS section
  FROM (SELECT doc_id, v, regexp_extract_all(text, '(?s).+?\n[ \t\r]*\n|.+') AS x FROM versions)),
paragraphs AS (
  SELECT doc_id, v, i, generate_subscripts(x, 1) AS j, unnest(x) AS paragraph
  FROM (SELECT doc_id, v, i, regexp_extract_all(section, '[^\n]*\n|[^\n]+') AS x FROM sections)),
hashed AS (
  SELECT doc_id, v, i, j, length(paragraph) AS n,
         list_transform(regexp_extract_all(paragraph, '[^.,;:!?]{1,64}[.,;:!?]*|[.,;:!?]+'), lambda p: md5(p)) AS ph
  FROM paragraphs),
level2 AS (
  SELECT doc_id, v, i, string_agg(own, '' ORDER BY j) AS owns,
         string_agg(';' || own[1:16] || '+' || n || part, '' ORDER BY j) AS part,
         flatten(list(leaves)) AS leaves
  FROM (SELECT doc_id, v, i, j, n, md5(list_aggregate(ph, 'string_agg', '')) AS own,
               list_aggregate(list_transform(ph, lambda h: '.' || h[1:8]), 'string_agg', '') AS part,
               list_transform(ph, lambda h: h[1:8]) AS leaves
        FROM hashed)
  GROUP BY ALL),
level1 AS (
  SELECT doc_id, v, sha256(string_agg(own, '' ORDER BY i)) AS root,
         string_agg('/' || own[1:16] || part, '' ORDER BY i) AS part, list_distinct(flatten(list(leaves))) AS leaves
  FROM (SELECT doc_id, v, i, md5(owns) AS own, part, leaves FROM level2)
  GROUP BY ALL),
trees AS (
  SELECT versions.doc_id, versions.v, coalesce(root, sha256('')) AS root,
         coalesce(root, sha256('')) || coalesce(part, '') AS fp, coalesce(leaves, []) AS leaves
  FROM versions LEFT JOIN level1 USING (doc_id, v))
SELECT e.doc_id, length(e.text)::BIGINT AS n_chars, sha256(e.edited) AS edited_sha256, a.fp AS fingerprint,
       b.fp AS edited_fingerprint,
       CASE WHEN a.root = b.root THEN 1.0 ELSE
         2.0::DOUBLE * len(list_intersect(a.leaves, b.leaves)) / (len(a.leaves) + len(b.leaves) + 2) END::DOUBLE
         AS near_edited,
       CASE WHEN a.root = c.root THEN 1.0 ELSE
         2.0::DOUBLE * len(list_intersect(a.leaves, c.leaves)) / (len(a.leaves) + len(c.leaves) + 2) END::DOUBLE
         AS near_next
FROM e JOIN trees a ON a.doc_id = e.doc_id AND a.v = 0 JOIN trees b ON b.doc_id = e.doc_id AND b.v = 1
JOIN trees c ON c.doc_id = e.doc_id AND c.v = 2
"""

# Every part's documents by mask; an order's step looks at the sets of filters before and after it.
FILTER_AUDIT = r"""
WITH t AS (
  SELECT d.doc_id, coalesce(d.source, '') AS part, coalesce(d.text, '') AS text,
         regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+') AS w,
         min(d.doc_id) OVER (PARTITION BY coalesce(d.text, '')) AS least,
         coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic
  FROM documents d LEFT JOIN labels l USING (doc_id)),
m AS (
  SELECT part, good, toxic,
         CASE WHEN len(w) < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask
  FROM t),
c AS (SELECT part, mask, good, toxic, count(*) AS n FROM m GROUP BY ALL),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS f(letter, bit)),
o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (
  SELECT filter_order, k AS step, bits[k] AS bit,
         list_sum(list_slice(bits, 1, k))::INT - bits[k] AS before
  FROM o, range(1, 6) AS r(k)),
r AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN good AND mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN toxic AND mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM r
"""

COLLOCATIONS = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM w, range(1, 5) AS r(size) WHERE len(w) >= size)),
f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.size, k, c.a, array_to_string(c.w[1:k], ' ') AS head,
         array_to_string(c.w[k + 1:], ' ') AS rest
  FROM c, range(1, 4) AS r(k) WHERE k < c.size),
scored AS (
  SELECT x.lang, x.phrase, x.a, k, l.f AS l, r.f AS r, (2000000::HUGEINT * x.a) // (l.f + r.f) AS score
  FROM cuts x JOIN f l ON l.lang = x.lang AND l.phrase = x.head AND l.size = k
  JOIN f r ON r.lang = x.lang AND r.phrase = x.rest AND r.size = x.size - k),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT DISTINCT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, a AS longer
  FROM (SELECT c.lang, c.w, c.a, s.size, unnest(range(1, len(c.w) - s.size + 2)) AS i
        FROM c, range(2, 4) AS s(size) WHERE s.size < c.size)),
kept AS (
  SELECT worst.* FROM worst
  WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = worst.lang AND i.phrase = worst.phrase
                    AND 100::HUGEINT * i.longer >= 80::HUGEINT * worst.a)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n.n,
       score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

SQL = {"op11_collocations": COLLOCATIONS, "op12_filter_audit": FILTER_AUDIT,
       "op13_fingerprint": FINGERPRINT}
