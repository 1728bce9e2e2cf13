"""Check SQL of the operators that plain SQL can express."""

from __future__ import annotations

from dugout.llm import licenses
from dugout.llm.sharding import BLOCKS, MULTIPLIER

OP5 = f"""
WITH RECURSIVE
bits AS (SELECT range AS i, range::UBIGINT AS c, 0 AS step FROM range(256)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE step = 8),
held AS (SELECT doc_id, coalesce(doc_id, 0)::HUGEINT AS k, hex(encode(coalesce(text, ''))) AS h FROM documents),
bytes AS (SELECT doc_id, k, length(h) // 2 AS n, list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::UBIGINT) AS b FROM held),
sized AS (SELECT doc_id, k, n + 16 AS size,
  xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, b),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255)::INTEGER + 1]))) AS text_crc32 FROM bytes, crc),
walk AS (SELECT doc_id, n, CASE WHEN k < 0 THEN k + 18446744073709551616 ELSE k END AS k, -1::BIGINT AS b, 0::BIGINT AS j
  FROM held, (VALUES (40), (41)) x(n)
  UNION ALL SELECT doc_id, n, (k * {MULTIPLIER} + 1) % 18446744073709551616, j,
    floor((j + 1) * (2147483648::DOUBLE / (((k * {MULTIPLIER} + 1) % 18446744073709551616) // 8589934592 + 1)::DOUBLE))::BIGINT
  FROM walk WHERE j < n),
ended AS (SELECT doc_id, max(b) FILTER (n = 40) AS shard, max(b) FILTER (n = 41) AS grown FROM walk WHERE j >= n GROUP BY 1)
SELECT s.doc_id, s.size::BIGINT AS size, s.text_crc32::BIGINT AS text_crc32, 'key' AS law, e.shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY e.shard ORDER BY
    (((k * {MULTIPLIER} + 1) % 18446744073709551616) // 4294967296) % {BLOCKS}, k, s.size, s.text_crc32) - 1 AS slot,
  e.grown::INTEGER AS grown_shard
FROM sized s JOIN ended e ON s.doc_id = e.doc_id"""

OP7 = r"""
WITH RECURSIVE
cut AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
grams AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w]
    ELSE list_transform(range(1, len(w) - 2), lambda i: w[i : i + 3]) END) AS g FROM cut)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY 1, 2, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT c.doc_id, coalesce(s.n, 0) AS n_shingles, least(c.doc_id, coalesce(min(r.b), c.doc_id)) AS component_id
FROM cut c LEFT JOIN sizes s ON s.doc_id = c.doc_id LEFT JOIN reach r ON r.a = c.doc_id GROUP BY c.doc_id, s.n"""

# All pairs; the operator finds a pair at the limit with probability 0.999.
OP8 = """
WITH RECURSIVE
held AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM held a JOIN held b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY 1),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
found AS (SELECT e.vec_id, coalesce(max(c.n), 0)::BIGINT AS n_links, least(e.vec_id, coalesce(min(r.b), e.vec_id)) AS component_id
  FROM embeddings e LEFT JOIN counts c ON c.a = e.vec_id LEFT JOIN reach r ON r.a = e.vec_id GROUP BY 1)
SELECT *, vec_id = component_id AS kept FROM found"""

OP11 = r"""
WITH low AS (SELECT 'd' AS side, doc_id AS id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents
  UNION ALL SELECT 'i', item_id, row_number() OVER (), coalesce(text, '') FROM benchmark),
cut AS (SELECT side, id, r, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low),
grams AS (SELECT DISTINCT id, k, w[i + 1 : i + k] AS g
  FROM (SELECT id, w, least(len(w), 10) AS k, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS i FROM cut WHERE side = 'i' AND len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM grams),
places AS (SELECT r, k, unnest(range(0, len(w) - k + 1)) AS i, w FROM cut, sizes WHERE side = 'd' AND len(w) >= k),
met AS (SELECT p.r, p.k, p.i, g.id FROM places p JOIN grams g ON p.k = g.k AND p.w[p.i + 1 : p.i + p.k] = g.g),
hit AS (SELECT r, count(DISTINCT x) AS n FROM (SELECT r, unnest(range(i, i + k)) AS x FROM met) GROUP BY 1),
named AS (SELECT r, count(DISTINCT id) AS n, array_to_string(list_sort(list(DISTINCT id::VARCHAR)), ',') AS s FROM met GROUP BY 1)
SELECT c.id AS doc_id, len(c.w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(n.n, 0) AS n_items,
  sha256(coalesce(n.s, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
FROM cut c LEFT JOIN hit h ON h.r = c.r LEFT JOIN named n ON n.r = c.r WHERE c.side = 'd'"""

OP12 = """
WITH RECURSIVE
bits AS (SELECT range AS i, range::UBIGINT AS c, 0 AS step FROM range(256)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE step = 8),
coded AS (SELECT doc_id, lang, n_chars, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT) AS b,
  coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') AS head,
  coalesce(strlen(text) || ':' || text, '-') AS tail FROM documents),
leaves AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
  sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) AS changed,
  xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, b),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255)::INTEGER + 1]))) % 7 = 0 AS tampered FROM coded, crc),
placed AS (SELECT *, '=' || lang AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
low AS (SELECT coalesce(g, '') AS g, 0 AS l, i, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM placed
  UNION ALL SELECT g, l + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2 FROM low WHERE n > 1 GROUP BY g, l, i // 2),
subroots AS (SELECT g, l AS depth, h, row_number() OVER (ORDER BY g) - 1 AS i FROM low WHERE n = 1),
high AS (SELECT 0 AS l, i, h, count(*) OVER () AS n FROM subroots
  UNION ALL SELECT l + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2 FROM high WHERE n > 1 GROUP BY l, i // 2),
ends AS (SELECT l AS depth, h AS root FROM high WHERE n = 1),
fold AS (SELECT p.doc_id, s.g, p.i AS at, p.i, 0 AS l, s.depth, s.i AS place, p.leaf, s.h AS subroot, '' AS proof,
    CASE WHEN tampered THEN changed ELSE leaf END AS h, row_number() OVER () AS r
  FROM placed p JOIN subroots s ON s.g = coalesce(p.g, '')
  UNION ALL SELECT f.doc_id, f.g, f.at, CASE WHEN f.l + 1 = f.depth THEN f.place ELSE f.i // 2 END, f.l + 1, f.depth, f.place, f.leaf, f.subroot,
    f.proof || coalesce(x.h, ''), sha256(CASE WHEN f.i % 2 = 1 THEN coalesce(x.h, '') || f.h ELSE f.h || coalesce(x.h, '') END), f.r
  FROM (SELECT * FROM fold WHERE l < depth + (SELECT depth FROM ends)) f
  LEFT JOIN (SELECT g, l, i, h FROM low WHERE n > 1 UNION ALL SELECT s.g, s.depth + k.l, k.i, k.h FROM subroots s, high k WHERE k.n > 1) x
    ON x.g = f.g AND x.l = f.l AND x.i = xor(f.i, 1::BIGINT))
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified
FROM fold, ends WHERE l = fold.depth + ends.depth"""

SQL = {
    "op3_license_scan": licenses.scan_sql(),
    "op5_jump_sharding": OP5,
    "op7_ngram_jaccard_join": OP7,
    "op8_embedding_near_dedup": OP8,
    "op11_benchmark_decontamination": OP11,
    "op12_merkle_manifest": OP12,
}
