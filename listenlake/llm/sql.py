"""DuckDB SQL that must give the rows of the named queries."""

EXACT = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
  FROM documents),
r AS (
  SELECT *, count(*) OVER (PARTITION BY plain) AS group_size,
         first_value(doc_id) OVER (PARTITION BY plain ORDER BY points DESC, doc_id) AS keep_id
  FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256
FROM r
"""

QUALITY = r"""
WITH t AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
w AS (
  SELECT doc_id, i, list_slice(words, i, i + 7) AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM t)),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM w) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM again) GROUP BY doc_id),
c AS (
  SELECT t.doc_id, host, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM t LEFT JOIN covered USING (doc_id)),
f AS (
  SELECT *, n_words < 20 AS few_words, 100 * n_repeat_words > 30 * n_words AS repeats,
         100 * n_symbols > 20 * word_chars AS symbols, 100 * n_dup_lines > 50 * n_lines AS dup_lines
  FROM c),
long AS (
  SELECT host, rule, count(*) AS n, sum(bad::INT) AS bad
  FROM (SELECT host, unnest(['few_words', 'repeats', 'symbols', 'dup_lines']) AS rule,
               unnest([few_words, repeats, symbols, dup_lines]) AS bad FROM f)
  GROUP BY host, rule),
prior AS (SELECT rule, avg(bad / n) AS m, var_pop(bad / n) AS v, sum(n) AS rows FROM long GROUP BY rule),
weighed AS (
  SELECT *, CASE WHEN v > 1e-12 THEN greatest(m * (1 - m) / v - 1, 0) ELSE rows END AS weight FROM prior),
verdict AS (
  SELECT host, max((bad + m * weight) / (n + weight)) <= 0.5 AS host_kept FROM long JOIN weighed USING (rule) GROUP BY host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       few_words OR repeats AS base_failed, NOT (few_words OR repeats) AND host_kept AS kept, f.host, host_kept
FROM f JOIN verdict ON f.host IS NOT DISTINCT FROM verdict.host
"""

JACCARD = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 4), ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM t WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
       JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM t UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, min(reach.b) AS component_id
FROM t JOIN reach ON reach.a = t.doc_id LEFT JOIN n ON n.doc_id = t.doc_id
GROUP BY t.doc_id, n.n
"""

PHRASES = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
p AS (
  SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i
  FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
f AS (SELECT lang, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, k, count(*) AS f FROM p GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
often AS (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE f >= 100),
inside AS (
  SELECT DISTINCT c.lang, c.phrase
  FROM (SELECT lang, k, f, words, unnest(range(2, k)) AS m FROM often) x,
       LATERAL (SELECT unnest(range(1, k - m + 2)) AS i) y, often c
  WHERE c.lang = x.lang AND c.k = m AND c.phrase = array_to_string(list_slice(x.words, i, i + m - 1), ' ') AND 100 * x.f >= 100 * c.f),
cut AS (
  SELECT lang, phrase, f AS a, words, unnest(range(1, k)) AS k, len(words) AS size
  FROM often ANTI JOIN inside USING (lang, phrase) WHERE k > 1),
scored AS (
  SELECT cut.lang, cut.phrase, a, x.f AS l, y.f AS r, n,
         ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score, cut.k AS first
  FROM cut JOIN n USING (lang)
       JOIN often x ON x.lang = cut.lang AND x.phrase = array_to_string(list_slice(cut.words, 1, cut.k), ' ')
       JOIN often y ON y.lang = cut.lang AND y.phrase = array_to_string(list_slice(cut.words, cut.k + 1, size), ' ')),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, first) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score FROM worst)
SELECT * FROM ranked WHERE rank <= 2000
"""

MERKLE = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, lang, n_chars, text, source, CASE WHEN lang IS NULL THEN '0' ELSE '1' || lang END AS tree,
         list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))) AS crc
  FROM documents),
fields AS (
  SELECT *, n_chars + CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN 1 ELSE 0 END AS other FROM t),
h AS (
  SELECT doc_id, tree,
         sha256(concat(a, b, c, coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-'), e)) AS leaf,
         sha256(concat(a, b, c, coalesce(strlen(other::VARCHAR) || ':' || other, '-'), e)) AS held
  FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') AS a, coalesce(strlen(source) || ':' || source, '-') AS b,
               coalesce(strlen(lang) || ':' || lang, '-') AS c, coalesce(strlen(text) || ':' || text, '-') AS e FROM fields)),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS size FROM h),
up(tree, level, place, size, node) AS (
  SELECT tree, 0, place, size, leaf FROM leaves
  UNION ALL
  SELECT tree, level + 1, place // 2, any_value(size + 1) // 2, sha256(string_agg(node, '' ORDER BY place))
  FROM up WHERE size > 1 GROUP BY tree, level, place // 2),
subroots AS (
  SELECT tree, node, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS size FROM up WHERE size = 1),
top(level, place, size, node) AS (
  SELECT 0, place, size, node FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, any_value(size + 1) // 2, sha256(string_agg(node, '' ORDER BY place))
  FROM top WHERE size > 1 GROUP BY level, place // 2),
nodes AS (
  SELECT tree, level, place, node, size FROM up WHERE size > 1
  UNION ALL SELECT 'top', level, place, node, size FROM top WHERE size > 1),
heights AS (SELECT tree, max(level) + 1 AS height FROM nodes GROUP BY tree),
steps AS (
  SELECT l.doc_id, l.tree, l.place AS leaf_place, y.level AS step, (l.place >> y.level) & 1 AS is_right, s.node AS sibling
  FROM leaves l JOIN (SELECT DISTINCT tree, level FROM nodes) y ON y.tree = l.tree
       LEFT JOIN nodes s ON s.tree = l.tree AND s.level = y.level AND s.place = xor(l.place >> y.level, 1)
  UNION ALL
  SELECT l.doc_id, l.tree, l.place, 1000 + y.level, (r.place >> y.level) & 1, s.node
  FROM leaves l JOIN subroots r ON r.tree = l.tree CROSS JOIN (SELECT DISTINCT level FROM top WHERE size > 1) y
       LEFT JOIN nodes s ON s.tree = 'top' AND s.level = y.level AND s.place = xor(r.place >> y.level, 1)),
proofs AS (
  SELECT tree, leaf_place AS place, coalesce(string_agg(sibling, '' ORDER BY step), '') AS proof, list(sibling ORDER BY step) AS siblings,
         list(is_right ORDER BY step) AS sides
  FROM steps GROUP BY tree, leaf_place),
folds(tree, place, step, node) AS (
  SELECT tree, place, 0, held FROM leaves
  UNION ALL
  SELECT f.tree, f.place, f.step + 1,
         sha256(CASE WHEN sides[f.step + 1] = 1 THEN coalesce(siblings[f.step + 1], '') || f.node ELSE f.node || coalesce(siblings[f.step + 1], '') END)
  FROM folds f JOIN proofs p ON p.tree = f.tree AND p.place = f.place WHERE f.step < len(p.sides)),
folded AS (SELECT tree, place, max_by(node, step) AS folded_root FROM folds GROUP BY tree, place),
root AS (SELECT node AS root FROM top WHERE size = 1)
SELECT doc_id, leaf, subroots.node AS subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN subroots USING (tree) CROSS JOIN root LEFT JOIN proofs ON proofs.tree = leaves.tree AND proofs.place = leaves.place
     JOIN folded ON folded.tree = leaves.tree AND folded.place = leaves.place
"""
