"""DuckDB SQL with the rows of the operators that SQL can express, from their definitions alone."""

LEXICAL_SEARCH = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL),
items AS (
  SELECT row_number() OVER () AS item_no, item_id,
         list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
  FROM benchmark WHERE text IS NOT NULL),
total AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS n_docs, coalesce(sum(len(terms)), 0)::BIGINT AS n_terms FROM texts),
lengths AS (SELECT row_no, doc_id, 10 + (90 * len(terms) * n_docs) // n_terms AS m FROM texts, total WHERE len(terms) > 0),
postings AS (
  SELECT row_no, term, count(*) AS tf FROM (SELECT row_no, unnest(terms) AS term FROM texts) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, total GROUP BY term),
scored AS (
  SELECT item_no, item_id, row_no, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM (SELECT item_no, item_id, unnest(terms) AS term FROM items) JOIN postings USING (term) JOIN weights USING (term)
       JOIN lengths USING (row_no)
  GROUP BY ALL),
ranked AS (
  SELECT item_id, (row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

MERKLE_MANIFEST = r"""
WITH RECURSIVE fields AS (
  SELECT row_number() OVER () AS row_no, doc_id, source, doc_id::VARCHAR AS a, lang AS c, n_chars::VARCHAR AS d, text AS e,
         list_reduce(list_concat([4294967295], list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda ch: ascii(ch)::BIGINT)),
                     lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]),
                                                   lambda x, step: xor(x >> 1, 3988292384 * (x & 1)))) AS crc
  FROM documents),
parts AS (
  SELECT row_no, doc_id, source, xor(crc, 4294967295) % 5 = 0 AS edited,
         coalesce(strlen(a) || ':' || a, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(c) || ':' || c, '-')
           || coalesce(strlen(d) || ':' || d, '-') AS head,
         e, translate(e, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM fields),
leaves AS (
  SELECT row_no, doc_id, source, edited, sha256(head || coalesce(strlen(e) || ':' || e, '-')) AS leaf,
         sha256(head || coalesce(strlen(low) || ':' || low, '-')) AS changed
  FROM parts),
placed AS (
  SELECT *, coalesce(':' || source, '-') AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM leaves),
nodes(tree, level, pos, n, digest) AS (
  SELECT tree, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT tree, any_value(level) + 1, pos // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY tree, pos // 16),
subroots AS (
  SELECT tree AS source_key, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
top(level, pos, n, digest) AS (
  SELECT 0, pos, n, digest FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
  FROM top WHERE n > 1 GROUP BY pos // 16),
every AS (
  SELECT tree, level, pos, digest FROM nodes WHERE n > 1
  UNION ALL SELECT '', level, pos, digest FROM top WHERE n > 1),
runs AS (SELECT tree, level, pos // 16 AS run, list(digest ORDER BY pos) AS kids FROM every GROUP BY ALL),
inside(row_no, tree, level, pos, value, proof) AS (
  SELECT row_no, tree, 0, pos, CASE WHEN edited THEN changed ELSE leaf END, '' FROM placed
  UNION ALL
  SELECT i.row_no, i.tree, i.level + 1, i.pos // 16,
         sha256(array_to_string(list_concat(kids[:i.pos % 16], [i.value], kids[i.pos % 16 + 2:]), '')),
         i.proof || array_to_string(list_concat(kids[:i.pos % 16], kids[i.pos % 16 + 2:]), '')
  FROM inside i JOIN runs r ON r.tree = i.tree AND r.level = i.level AND r.run = i.pos // 16),
at_subroot AS (
  SELECT row_no, arg_max(value, level) AS value, arg_max(proof, level) AS proof, any_value(tree) AS tree FROM inside GROUP BY row_no),
outside(row_no, level, pos, value, proof) AS (
  SELECT row_no, 0, pos, value, proof FROM at_subroot JOIN subroots ON source_key = tree
  UNION ALL
  SELECT o.row_no, o.level + 1, o.pos // 16,
         sha256(array_to_string(list_concat(kids[:o.pos % 16], [o.value], kids[o.pos % 16 + 2:]), '')),
         o.proof || array_to_string(list_concat(kids[:o.pos % 16], kids[o.pos % 16 + 2:]), '')
  FROM outside o JOIN runs r ON r.tree = '' AND r.level = o.level AND r.run = o.pos // 16),
at_root AS (SELECT row_no, arg_max(value, level) AS value, arg_max(proof, level) AS proof FROM outside GROUP BY row_no)
SELECT doc_id, leaf, s.digest AS subroot, t.digest AS root, sha256(proof) AS proof_sha256, value AS folded_root,
       value = t.digest AS verified, edited
FROM placed JOIN at_root USING (row_no) JOIN subroots s ON s.source_key = tree, (SELECT digest FROM top WHERE n = 1) t
"""
