"""DuckDB SQL of the queries that SQL can say."""

# CRC-32 byte by byte; the table of 256 remainders comes from its polynomial.
_OP1 = """
WITH RECURSIVE rem(i, k, v) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM rem WHERE k < 8
), tab AS (SELECT list(v ORDER BY i) AS t FROM rem WHERE k = 8),
texts AS (
  SELECT doc_id, text, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
    lambda h: ('0x' || h)::BIGINT) AS b FROM documents
), crc AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 8 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, b),
      lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295)::BIGINT AS text_crc32
  FROM texts, tab
), regions(grown, r, w) AS (
  VALUES (0, 0, 8), (0, 1, 8), (0, 2, 8), (1, 0, 8), (1, 1, 8), (1, 2, 8), (1, 3, 1)
), draws AS (
  SELECT doc_id, name, -ln((('0x' || substr(md5(name || '/' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) AS e
  FROM (SELECT DISTINCT doc_id FROM documents), (
    SELECT r::VARCHAR AS name FROM range(4) a(r)
    UNION ALL SELECT r || '.' || k FROM range(3) a(r), range(2) b(k)
    UNION ALL SELECT r || '.' || k || '.' || s FROM range(3) a(r), range(2) b(k), range(4) c(s))
), region AS (
  SELECT doc_id, grown, arg_min(r, e / w) AS r FROM draws JOIN regions ON name = r::VARCHAR GROUP BY 1, 2
), rack AS (
  SELECT doc_id, r, arg_min(k, e) AS k FROM draws, range(3) a(r), range(2) b(k) WHERE name = r || '.' || k GROUP BY 1, 2
), leaf AS (
  SELECT doc_id, r, k, arg_min(s, e) AS s
  FROM draws, range(3) a(r), range(2) b(k), range(4) c(s) WHERE name = r || '.' || k || '.' || s GROUP BY 1, 2, 3
), shard AS (
  SELECT region.doc_id, grown, CASE WHEN region.r = 3 THEN 24 ELSE region.r * 8 + rack.k * 4 + leaf.s END AS shard
  FROM region LEFT JOIN rack ON region.doc_id IS NOT DISTINCT FROM rack.doc_id AND region.r = rack.r
  LEFT JOIN leaf ON region.doc_id IS NOT DISTINCT FROM leaf.doc_id AND region.r = leaf.r AND rack.k = leaf.k
), placed AS (
  SELECT c.doc_id, size, text_crc32, a.shard::INTEGER AS shard, b.shard::INTEGER AS grown_shard
  FROM crc c JOIN shard a ON a.grown = 0 AND c.doc_id IS NOT DISTINCT FROM a.doc_id
  JOIN shard b ON b.grown = 1 AND c.doc_id IS NOT DISTINCT FROM b.doc_id
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY
    ('0x' || substr(md5(concat_ws('/', doc_id, text_crc32, size)), 1, 8))::BIGINT
      % greatest(1, (greatest(1, (SELECT count(*) FROM documents) // 24) + 3999) // 4000),
    doc_id, text_crc32, size) - 1 AS slot, grown_shard
FROM placed
"""

_WORDS7 = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_OP7 = rf"""
WITH d AS (SELECT doc_id, {_WORDS7} AS w FROM documents),
i AS (SELECT item_id, {_WORDS7} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS p FROM i WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT m FROM windows),
runs AS (
  SELECT doc_id, p, m, array_to_string(w[p:p + m - 1], ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS p FROM d, lengths WHERE len(w) >= m)
), found AS (SELECT doc_id, p, runs.m, item_id FROM runs JOIN windows USING (m, g)),
hit AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(generate_series(p, p + m - 1)) FROM found) GROUP BY 1
), named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS s
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY 1
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN named ON d.doc_id = named.doc_id
"""

_CRC_TABLE = """rem(i, k, v) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM rem WHERE k < 8
), tab AS (SELECT list(v ORDER BY i) AS t FROM rem WHERE k = 8)"""


def _crc(text: str) -> str:
    """CRC-32 of a text, with the table ``t`` of 256 remainders."""
    codes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295)::BIGINT"


_OP11 = f"""
WITH RECURSIVE {_CRC_TABLE},
turns AS (
  SELECT conv_id AS c, md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS tie,
    strlen(coalesce(text, ''))::BIGINT AS n, turn
  FROM conversations WHERE conv_id IS NOT NULL
), placed AS (SELECT c, tie, n, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, tie) AS pos FROM turns),
ids AS (SELECT c, c - c % 5 AS f, {_crc("c::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT c FROM placed), tab),
sequences AS (
  SELECT c, list(tie ORDER BY late, pos) FILTER (tie IS NOT NULL) AS s, list(n ORDER BY late, pos) FILTER (tie IS NOT NULL) AS w
  FROM (
    SELECT ids.c, 0 AS late, pos, tie, n FROM ids LEFT JOIN placed p ON p.c = f AND pos <= h
    UNION ALL SELECT ids.c, 1, pos, tie, n FROM ids JOIN placed p ON p.c = ids.c AND pos > h
  ) GROUP BY c
), paths AS (
  SELECT c, d, coalesce(len(s), 0) AS l, md5(coalesce(array_to_string(s[1:d], ','), '')) || d AS node,
    CASE WHEN d > 0 THEN md5(coalesce(array_to_string(s[1:d - 1], ','), '')) || (d - 1) END AS parent, CASE WHEN d > 0 THEN w[d] ELSE 0 END AS n
  FROM (SELECT c, s, w, unnest(range(0, coalesce(len(s), 0) + 1)) AS d FROM sequences)
), nodes AS (
  SELECT node, min(parent) AS parent, min(c) AS c, min(d) AS d, count(*) AS members, (count(*) - 1) * min(n) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = l), '')) AS ends
  FROM paths GROUP BY node
), children AS (SELECT parent, count(*) AS k FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT DISTINCT a.node AS top, b.node FROM paths a JOIN paths b ON a.c = b.c AND a.d <= b.d
), sums AS (
  SELECT top, sum(saved)::BIGINT AS saved, count(*) FILTER (k IS NULL) AS leaves
  FROM below JOIN nodes USING (node) LEFT JOIN children ON children.parent = below.node GROUP BY top
)
SELECT nodes.c AS conv_id, nodes.d AS depth, up.c AS parent_conv_id, nodes.members AS n_convs, coalesce(k, 0) AS n_children,
  leaves AS n_leaves, sums.saved AS saved_tokens, nodes.ends AS ends_sha256
FROM nodes JOIN sums ON top = nodes.node LEFT JOIN nodes up ON up.node = nodes.parent LEFT JOIN children ON children.parent = nodes.node
"""

_OP12 = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents
  ) WHERE length(run) >= 6 GROUP BY 1, 2
), hashed AS (SELECT run, n, {_crc("concat(doc_id, ':', run)")} AS h FROM runs, tab),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word FROM hashed
  ) WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5
), cuts AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT x.word, y.word AS near, y.n AS near_n FROM cuts x JOIN cuts y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM cuts x JOIN words y ON y.word = x.a || x.b
  UNION SELECT y.word, x.word, x.n FROM cuts x JOIN words y ON y.word = x.a || x.b
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM near GROUP BY word
), judged AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form, CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS place, 0 AS steps FROM judged
  UNION ALL SELECT walk.word, j.form, steps + 1 FROM walk JOIN judged j ON j.word = walk.place WHERE j.form IS NOT NULL
), roots AS (SELECT word, arg_max(place, steps) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN roots USING (word)
"""

ORACLE: dict[str, str] = {"op1_shard_tree": _OP1, "op7_suffix_automaton": _OP7, "op11_rollup_trie": _OP11, "op12_bloom_spelling": _OP12}
