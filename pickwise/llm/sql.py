"""DuckDB SQL of the queries that SQL can express (same column names and rows)."""

from . import line_dedup, mixing, substring_dedup, url_lists

OP2 = f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, text FROM documents
), lines AS (
  SELECT r, unnest(range(len(a))) AS pos, unnest(a) AS line, coalesce(source, chr(1)) AS site
  FROM (SELECT r, source, string_split(text, chr(10)) AS a FROM docs WHERE text IS NOT NULL)
), bare AS (
  SELECT r, pos, line, site, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS b FROM lines
), bad AS (
  SELECT b FROM bare WHERE b <> '' GROUP BY b HAVING count(DISTINCT site) >= {line_dedup.MIN_SITES}
), per_doc AS (
  SELECT r, count(*) AS n_lines,
         sum(CASE WHEN bad.b IS NOT NULL THEN 1 ELSE 0 END) AS n_bad,
         sum(CASE WHEN bad.b IS NOT NULL THEN length(bare.b) ELSE 0 END) AS bad_chars, sum(length(bare.b)) AS chars,
         coalesce(string_agg(CASE WHEN bad.b IS NULL THEN line END, chr(10) ORDER BY pos), '') AS kept
  FROM bare LEFT JOIN bad ON bare.b = bad.b GROUP BY r
)
SELECT doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
       CAST(CASE WHEN bad_chars < chars THEN n_bad ELSE 0 END AS BIGINT) AS n_removed,
       CAST(CASE WHEN bad_chars < chars THEN bad_chars ELSE 0 END AS BIGINT) AS removed_chars,
       CASE WHEN n_bad > 0 AND bad_chars < chars THEN kept ELSE text END AS text
FROM docs LEFT JOIN per_doc USING (r)
"""

OP8 = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         coalesce(length(text) - length(translate(text, '{mixing.SYMBOLS}', '')), 0) AS symbols,
         coalesce(CAST(doc_id AS VARCHAR), md5(text), '') AS name
  FROM documents
), keyed AS (
  SELECT doc_id, source, size,
         -ln((CAST(('0x' || substr(md5(name || ':{mixing.SEED}'), 1, 13)) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
           / (1.0::DOUBLE / (1.0::DOUBLE + symbols / greatest(size, 1)::DOUBLE)) AS k
  FROM sized
), src AS (
  SELECT source, sum(size)::DOUBLE AS s FROM keyed GROUP BY source
), weighted AS (
  SELECT source, s, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w FROM src
), levels AS (
  SELECT source, s, w, 2 * s / w AS ratio,
         (sum(s) OVER () * 1.5::DOUBLE - coalesce(sum(2 * s) OVER (ORDER BY 2 * s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(w) OVER (ORDER BY 2 * s / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted
), targets AS (
  SELECT source, s, least(2 * s, coalesce(max(CASE WHEN ratio > level THEN level END) OVER () * w, 2 * s)) AS target FROM levels
), budgets AS (
  SELECT source AS src, s, target, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END AS epochs FROM targets
), ranked AS (
  SELECT doc_id, size, CAST(s AS BIGINT) AS source_size, target, epochs, target - epochs * s AS rest,
         sum(size) OVER (PARTITION BY source ORDER BY k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(size) OVER (PARTITION BY source, k) AS words, count(*) OVER (PARTITION BY source, k) AS docs
  FROM keyed JOIN budgets ON source IS NOT DISTINCT FROM src
)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + CASE WHEN upto <= rest THEN size WHEN upto - words <= rest
            THEN least(size, floor((rest - (upto - words)) / docs)) ELSE 0 END AS BIGINT) AS taken
FROM ranked
"""

OP4 = f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), parts AS (
  SELECT r, doc_id, unnest(range(len(a))) AS pos, unnest(a) AS part
  FROM (SELECT r, doc_id, regexp_extract_all(text, '{substring_dedup.UNIT}') AS a FROM docs)
), placed AS (
  SELECT r, doc_id, pos, length(part) AS length, regexp_extract_all(part, '[^\\x20\\x09-\\x0D]+') AS w,
         coalesce(sum(length(part)) OVER (PARTITION BY r ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM parts
), units AS MATERIALIZED (
  SELECT r, doc_id, start, length, len(w) AS words, row_number() OVER (PARTITION BY r ORDER BY pos) AS nth,
         translate(array_to_string(w, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS unit
  FROM placed WHERE len(w) >= {substring_dedup.UNIT_WORDS}
), ranked AS (
  SELECT *, row_number() OVER o AS occurrence, first_value(doc_id) OVER o AS first_doc_id
  FROM units WINDOW o AS (PARTITION BY unit ORDER BY doc_id NULLS LAST, r, start)
), islands AS (
  SELECT *, nth - row_number() OVER (PARTITION BY r ORDER BY nth) AS island FROM ranked WHERE occurrence > 1
), spans AS (
  SELECT r, min(start) AS start, max(start + length) - min(start) AS length, sum(words) AS words, arg_min(first_doc_id, nth) AS first_doc_id
  FROM islands GROUP BY r, island HAVING sum(words) >= {substring_dedup.RUN_WORDS}
), per_doc AS (
  SELECT r, count(*) AS n_spans, sum(words) AS removed_words, sum(length) AS removed_chars,
         string_agg(start || ':' || length || ':' || coalesce(CAST(first_doc_id AS VARCHAR), '-'), ' ' ORDER BY start) AS spans
  FROM spans GROUP BY r
)
SELECT doc_id, CAST(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_words, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       CAST(coalesce(removed_words, 0) AS BIGINT) AS removed_words, CAST(coalesce(removed_chars, 0) AS BIGINT) AS removed_chars,
       n_spans IS NOT NULL AS changed, coalesce(spans, '') AS spans
FROM docs LEFT JOIN per_doc USING (r)
"""

_HASH = "(CAST(('0x' || substr(md5({0} || ':{1}'), 1, 13)) AS BIGINT) % {2})"
_Y = 365 * 86400
OP5 = f"""
WITH pages2 AS (
  SELECT page_id, url, 1704067200 + {_HASH.format("CAST(page_id AS VARCHAR)", "fetch", _Y)} AS f,
         nullif(regexp_replace(lower(regexp_extract(url, '(?i)^\\s*(?:[a-z][a-z0-9+.\\-]*:)?//(?:[^/?#@]*@)?([^/?#:\\s]+)', 1)), '\\.+$', ''), '') AS host,
         regexp_extract(url, '(?i)^\\s*(?:[a-z][a-z0-9+.\\-]*:)?//[^/?#\\s]+(/[^?#\\s]*)', 1) AS path
  FROM pages
), hosts AS (SELECT DISTINCT host AS key FROM pages2 WHERE host IS NOT NULL
), domains AS (SELECT DISTINCT regexp_extract(key, '([^.]+\\.[^.]+)$', 1) AS key FROM hosts
), paths AS (SELECT DISTINCT host || '/' || regexp_extract(path, '^/([^/]+)', 1) AS key FROM pages2
  WHERE host IS NOT NULL AND regexp_extract(path, '^/([^/]+)', 1) <> ''
), valid AS (
  SELECT 'malware' AS l, 'h:' || key AS key, 1704067200 + {_HASH.format("key", "a", _Y)} AS s,
         1704067200 + {_HASH.format("key", "a", _Y)} + {_HASH.format("key", "r", _Y // 4)} AS e FROM hosts
  UNION ALL SELECT 'adult', 'd:' || key, 1704067200 + {_HASH.format("key", "a", _Y)}, 9999999999 FROM domains WHERE key <> ''
  UNION ALL SELECT 'spam', 'p:' || key, 1704067200 + {_HASH.format("key", "a", _Y // 2)},
         1704067200 + {_HASH.format("key", "a", _Y // 2)} + {_HASH.format("key", "r", _Y // 4)} FROM paths
  UNION ALL SELECT 'spam', 'p:' || key, 1704067200 + {_HASH.format("key", "a", _Y // 2)} + {_HASH.format("key", "r", _Y // 4)}
         + {_HASH.format("key", "b", _Y // 4)}, 9999999999 FROM paths
), numbered AS MATERIALIZED (SELECT row_number() OVER () AS n, * FROM pages2
), keys AS (
  SELECT n, f, 'h:' || host AS key FROM numbered
  UNION ALL SELECT n, f, 'd:' || array_to_string(string_split(host, '.')[i:], '.')
    FROM (SELECT n, f, host, unnest(range(1, greatest(len(string_split(host, '.')), 2))) AS i FROM numbered)
  UNION ALL SELECT n, f, 'p:' || host || '/' || array_to_string(list_filter(string_split(path, '/'), lambda x: x <> '')[:i], '/')
    FROM (SELECT n, f, host, path, unnest(range(1, 1 + least({url_lists.PREFIX_SEGMENTS}, len(list_filter(string_split(path, '/'), lambda x: x <> ''))))) AS i FROM numbered)
), hits AS (
  SELECT n, string_agg(DISTINCT l, ',' ORDER BY l) AS blocked_by FROM keys JOIN valid ON keys.key = valid.key AND f >= s AND f < e GROUP BY n
)
SELECT page_id, url, f AS fetched_s, coalesce(blocked_by, '') AS blocked_by, blocked_by IS NULL AS allowed
FROM numbered LEFT JOIN hits USING (n)
"""


_SHIFT = ", ".join(["-1"] * 8)
_CRC32 = f"""xor(list_reduce(flatten(list_prepend([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda x: [CAST(ord(x) AS BIGINT), {_SHIFT}]))), lambda c, o: CASE WHEN o >= 0 THEN xor(c, o)
  ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)"""
#: Levels written out: trees of up to 16 ** 8 leaves.
_LEVELS = 8


def _tree(name: str, key: str) -> str:
    """Nodes and runs of a tree per key above {name}0 (key, i, h, c)."""
    parts = []
    for k in range(_LEVELS):
        parts.append(f"""{name}r{k} AS MATERIALIZED (
  SELECT {key}, i // 16 AS i, string_agg(h, '' ORDER BY i) AS run, any_value(c) AS c FROM {name}{k} GROUP BY {key}, i // 16
), {name}{k + 1} AS MATERIALIZED (SELECT {key}, i, CASE WHEN c = 1 THEN run ELSE sha256(run) END AS h, (c + 15) // 16 AS c FROM {name}r{k}
)""")
    return ", ".join(parts)


def _fold(start: str, tree: str, key: str, at: str, out: str) -> str:
    """{out}: {start} folded and its siblings collected through the levels of a tree."""
    parts, last = [], start
    for k in range(_LEVELS):
        slot = f"CAST(64 * ((d.{at} // {16 ** k}) % 16) AS BIGINT)"
        left, right = f"substr(t.run, 1, {slot})", f"substr(t.run, {slot} + 65)"
        parts.append(f"""{out}{k} AS MATERIALIZED (
  SELECT d.* EXCLUDE (f, p), CASE WHEN t.c = 1 THEN f ELSE sha256({left} || f || {right}) END AS f,
         CASE WHEN t.c = 1 THEN p ELSE p || {left} || {right} END AS p
  FROM {last} d JOIN {tree}r{k} t ON t.{key} IS NOT DISTINCT FROM d.{key} AND t.i = d.{at} // {16 ** (k + 1)}
)""")
        last = f"{out}{k}"
    return ", ".join(parts)


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
                                   for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


OP13 = f"""
WITH leaves AS MATERIALIZED (
  SELECT doc_id, source, {_leaf("text")} AS leaf,
         CASE WHEN {_CRC32} % 5 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS seen
  FROM documents
), d AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS c FROM leaves
), n0 AS (SELECT source, i, leaf AS h, c FROM d
), {_tree("n", "source")}, s0 AS MATERIALIZED (
  SELECT 0 AS one, source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, h, count(*) OVER () AS c FROM n{_LEVELS}
), {_tree("s", "one")}, start AS (
  SELECT d.doc_id, d.source, d.leaf, d.i, s0.i AS j, 0 AS one, s0.h AS subroot, coalesce(d.seen, d.leaf) AS f, '' AS p
  FROM d JOIN s0 ON s0.source IS NOT DISTINCT FROM d.source
), {_fold("start", "n", "source", "i", "a")}, {_fold(f"a{_LEVELS - 1}", "s", "one", "j", "b")}
SELECT doc_id, leaf, subroot, s{_LEVELS}.h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = s{_LEVELS}.h AS verified
FROM b{_LEVELS - 1}, s{_LEVELS}
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = f"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
OP12 = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS a FROM documents
), tfs AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(a) AS term FROM d) GROUP BY r, term
), sizes AS MATERIALIZED (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tfs GROUP BY r
), total AS MATERIALIZED (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes
), weights AS MATERIALIZED (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), total
), items AS (
  SELECT i, item_id, term, count(*) AS times
  FROM (SELECT i, item_id, unnest(a) AS term FROM (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS a FROM benchmark)) GROUP BY ALL
), scored AS (
  SELECT i, item_id, r, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
  FROM items JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes USING (r), total GROUP BY i, item_id, r
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS INTEGER) AS rank, doc_id, score
  FROM scored JOIN d USING (r) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
