"""DuckDB SQL for the queries of ``queries`` that SQL can express."""

from __future__ import annotations

from . import decontam, linededup, manifest, mixing, neardup, quality, urlfilter, warc

ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x20\x09-\x0D]+"

# Operator 1. The same keys, from the same digits of md5; plain windows.
MIXING = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
    coalesce(greatest(0.1::DOUBLE, 1 - 9 * (length(text) - length(translate(text, '{mixing.SYMBOLS}', '')))
      / greatest(length(text), 1)), 0.1::DOUBLE) AS quality,
    (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / {2**52}::DOUBLE AS u
  FROM documents
),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
p AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM s),
w AS (
  SELECT *, [{", ".join(map(str, mixing.WEIGHTS))}][(place - 1) % {len(mixing.WEIGHTS)} + 1] AS weight,
    {mixing.MAX_EPOCHS} * source_size AS cap FROM p
),
r AS (SELECT *, cap / weight AS ratio FROM w),
t AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS unit
  FROM r WINDOW b AS (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
share AS (SELECT min_by(unit, (ratio, place)) AS share FROM t WHERE unit <= ratio),
goal AS (SELECT source, source_size, least(cap::DOUBLE, weight * share) AS target FROM t, share),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM goal),
k AS (
  SELECT doc_id, d.source, size, coalesce(sum(size) OVER (
    PARTITION BY d.source ORDER BY -ln(u) / quality, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
  ), 0) AS before FROM d
),
m AS (
  SELECT doc_id, size, source_size, target, epochs,
    epochs + (size > 0 AND 2 * before + size < 2 * (target - epochs * source_size))::BIGINT AS repeats
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source
)
SELECT *, size * repeats AS taken FROM m
"""

# Operator 3. Pages are told apart by their text.
LINES = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text FROM documents),
l AS (
  SELECT rid, source, text, unnest(ls) AS l, generate_subscripts(ls, 1) AS i
  FROM (SELECT *, string_split(text, chr(10)) AS ls FROM d WHERE text IS NOT NULL)
),
n AS (
  SELECT source, l, count(DISTINCT text) AS n FROM l WHERE regexp_matches(l, '{linededup.HAS_WORD}') GROUP BY ALL
),
t AS (SELECT source, count(DISTINCT text) + max((text IS NULL)::INT) AS pages FROM d GROUP BY source),
bad AS (
  SELECT n.source, l FROM n JOIN t ON n.source IS NOT DISTINCT FROM t.source
  WHERE n >= {linededup.MIN_PAGES} AND n > {linededup.MAX_RATIO} * pages
),
k AS (
  SELECT rid, count(*) AS n_lines, count(bad.l) AS n_dropped,
    coalesce(string_agg(l.l, chr(10) ORDER BY i) FILTER (bad.l IS NULL), '') AS clean_text
  FROM l LEFT JOIN bad ON l.source IS NOT DISTINCT FROM bad.source AND l.l = bad.l GROUP BY rid
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, clean_text
FROM d LEFT JOIN k USING (rid)
"""

# Operator 7. Windows and document words are joined by text and position.
CONTAMINATION = rf"""
WITH b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{ALNUM_WORD}') AS w
  FROM benchmark WHERE text IS NOT NULL
),
p AS (
  SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS p
  FROM (SELECT *, least(len(w), {decontam.WINDOW}) AS n, unnest(range(1, len(w) - least(len(w), {decontam.WINDOW}) + 2)) AS i
        FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM p),
d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{ALNUM_WORD}') AS w
  FROM documents
),
x AS (SELECT rid, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM d),
g AS (
  SELECT rid, i, n,
    string_agg(w, ' ') OVER (PARTITION BY rid, n ORDER BY i ROWS BETWEEN CURRENT ROW AND n - 1 FOLLOWING) AS g
  FROM x, sizes
),
h AS (
  SELECT rid, i, g.n, item FROM g JOIN p ON g.n = p.n AND g = p
),
c AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS j FROM h) GROUP BY rid),
o AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, (coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w)) AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN o USING (rid)
"""

# Operator 8. Words and lines are unnested with their position; the prior is
# fitted by moments over the host rates, less what drawing documents adds to them.
QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents
),
w AS (
  SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT rid, regexp_extract_all(t, '{WORD}') AS ws FROM d)
),
counted AS (SELECT rid, count(*) AS n_words, sum(length(w)) AS word_chars FROM w GROUP BY rid),
g AS (
  SELECT rid, i, w || ' ' || lead(w, 1) OVER p || ' ' || lead(w, 2) OVER p AS g
  FROM w WINDOW p AS (PARTITION BY rid ORDER BY i)
),
twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM g WHERE g IS NOT NULL) WHERE n > 1
),
repeated AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid
),
l AS (
  SELECT rid, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '{WORD}') GROUP BY rid
),
m AS (
  SELECT doc_id, source, coalesce(n_words, 0) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN counted USING (rid) LEFT JOIN repeated USING (rid) LEFT JOIN l USING (rid)
),
j AS (
  SELECT *, (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED_PCT} * n_words)
    AS base_failed FROM m
),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS fails FROM j GROUP BY source),
s AS (SELECT avg(fails / n) AS m, var_pop(fails / n) AS v, avg(1 / n) AS a, sum(n)::DOUBLE AS total FROM h),
e AS (SELECT *, CASE WHEN a < 1 THEN (v - m * (1 - m) * a) / (1 - a) ELSE 0 END AS spread FROM s),
p AS (SELECT m, CASE WHEN spread > 0 THEN least(greatest(0, m * (1 - m) / spread - 1), total) ELSE total END AS w FROM e),
bad AS (SELECT source, true AS bad FROM h, p WHERE (fails + m * w) / (n + w) > {quality.MAX_HOST_RATE})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND bad IS NULL) AS kept
FROM j LEFT JOIN bad ON j.source IS NOT DISTINCT FROM bad.source
"""

# Operator 4. All pairs that share a shingle, then everything reachable.
NEAR = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{urlfilter.UPPER}', '{urlfilter.LOWER}'), '{WORD}') AS w
  FROM documents
),
x AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i, len(w) AS n FROM d),
g AS (
  SELECT doc_id, i, n, string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY i
    ROWS BETWEEN CURRENT ROW AND {neardup.SHINGLE - 1} FOLLOWING) AS s FROM x
),
sh AS (SELECT DISTINCT doc_id, s FROM g WHERE i = 1 OR i + {neardup.SHINGLE - 1} <= n),
z AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM c JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b
  WHERE 100 * c >= {neardup.THRESHOLD_PCT} * (x.n + y.n - c)
),
e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
low AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
  doc_id = least(doc_id, coalesce(low, doc_id)) AS kept
FROM d LEFT JOIN z USING (doc_id) LEFT JOIN low ON a = doc_id
"""

# Operator 6. What the archives hold follows from the pages alone.
WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
f AS (SELECT *, CASE WHEN n >= {warc.MIN_REVISIT_BYTES} THEN max(page_id) OVER (PARTITION BY h) END AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN first IS DISTINCT FROM page_id AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM f
"""

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in urlfilter.RULES)

# Operator 9. Steps along the links are a recursion over (kind, host) scores, until one
# adds at most a small share of what it has to any score.
URLS = rf"""
WITH RECURSIVE rules(rule_host, rule_path, v) AS (VALUES {_RULES}),
rest AS (
  SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
),
u AS (
  SELECT row_number() OVER () AS rid, page_id, html,
    translate(regexp_extract(coalesce(r, ''), '^[^/?#]*'), '{urlfilter.UPPER}', '{urlfilter.LOWER}') AS host,
    regexp_extract(coalesce(r, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM rest
),
m AS (
  SELECT rid, max({{'n': length(rule_host || rule_path), 'rule': rule_host || rule_path, 'v': v}}) AS best
  FROM u JOIN rules ON host <> '' AND (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY rid
),
j AS (SELECT u.*, best.rule AS rule, best.v AS v FROM u LEFT JOIN m USING (rid)),
hrefs AS (SELECT rid, host, unnest(regexp_extract_all(html, '{urlfilter._HREF.replace("'", "''")}', 1)) AS x FROM u),
targets AS (
  SELECT DISTINCT rid, host, translate(regexp_extract(regexp_replace(x, '^([A-Za-z][A-Za-z0-9+.-]*:)?//', ''), '^[^/?#]*'),
    '{urlfilter.UPPER}', '{urlfilter.LOWER}') AS t
  FROM hrefs WHERE regexp_matches(x, '^([A-Za-z][A-Za-z0-9+.-]*:)?//')
),
edges AS (SELECT host AS a, t AS b, count(*) AS n FROM targets WHERE host <> '' AND t <> '' AND host <> t GROUP BY ALL),
flows AS (
  SELECT 'trust' AS kind, a, b, n / sum(n) OVER (PARTITION BY a) AS w FROM edges
  UNION ALL SELECT 'distrust', b, a, n / sum(n) OVER (PARTITION BY b) FROM edges
),
seeds AS (
  SELECT host, avg((v IS NOT DISTINCT FROM 'allow')::INT) AS trust, avg((v IS NOT DISTINCT FROM 'block')::INT) AS distrust
  FROM j WHERE host <> '' GROUP BY host
),
step AS (
  SELECT 0 AS i, kind, host, x * {1 - urlfilter.DAMPING} AS x, x * {1 - urlfilter.DAMPING} AS total
  FROM (SELECT 'trust' AS kind, host, trust AS x FROM seeds UNION ALL SELECT 'distrust', host, distrust FROM seeds) WHERE x > 0
  UNION ALL
  SELECT i + 1, kind, host, sum(x), sum(total) FROM (
    SELECT i, f.kind, f.b AS host, {urlfilter.DAMPING} * x * w AS x, {urlfilter.DAMPING} * x * w AS total
    FROM step JOIN flows f ON f.kind = step.kind AND f.a = host WHERE x > 0
    UNION ALL SELECT i, kind, host, 0, total FROM step
  ) WHERE (SELECT max(x / total) FROM step) > {urlfilter.TOLERANCE} GROUP BY i, kind, host
),
scores AS (
  SELECT host, coalesce(sum(total) FILTER (kind = 'trust'), 0) AS trust, coalesce(sum(total) FILTER (kind = 'distrust'), 0) AS distrust
  FROM step WHERE i = (SELECT max(i) FROM step) GROUP BY host
)
SELECT page_id, j.host, path, rule,
  coalesce(v, CASE WHEN distrust > {urlfilter.LIMIT} * trust THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN scores ON j.host = scores.host
"""




def crc32(text: str) -> str:
    """Unsigned CRC-32 of ASCII text, byte by byte and bit by bit (fixed value:
    the polynomial 0xEDB88320)."""
    bytes_ = f"list_transform(range(1, length({text}) + 1), lambda k: ascii(substr({text}, k, 1))::BIGINT)"
    eight = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {bytes_}), lambda c, b: {eight}))"


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _tree(name: str, nodes: str) -> str:
    """CTEs ``name`` (g, lv, i, h, n: all levels above rows (g, i, h)) and ``name``_runs (the
    digests left and right of each node that has a parent)."""
    return f"""
{name} AS (
  SELECT g, 0 AS lv, i, h, count(*) OVER (PARTITION BY g) AS n FROM {nodes}
  UNION ALL
  SELECT g, lv + 1, i // {manifest.FAN}, sha256(string_agg(h, '' ORDER BY i)), (max(n) + {manifest.FAN - 1}) // {manifest.FAN}
  FROM {name} WHERE n > 1 GROUP BY g, lv, i // {manifest.FAN}
),
{name}_runs AS (
  SELECT g, lv, i,
    coalesce(string_agg(h, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name} WHERE n > 1 WINDOW r AS (PARTITION BY g, lv, i // {manifest.FAN} ORDER BY i)
)"""


def _fold(name: str, start: str, runs: str) -> str:
    """CTEs ``name`` (rows (rid, g, lv, i, h, proof) on their way up) and ``name``_end (where it
    ends)."""
    return f"""
{name} AS (
  SELECT rid, g, 0 AS lv, i, h, proof FROM {start}
  UNION ALL
  SELECT rid, f.g, f.lv + 1, f.i // {manifest.FAN}, sha256(l || h || r), proof || l || r
  FROM {name} f JOIN {runs} s ON s.g = f.g AND s.lv = f.lv AND s.i = f.i
),
{name}_end AS (SELECT rid, arg_max(g, lv) AS g, arg_max(h, lv) AS h, arg_max(proof, lv) AS proof FROM {name} GROUP BY rid)"""


_LEAF = "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
_LOWERED = f"translate(text, '{urlfilter.UPPER}', '{urlfilter.LOWER}')"

# Operator 12. Trees and ways are recursions by level.
MANIFEST = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('+' || lang, '') AS g, {_LEAF.format(text="text")} AS leaf,
    CASE WHEN {crc32("doc_id::VARCHAR")} % 3 = 0 THEN {_LEAF.format(text=_LOWERED)} END AS other
  FROM documents
),
l AS (
  SELECT *, coalesce(other, leaf) AS repl,
    row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, coalesce(other, leaf)) - 1 AS i FROM d
),
nodes AS (SELECT g, i, leaf AS h FROM l),
{_tree("t", "nodes")},
sub AS (SELECT g AS own, '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, h FROM t WHERE n = 1),
{_tree("u", "sub")},
start AS (SELECT rid, g, i, repl AS h, '' AS proof FROM l),
{_fold("f", "start", "t_runs")},
higher AS (SELECT rid, '' AS g, i, f_end.h, proof FROM f_end JOIN sub ON own = f_end.g),
{_fold("e", "higher", "u_runs")}
SELECT doc_id, leaf, sub.h AS subroot, u.h AS root, sha256(proof) AS proof_sha256, e_end.h AS folded_root, e_end.h = u.h AS verified
FROM l JOIN sub ON own = l.g JOIN e_end USING (rid), u WHERE u.n = 1
"""


# Operator 11. Prefixes as joined turn ids; sums over all ancestors of each node.
TRIE = f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, length(coalesce(text, '')) AS size, turn,
    md5(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS tid
  FROM conversations WHERE conv_id IS NOT NULL
),
o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, tid) AS pos FROM t),
cs AS (SELECT c, c - c % 100 AS base, {crc32("c::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT c FROM t)),
r AS (
  SELECT cs.c, 1 AS part, pos, tid, size FROM cs JOIN o ON o.c = base AND pos <= h
  UNION ALL SELECT cs.c, 2, pos, tid, size FROM cs JOIN o ON o.c = cs.c AND pos > h
),
k AS (
  SELECT cs.c, coalesce(list(tid ORDER BY part, pos) FILTER (tid IS NOT NULL), []) AS ids,
    coalesce(list(size ORDER BY part, pos) FILTER (tid IS NOT NULL), []) AS sizes
  FROM cs LEFT JOIN r ON r.c = cs.c GROUP BY cs.c
),
p AS (SELECT c, unnest(range(0, len(ids) + 1)) AS d, ids, sizes FROM k),
m AS (SELECT c, d, array_to_string(ids[1:d], '') AS id, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size, d = len(ids) AS ends FROM p),
n AS (
  SELECT id, max(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM m GROUP BY id
),
ch AS (SELECT left(id, length(id) - 32) AS id, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch USING (id)),
a AS (SELECT unnest(range(0, depth + 1)) AS up, id, n_children, saved FROM v),
s AS (
  SELECT left(id, up * 32) AS id, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM a GROUP BY ALL
)
SELECT v.conv_id, v.depth, x.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, v.ends_sha256
FROM v JOIN s USING (id) LEFT JOIN v x ON v.depth > 0 AND x.id = left(v.id, length(v.id) - 32)
"""


def over(sql: str, documents: str) -> str:
    """A query over another table of documents."""
    return "(" + sql.replace("FROM documents", f"FROM {documents}") + ")"


# The pipeline: each operator's SQL over what the stage before kept.
PIPELINE = f"""
WITH s1 AS MATERIALIZED (
  SELECT d.* FROM documents d JOIN {over(QUALITY, "documents")} q USING (doc_id) WHERE kept
),
s2 AS MATERIALIZED (
  SELECT doc_id, clean_text AS text, lang, source, CASE WHEN n_dropped > 0 THEN length(clean_text) ELSE n_chars END AS n_chars
  FROM s1 JOIN {over(LINES, "s1")} l USING (doc_id)
),
s3 AS MATERIALIZED (SELECT d.* FROM s2 d JOIN {over(NEAR, "s2")} n USING (doc_id) WHERE kept),
s4 AS MATERIALIZED (SELECT d.* FROM s3 d JOIN {over(CONTAMINATION, "s3")} c USING (doc_id) WHERE NOT contaminated)
SELECT d.*, m.size AS mix_size, m.source_size AS mix_source_size, m.target AS mix_target, m.repeats AS mix_repeats
FROM s4 d JOIN {over(MIXING, "s4")} m USING (doc_id) WHERE repeats > 0
"""

SQL = {
    "op1_mixing": MIXING,
    "op3_line_dedup": LINES,
    "op4_near_duplicates": NEAR,
    "op6_warc": WARC,
    "op7_decontamination": CONTAMINATION,
    "op8_quality_rules": QUALITY,
    "op9_url_filters": URLS,
    "op11_prefix_trie": TRIE,
    "op12_merkle_manifest": MANIFEST,
}
