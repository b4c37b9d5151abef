"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
i AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, {_WORDS.format("text")} AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, array_to_string(list_slice(w, s, s + 9), ' ') AS win, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM wins),
places AS (
  SELECT doc_id, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d CROSS JOIN lens)),
occ AS (SELECT DISTINCT doc_id, s, n, item_id FROM places JOIN wins USING (win, n)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM occ) GROUP BY doc_id),
ids AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items
        FROM occ GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN ids ON d.doc_id = ids.doc_id
"""

_NAMES = ("([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
          "|[aA][pP][iI]_?[kK][eE][yY])")
_PATTERNS = {
    "assign": (_NAMES + """["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]{24,}", 0, 24),
    "provider": ("gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|[sr]k_live_[A-Za-z0-9]{16,}"
                 "|AIza[A-Za-z0-9_-]{35}|-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
}
_KIND_ROWS = " UNION ALL ".join(
    f"SELECT doc_id, source, {rank} AS rank, '{kind}' AS kind, {least} AS least, regexp_extract_all(t, '{p}', 0) AS m, "
    f"regexp_extract_all(t, '{p}', {group}) AS g, regexp_split_to_array(t, '{p}') AS b FROM t WHERE regexp_matches(t, '{p}')"
    for rank, (kind, (p, group, least)) in enumerate(_PATTERNS.items()))

SECRETS = f"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
k AS ({_KIND_ROWS}),
one AS (SELECT doc_id, source, rank, kind, least, unnest(m) AS m, unnest(g) AS g, unnest(b[1:len(m)]) AS b,
        unnest(range(1, len(m) + 1)) AS n FROM k),
pos AS (SELECT *, CAST(sum(length(b) + length(m)) OVER (PARTITION BY doc_id, rank ORDER BY n) AS BIGINT) AS e FROM one),
f AS (SELECT doc_id, source, rank, kind, e - length(m) AS s, e, g AS v FROM pos WHERE length(g) >= least),
own AS (SELECT v, count(DISTINCT source) AS n_owners FROM f GROUP BY v),
j AS (SELECT f.*, n_owners >= 3 AS example, n_owners < 3 AND regexp_matches(f.v, '[0-9]')
        AND len(list_distinct(string_split(f.v, ''))) >= 8 AS live FROM f JOIN own USING (v)),
a AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS na, count(*) FILTER (kind = 'access') AS nc,
        count(*) FILTER (kind = 'hex') AS nh, count(*) FILTER (live) AS nl, count(*) FILTER (example) AS ne,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (kind <> 'provider') AS base
      FROM j GROUP BY doc_id)
SELECT t.doc_id, coalesce(na, 0) AS n_assign, coalesce(nc, 0) AS n_access, coalesce(nh, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(nl, 0) AS n_live, coalesce(ne, 0) AS n_example
FROM t LEFT JOIN a ON t.doc_id = a.doc_id
"""

# the usual reflected polynomial of crc32, bit by bit over the decimal id
_CRC32 = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
    string_split({0}, ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a % 2) * 3988292384) END), 4294967295)"""

TRIE = f"""
WITH t AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS w
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, w, {_CRC32.format("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM t),
r AS (SELECT h.conv_id, list_concat(coalesce(list_slice(b.w, 1, h), []), list_slice(h.w, h + 1, len(h.w))) AS w
      FROM h LEFT JOIN t b ON b.conv_id = h.conv_id - h.conv_id % 100),
q AS (SELECT conv_id, len(w) AS length, d, list_slice(w, 1, d) AS s FROM (SELECT *, unnest(range(0, len(w) + 1)) AS d FROM r)),
nodes AS (
  SELECT d, s, count(*) AS n_convs, min(conv_id) AS conv_id, max(length) = d AS leaf,
    string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (length = d) AS ends
  FROM q GROUP BY d, s),
kids AS (SELECT d - 1 AS d, list_slice(s, 1, d - 1) AS s, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
subs AS (
  SELECT a AS d, list_slice(s, 1, a) AS s, count(*) FILTER (leaf) AS leaves,
    sum(CASE WHEN d > 0 THEN (n_convs - 1) * length(s[d].x) ELSE 0 END) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM nodes) GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children,
  leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN subs ON subs.d = n.d AND subs.s = n.s LEFT JOIN kids ON kids.d = n.d AND kids.s = n.s
LEFT JOIN nodes up ON up.d = n.d - 1 AND up.s = list_slice(n.s, 1, n.d - 1)
"""


def similar_sets(words: int, percent: int, more: str = "") -> str:
    """Components of links between the documents' sets of word shingles."""
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {words} + 2), lambda i: array_to_string(list_slice(w, i, i + {words} - 1), ' ')) END) AS g
  FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
sets AS (SELECT n, sha256(string_agg(g, chr(10) ORDER BY g)) AS content, doc_id FROM s JOIN n USING (doc_id) GROUP BY doc_id, n),
one AS (SELECT content, n, min(doc_id) AS a FROM sets GROUP BY content, n),
o AS (SELECT a, n, g FROM one JOIN s ON doc_id = a),
pairs AS (SELECT x.a AS a, y.a AS b, any_value(x.n + y.n) AS total, count(*) AS shared FROM o x JOIN o y
         ON x.g = y.g AND x.a < y.a AND 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) GROUP BY x.a, y.a),
link AS (SELECT a, b FROM pairs WHERE 100 * shared >= {percent} * (total - shared)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
walk AS (SELECT a, a AS b FROM one UNION SELECT walk.a, edge.b FROM walk JOIN edge ON walk.b = edge.a),
low AS (SELECT a, min(b) AS low FROM walk GROUP BY a)
SELECT *{more} FROM (
  SELECT d.doc_id, CAST(coalesce(sets.n, 0) AS BIGINT) AS n_shingles, coalesce(low.low, d.doc_id) AS component_id
  FROM d LEFT JOIN sets USING (doc_id) LEFT JOIN one USING (content) LEFT JOIN low ON low.a = one.a)
"""
