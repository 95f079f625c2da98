"""DuckDB SQL for the queries that SQL can express, by query name."""

ORACLE: dict[str, str] = {}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NORMAL = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE["op1_decontaminate"] = f"""
WITH d AS (SELECT doc_id, coalesce({_NORMAL.format('text')}, []) AS w FROM documents),
b AS (SELECT item_id, {_NORMAL.format('text')} AS w FROM benchmark WHERE text IS NOT NULL),
items AS (SELECT item_id, unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ') FOR i IN range(1, greatest(len(w) - 9, 1) + 1)]) AS win,
                 least(len(w), 10) AS n FROM b WHERE len(w) > 0),
pats AS (SELECT DISTINCT item_id, win, n FROM items),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
hits AS (SELECT p.doc_id, p.i, pats.n, pats.item_id FROM pos p, (SELECT DISTINCT n FROM pats) ns, pats
         WHERE pats.n = ns.n AND p.i + ns.n - 1 <= len(p.w) AND pats.win = array_to_string(p.w[p.i:p.i + ns.n - 1], ' ')),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(words.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(found.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(found.s, '')) AS items_sha256,
       coalesce(words.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

# The shuffle and the water level are restated here: queues in md5 order, copies by virtual finish time.
ORACLE["op8_mix"] = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                  md5('8|' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CAST(((row_number() OVER (ORDER BY source COLLATE "binary" ASC NULLS LAST) - 1) % 3) + 1 AS DOUBLE) AS w
      FROM d GROUP BY source),
f AS (SELECT *, CAST(3 * source_size AS DOUBLE) AS cap, CAST(3 * source_size AS DOUBLE) / w AS fill,
             CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM s),
l AS (SELECT *, (total - (sum(cap) OVER o - cap)) / (sum(w) OVER () - sum(w) OVER o + w) AS level FROM f
      WINDOW o AS (ORDER BY fill, source ASC NULLS LAST ROWS UNBOUNDED PRECEDING)),
m AS (SELECT min(fill) AS fill, arg_min(level, fill) AS level FROM l WHERE fill > level),
t AS (SELECT l.source, source_size, CASE WHEN m.fill IS NULL OR l.fill < m.fill THEN cap ELSE w * m.level END AS target FROM l, m),
q AS (SELECT d.doc_id, d.source, d.key, d.size, t.source_size, t.target,
             CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key ROWS UNBOUNDED PRECEDING) AS BIGINT) AS done
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT q.*, CAST(r * source_size + done AS DOUBLE) / target AS finish FROM q, range(3) x(r) WHERE size > 0),
g AS (SELECT *, sum(size) OVER (ORDER BY finish, source ASC NULLS LAST, key ROWS UNBOUNDED PRECEDING) AS run FROM c),
k AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS copies FROM g WHERE run <= (SELECT sum(size) FROM d) GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(q.size * coalesce(k.copies, 0) AS BIGINT) AS taken
FROM q LEFT JOIN k USING (doc_id)
"""

# Least id reachable over links, by closure (for the small tables of a check).
_CLOSURE = """
reach(node, root) AS (SELECT {id}, {id} FROM {nodes} UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
comp AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
"""

ORACLE["op2_vector_links"] = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
u AS (SELECT vec_id, x, list_dot_product(x, x) AS sq FROM v
      WHERE x IS NOT NULL AND len(x) > 0 AND len([c FOR c IN x IF c IS NULL OR NOT isfinite(c)]) = 0),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM u p JOIN u q ON p.vec_id <> q.vec_id AND len(p.x) = len(q.x)
          WHERE p.sq > 0 AND q.sq > 0 AND list_dot_product(p.x, q.x) / sqrt(p.sq * q.sq) >= 0.95),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a),
{_CLOSURE.format(id='vec_id', nodes='v')}
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, comp.component_id, v.vec_id = comp.component_id AS kept
FROM v JOIN comp ON comp.node = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""

ORACLE["op4_ngram_join"] = rf"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format('text')}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE list_distinct([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)]) END AS g FROM w),
t AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
common AS (SELECT g FROM t GROUP BY g HAVING count(*) > 1),
both_ AS (SELECT p.doc_id AS a, q.doc_id AS b, any_value(p.n) AS n, any_value(q.n) AS m, count(*) AS k
          FROM t p JOIN common USING (g) JOIN t q USING (g) WHERE p.doc_id <> q.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM both_ WHERE 100 * k >= 90 * (n + m - k)),
{_CLOSURE.format(id='doc_id', nodes='s')}
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, comp.component_id FROM s JOIN comp ON comp.node = s.doc_id
"""

_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _matches(kind: int, name: str, pattern: str, group: int, keep: str) -> str:
    """Matches with their offsets: what stands between them, and they themselves, summed up."""
    return f"""SELECT doc_id, source, lang, {kind} AS kind, '{name}' AS name, s AS secret,
    CAST(sum(g + n) OVER o - n AS BIGINT) AS start, CAST(sum(g + n) OVER o AS BIGINT) AS "end", {keep} AS keep
  FROM (SELECT doc_id, source, lang, i, length(m[i]) AS n, length(gaps[i]) AS g, ss[i] AS s FROM (
    SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT doc_id, source, lang, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {group}) AS ss,
             string_split_regex(t, '{pattern}') AS gaps FROM d)))
  WINDOW o AS (PARTITION BY doc_id ORDER BY i)"""


ORACLE["op6_secret_scan"] = f"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents),
every AS ({_matches(0, 'assign', _ASSIGN, 1, 'length(s) >= 6')} UNION ALL {_matches(1, 'access', 'AKIA[A-Z0-9]+', 0, 'length(s) >= 20')}
  UNION ALL {_matches(2, 'hex', '[0-9a-f]+', 0, 'length(s) >= 24')}
  UNION ALL {_matches(3, 'owned', '[A-Za-z0-9+/_-]+', 0, "length(s) >= 32 AND regexp_matches(s, '[0-9]') AND regexp_matches(s, '[A-Za-z]')")}),
kept AS (SELECT * FROM every WHERE keep),
free AS (SELECT * FROM kept k WHERE kind < 3 OR NOT EXISTS (SELECT 1 FROM kept b WHERE b.kind < 3 AND b.doc_id = k.doc_id
         AND b.start < k."end" AND k.start < b."end")),
owners AS (SELECT secret, count(DISTINCT coalesce('=' || source, 'null')) AS n FROM free GROUP BY secret),
judged AS (SELECT free.*, owners.n <= 1 AS live FROM free JOIN owners USING (secret)),
listed AS (SELECT *, name || ':' || start || ':' || "end" AS s FROM judged WHERE kind < 3 OR live),
per AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
               string_agg(s, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(s, ',' ORDER BY start, kind) AS spans,
               count(*) FILTER (kind = 3) AS n_owned, count(*) FILTER (live) AS n_live FROM listed GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       CAST(coalesce(n_owned, 0) AS BIGINT) AS n_owned, CAST(coalesce(n_live, 0) AS BIGINT) AS n_live
FROM d LEFT JOIN per USING (doc_id)
"""

# crc32 by its table, which a list of 256 makes; prefixes are lists of turns.
ORACLE["op12_conversation_trie"] = r"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
                      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
seqs AS (SELECT conv_id AS c, list({'r': coalesce(role, ''), 'x': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS s
         FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (SELECT c, s, CAST(xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
            lambda a, b: xor(a >> 8, tab[CAST(xor(a, b) & 255 AS BIGINT) + 1])), 4294967295) % 4 AS BIGINT) AS h FROM seqs, crc),
reb AS (SELECT a.c, list_concat(coalesce(b.s[1:a.h], []), a.s[a.h + 1:]) AS s FROM heads a LEFT JOIN seqs b ON b.c = a.c - a.c % 20),
pref AS (SELECT c, d, s[1:d] AS p, len(s) = d AS here FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM reb)),
node AS (SELECT p, d, min(c) AS conv_id, count(*) AS n, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE here) AS ends,
                CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(p[d].x, '[^\x20\x09-\x0D]+')) END AS words FROM pref GROUP BY p, d),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1),
own AS (SELECT node.*, coalesce(n_children, 0) AS n_children, (n - 1) * words AS saved FROM node LEFT JOIN kids USING (p)),
sums AS (SELECT p, CAST(sum(saved) AS BIGINT) AS saved_tokens, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves
         FROM (SELECT o.p[1:o.a] AS p, saved, n_children FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM own) o) GROUP BY p)
SELECT own.conv_id, CAST(own.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, CAST(own.n AS BIGINT) AS n_convs,
       CAST(own.n_children AS BIGINT) AS n_children, n_leaves, saved_tokens, sha256(coalesce(own.ends, '')) AS ends_sha256
FROM own JOIN sums USING (p) LEFT JOIN own up ON own.d > 0 AND up.p = own.p[1:own.d - 1]
"""


def _vector_codes(entries: int = 256, parts: int = 4, rounds: int = 4) -> str:
    """Every round restated: all distances as dot products of whole numbers (exact in doubles), then floors of means."""
    steps = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, [floor(1024 * CAST(c AS DOUBLE)) FOR c IN embedding] AS x FROM embeddings
      WHERE embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0)""",
             f"""q AS MATERIALIZED (SELECT r, p, x, list_dot_product(x, x) AS sq FROM (
      SELECT r, p, x[p * (len(x) // {parts}) + 1:(p + 1) * (len(x) // {parts})] AS x FROM v, range({parts}) t(p)))""",
             f"""b0 AS MATERIALIZED (SELECT p, k, x, sq FROM q JOIN (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, x) - 1 AS k FROM v) USING (r)
      WHERE k < {entries})"""]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (SELECT r, p, best % {entries} AS k, best // {entries} AS d FROM (
      SELECT q.r, q.p, min(CAST(q.sq + b.sq - 2 * list_dot_product(q.x, b.x) AS BIGINT) * {entries} + b.k) AS best
      FROM q JOIN b{n} b USING (p) GROUP BY q.r, q.p))""")
        if n < rounds:
            steps.append(f"""s{n} AS (SELECT p, k, list((s - ((s % c) + c) % c) // c ORDER BY i) AS x FROM (
      SELECT p, k, i, count(*) AS c, sum(CAST(e AS BIGINT)) AS s FROM (
        SELECT p, k, unnest(x) AS e, generate_subscripts(x, 1) AS i FROM a{n} JOIN q USING (r, p)) GROUP BY p, k, i) GROUP BY p, k)""")
            steps.append(f"""b{n + 1} AS MATERIALIZED (SELECT p, k, x, list_dot_product(x, x) AS sq FROM (
      SELECT b.p, b.k, coalesce(CAST(s.x AS DOUBLE[]), b.x) AS x FROM b{n} b LEFT JOIN s{n} s ON b.p = s.p AND b.k = s.k))""")
    steps.append(f"""coded AS (SELECT r, string_agg(format('{{:02x}}', k), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r)""")
    steps.append(f"""book AS (SELECT sha256(string_agg(array_to_string([CAST(CAST(c AS BIGINT) AS VARCHAR) FOR c IN x], ','), ',' ORDER BY p, k)) AS h FROM b{rounds})""")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM v JOIN coded USING (r), book"""


ORACLE["op13_vector_codes"] = _vector_codes()
