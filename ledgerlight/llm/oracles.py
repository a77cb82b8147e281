"""DuckDB forms of the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP2 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
pos AS (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2),
win AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x FROM pos),
hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM hit) GROUP BY r),
lines AS (SELECT r, line FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r),
m AS (SELECT d.r, doc_id, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
             coalesce(dup.n_lines, 0) AS n_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN rep USING (r) LEFT JOIN dup USING (r)),
f AS (SELECT *, n_words < 50 AS f1, 100 * n_repeat_words > 50 * n_words AS f2,
             100 * n_symbols > 30 * n_words AS f3, 100 * n_dup_lines > 50 * n_lines AS f4 FROM m),
host AS (SELECT source, rule, count(*) AS n, count(*) FILTER (failed) AS k
         FROM (SELECT source, unnest([1, 2, 3, 4]) AS rule, unnest([f1, f2, f3, f4]) AS failed FROM f) GROUP BY ALL),
prior AS (SELECT rule, avg(k / n) AS mu, var_pop(k / n) AS v FROM host GROUP BY rule),
strength AS (SELECT rule, mu, CASE WHEN v <= 0 THEN 1e6 ELSE least(greatest(mu * (1 - mu) / v - 1, 1.0), 1e6) END AS s FROM prior),
bad AS (SELECT coalesce(source, chr(0)) AS source, bool_or((k + mu * s) / (n + s) > 0.8) AS bad FROM host JOIN strength USING (rule) GROUP BY 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
       NOT (f1 OR f2) AND NOT bad.bad AS kept
FROM f JOIN bad ON coalesce(f.source, chr(0)) = bad.source
"""

OP3 = rf"""
WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix-1'), 1, 13))::BIGINT AS place FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][rank % 3 + 1] AS weight, 2 * source_size AS cap FROM s),
l AS (SELECT *, sum(cap) OVER o - cap AS c0, sum(weight) OVER o - weight AS w0 FROM w
      WINDOW o AS (ORDER BY cap / weight, rank ROWS UNBOUNDED PRECEDING)),
lv AS (SELECT max((1.5 * t.total - c0) / (t.weights - w0)) AS level, any_value(t.total) AS total
       FROM l, (SELECT sum(source_size) AS total, sum(weight) AS weights FROM w) t),
t AS (SELECT w.*, least(cap::DOUBLE, (level * weight)::DOUBLE) AS target, total FROM w, lv),
q AS (SELECT d.*, t.rank, t.source_size, t.target, t.total,
             sum(size) OVER (PARTITION BY t.rank ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS cum
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN target > 0 THEN (copy * source_size + cum) / target ELSE 0 END AS finish FROM q, (SELECT unnest([0, 1]) AS copy)),
r AS (SELECT *, sum(size) OVER (ORDER BY finish, rank, cum ROWS UNBOUNDED PRECEDING) AS run FROM e)
SELECT doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
       coalesce(sum(size) FILTER (run <= 1.5 * total), 0)::BIGINT AS taken
FROM r GROUP BY doc_id, place, cum, rank
"""

OP9 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS keeper FROM p),
b AS (SELECT *, list_transform(range(4), lambda k: ('0x' || substr(hex, (10 * k + 1)::INTEGER, 10))::BIGINT) AS parts FROM d)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(parts, lambda v: list_aggregate(list_transform(range(8),
           lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((v >> (35 - 5 * i)) & 31) + 1)::INTEGER, 1)), 'string_agg', '')),
           'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN NULL ELSE keeper END AS refers_to
FROM b
"""

OP6 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, x FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) = 1 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS x
        FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 80 * (na.n + nb.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(id, seen) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.id, e.b FROM r JOIN e ON r.seen = e.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.seen) AS component_id, d.doc_id = min(r.seen) AS kept
FROM d JOIN r ON r.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""

OP4 = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda e: isfinite(e)))
      AND list_bool_or(list_transform(embedding, lambda e: e <> 0))),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
r(id, seen) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, e.b FROM r JOIN e ON r.seen = e.a),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT r.id AS vec_id, coalesce(any_value(n.n), 0)::BIGINT AS n_links, min(r.seen) AS component_id, r.id = min(r.seen) AS kept
FROM r LEFT JOIN n ON n.a = r.id GROUP BY r.id
"""

OP12 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT r, doc_id, i, array_to_string(w[i:i + 19], ' ') AS x FROM (SELECT *, unnest(range(1, len(w) - 18)) AS i FROM d)),
rep AS (SELECT r, i FROM win QUALIFY row_number() OVER (PARTITION BY x ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + 20)) AS p FROM rep)),
pos AS (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM pos ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


def _merkle_sql(levels: int = 6, group_levels: int = 3) -> str:
    """The manifest with a fixed number of levels, unrolled (8**6 documents a language, 8**3 languages)."""
    def field(c):
        return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')"

    def leaf(text):
        return "sha256(" + " || ".join([*map(field, ("doc_id", "source", "lang", "n_chars")), field(text)]) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    byte = "lambda a, c: list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, i: xor(x >> 1, (x & 1) * 3988292384))"
    crc = (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), "
           f"lambda c: ascii(c)::BIGINT)), {byte}), 4294967295)")
    parts = [f"d AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {leaf('text')} AS leaf, "
             f"CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS seen FROM documents)",
             "t AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf) - 1 AS pos FROM d)",
             "a0 AS (SELECT g, pos, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM t)",
             "p0 AS (SELECT *, '' AS proof, seen AS f FROM t)"]

    def climb(nodes, k, rows, key):
        up, runs, out = f"{nodes}{k + 1}", f"{nodes}r{k}", f"{rows}{k + 1}"
        parts.append(f"{runs} AS (SELECT g, pos // 8 AS run, any_value(n) AS n, list(h ORDER BY pos) AS hs FROM {nodes}{k} GROUP BY g, pos // 8)")
        parts.append(f"{up} AS (SELECT g, run AS pos, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) "
                     f"ELSE hs[1] END AS h FROM {runs})")
        slot = f"(({key} // {8 ** k}) % 8)::INTEGER"
        before, after = f"array_to_string(hs[1:{slot}], '')", f"array_to_string(hs[{slot} + 2:], '')"
        parts.append(f"{out} AS (SELECT x.* EXCLUDE (proof, f), CASE WHEN n > 1 THEN proof || {before} || {after} ELSE proof END AS proof, "
                     f"CASE WHEN n > 1 THEN sha256({before} || f || {after}) ELSE f END AS f "
                     f"FROM {rows}{k} x JOIN {runs} r ON r.g = x.{'g' if nodes == 'a' else 'top'} AND r.run = {key} // {8 ** (k + 1)})")

    for k in range(levels):
        climb("a", k, "p", "pos")
    parts += [f"s AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS place FROM a{levels})",
              "b0 AS (SELECT '' AS g, place AS pos, subroot AS h, count(*) OVER () AS n FROM s)",
              f"q0 AS (SELECT x.*, subroot, place, '' AS top FROM p{levels} x JOIN s USING (g))"]
    for k in range(group_levels):
        climb("b", k, "q", "place")
    return f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, b.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, " \
           f"f = b.h AS verified FROM q{group_levels} JOIN b{group_levels} b ON true"


OP11 = _merkle_sql()
