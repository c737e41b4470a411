"""DuckDB SQL for the queries that SQL can express."""

OP2 = r"""
WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines, row_number() OVER () AS r FROM documents),
l AS (SELECT r, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT r, source, i, line, trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS t FROM l),
p AS (SELECT source, text, min(r) AS r FROM d GROUP BY source, text),
n AS (SELECT source, count(*) AS pages FROM p GROUP BY source),
c AS (SELECT k.source, t, count(DISTINCT r) AS n FROM k SEMI JOIN p USING (r) WHERE t <> '' GROUP BY k.source, t),
b AS (SELECT c.source, c.t FROM c JOIN n ON c.source IS NOT DISTINCT FROM n.source
      WHERE c.n >= 4 AND c.n::DOUBLE / n.pages > 0.02),
m AS (SELECT k.*, b.t IS NOT NULL AS bad FROM k LEFT JOIN b ON k.source IS NOT DISTINCT FROM b.source AND k.t = b.t),
g AS (SELECT r, coalesce(string_agg(CASE WHEN NOT bad THEN line END, chr(10) ORDER BY i), '') AS text,
             sum(CASE WHEN bad THEN 1 ELSE 0 END)::BIGINT AS n_dropped FROM m GROUP BY r)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE g.text END AS text, coalesce(g.n_dropped, 0)::BIGINT AS n_dropped
FROM d LEFT JOIN g USING (r)
"""

OP5 = r"""
WITH d AS (SELECT doc_id, source, md5(concat_ws(':', doc_id::VARCHAR, md5(text))) AS turn,
                  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM d GROUP BY source),
w AS (SELECT source, source_size, CASE nth % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END::BIGINT AS weight, 2 * source_size AS cap FROM p),
f AS (SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5 - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
                / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
      FROM w WINDOW o AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST)),
c AS (SELECT *, cap::DOUBLE <= weight * level AS capped FROM f),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE weight *
             (SELECT arg_min(level, cap::DOUBLE / weight) FROM c WHERE NOT capped) END AS target FROM c),
q AS (SELECT d.doc_id, d.source, turn, size, source_size, target,
             sum(size) OVER (PARTITION BY d.source ORDER BY turn, d.doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto, row_number() OVER () AS r
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
x AS (SELECT *, CASE WHEN target > 0 THEN (lap * source_size + upto)::DOUBLE / target ELSE 0 END AS finish
      FROM q, (SELECT unnest([0, 1])::BIGINT AS lap)),
s AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, turn, doc_id, size, lap ROWS UNBOUNDED PRECEDING)::DOUBLE AS run FROM x),
b AS (SELECT sum(size)::DOUBLE * 1.5 AS budget FROM d)
SELECT any_value(doc_id) AS doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
       sum(CASE WHEN run <= (SELECT budget FROM b) THEN size ELSE 0 END)::BIGINT AS taken
FROM s GROUP BY r
"""

OP4 = """
WITH v AS (SELECT DISTINCT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.e, x.e)::BIGINT AS score
      FROM v q JOIN v x ON q.vec_id % 50 = 0 AND x.vec_id <> q.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
"""


def _merkle_part(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"


#: CRC-32 of a decimal number, bit by bit (reflected polynomial 0xEDB88320).
_CRC = """xor(list_reduce(flatten([[ascii(c) + 256, -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(doc_id::VARCHAR, '')]),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, (x - 256)::BIGINT) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, 4294967295::BIGINT), 4294967295)"""

#: Trees and proofs level by level; ``way`` folds the original leaf and the tampered one at once.
OP12 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, row_number() OVER () AS doc,
         sha256({" || ".join(_merkle_part(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS leaf,
         CASE WHEN {_CRC} % 5 = 0 THEN sha256({" || ".join(_merkle_part(c) for c in ("doc_id", "source", "lang", "n_chars"))} ||
              {_merkle_part("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS bad FROM documents),
g AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) AS n FROM d GROUP BY source),
l AS (SELECT d.*, g.tree, g.n, row_number() OVER (PARTITION BY g.tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
up AS (
  SELECT 0 AS lvl, tree, n, r, leaf AS h FROM l
  UNION ALL
  SELECT lvl + 1, tree, (n + 15) // 16, r // 16, sha256(string_agg(h, '' ORDER BY r)) FROM up WHERE n > 1 GROUP BY lvl, tree, n, r // 16),
sub AS (SELECT tree, h AS subroot FROM up WHERE n = 1),
top AS (
  SELECT 0 AS lvl, (SELECT count(*) FROM sub) AS n, tree AS r, subroot AS h FROM sub
  UNION ALL
  SELECT lvl + 1, (n + 15) // 16, r // 16, sha256(string_agg(h, '' ORDER BY r)) FROM top WHERE n > 1 GROUP BY lvl, n, r // 16),
root AS (SELECT h AS root FROM top WHERE n = 1),
nodes AS (SELECT FALSE AS upper, lvl, tree, n, r, h FROM up UNION ALL SELECT TRUE, lvl, 0, n, r, h FROM top),
sib AS (SELECT a.upper, a.lvl, a.tree, a.r, a.n, coalesce(string_agg(b.h, '' ORDER BY b.r) FILTER (b.r < a.r), '') AS lft,
               coalesce(string_agg(b.h, '' ORDER BY b.r) FILTER (b.r > a.r), '') AS rgt
        FROM nodes a JOIN nodes b ON a.upper = b.upper AND a.lvl = b.lvl AND a.tree = b.tree AND a.r // 16 = b.r // 16
        GROUP BY a.upper, a.lvl, a.tree, a.r, a.n),
way AS (
  SELECT doc, tree AS home, FALSE AS upper, 0 AS lvl, tree, r, coalesce(bad, leaf) AS f, '' AS proof FROM l
  UNION ALL
  SELECT w.doc, w.home, w.upper OR s.n = 1, CASE WHEN s.n = 1 THEN 0 ELSE w.lvl + 1 END, CASE WHEN s.n = 1 THEN 0 ELSE w.tree END,
         CASE WHEN s.n = 1 THEN w.home ELSE w.r // 16 END,
         CASE WHEN s.n = 1 THEN w.f ELSE sha256(s.lft || w.f || s.rgt) END, w.proof || s.lft || s.rgt
  FROM way w JOIN sib s ON s.upper = w.upper AND s.lvl = w.lvl AND s.tree = w.tree AND s.r = w.r
  WHERE NOT (w.upper AND s.n = 1)),
done AS (SELECT w.* FROM way w JOIN sib s ON s.upper = w.upper AND s.lvl = w.lvl AND s.tree = w.tree AND s.r = w.r WHERE w.upper AND s.n = 1)
SELECT l.doc_id, l.leaf, sub.subroot, root.root, sha256(done.proof) AS proof_sha256, done.f AS folded_root, done.f = root.root AS verified
FROM l JOIN done USING (doc) JOIN sub ON sub.tree = l.tree CROSS JOIN root
"""

OP13 = """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
                  [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0),
a AS (SELECT *, row_number() OVER () AS nth FROM v WHERE vec_id % 50 = 0),
s AS (SELECT a.nth, a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same, list_inner_product(a.e, x.e)::BIGINT AS score
      FROM a JOIN v x ON x.vec_id <> a.vec_id),
p AS (SELECT nth, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY nth ORDER BY score DESC, vec_id) AS slot
      FROM s WHERE same),
n AS (SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.nth, slot ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
      FROM p JOIN s USING (nth, anchor_id) WHERE slot <= 5 AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT * FROM n WHERE rank <= 3
"""
