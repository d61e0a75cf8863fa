"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

#: Water level by prefix sums over sources in order of limit / weight: the level is that
#: of the smallest prefix whose next source stays below its limit.
OP2 = r"""
WITH rows AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS h,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
ranked AS (
  SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight,
         (3 * source_size)::DOUBLE AS cap
  FROM sizes),
ordered AS (
  SELECT *, cap / weight AS reach,
         coalesce(sum(cap) OVER w, 0) AS full_before,
         (SELECT sum(weight) FROM ranked) - coalesce(sum(weight) OVER w, 0) AS open_weight
  FROM ranked
  WINDOW w AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT coalesce(arg_min(l, reach), 0) AS level FROM (
    SELECT ((SELECT sum(source_size) FROM sizes) - full_before) / open_weight AS l, reach FROM ordered)
  WHERE reach > l),
targets AS (
  SELECT source, source_size, least(cap, weight * level)::DOUBLE AS target,
         CASE WHEN source_size > 0 THEN floor(least(cap, weight * level) / source_size) ELSE 0 END AS passes
  FROM ranked, level),
placed AS (
  SELECT r.*, t.source_size, t.target, t.passes, t.target - t.passes * t.source_size AS rest,
         sum(size) OVER (PARTITION BY r.source ORDER BY h, doc_id, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size / 2.0 AS middle
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source),
bounds AS (SELECT source, min(h) AS boundary FROM placed WHERE middle >= rest GROUP BY source)
SELECT p.doc_id, p.size, p.source_size, p.target,
       (size * copies)::BIGINT AS taken, copies::INTEGER AS copies
FROM (SELECT p.*, p.passes + CASE WHEN source_size > 0 AND rest > 0 AND (boundary IS NULL OR h < boundary)
                                  THEN 1 ELSE 0 END AS copies
      FROM placed p LEFT JOIN bounds b ON p.source IS NOT DISTINCT FROM b.source) p
"""

_WORDS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP4 = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, coalesce({_WORDS}, []) AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, len(x) AS l, array_to_string(x, ' ') AS win
  FROM (SELECT item, unnest(CASE WHEN len(w) >= 10 THEN list_transform(range(1, len(w) - 8), lambda i: w[i:i+9])
                                 WHEN len(w) > 0 THEN [w] ELSE [] END) AS x FROM b)),
lengths AS (SELECT DISTINCT l FROM windows),
places AS (
  SELECT doc_id, pos, l, array_to_string(w[pos:pos + l - 1], ' ') AS win
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS pos FROM d, lengths WHERE len(w) >= l)),
hits AS (SELECT doc_id, pos, l, item FROM places JOIN windows USING (l, win)),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + l)) AS p FROM (SELECT DISTINCT doc_id, pos, l FROM hits))
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS list
  FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP10 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(x, ' ') AS sh
  FROM (SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: w[i:i+4])
                                   WHEN len(w) > 0 THEN [w] ELSE [] END) AS x FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT a, b FROM edges
  UNION
  SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
lowest AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id))::BIGINT AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN lowest ON a = doc_id
"""

LLM_ORACLE_SQL: dict[str, str] = {"op2_mixing": OP2, "op4_decontamination": OP4,
                                 "op10_parity_join": OP10}
