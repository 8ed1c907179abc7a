"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tokloom.llm import (bbit_minhash, best_fit_pack, chat_repair, decontam, feast_whiten, lang_id,
                         license_scan, pii_offsets, quality_gbt, rank_merge, toxicity_fm, training_order, warc_normalise)
from tokloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.op6_language_id(table(spark, sf_dir, "documents"))


@query
def op9_pii_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_offsets.spans(table(spark, sf_dir, "documents"))


@query
def op2_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bbit_minhash.near_duplicates(table(spark, sf_dir, "documents"))


ORACLE_SQL["op2_bbit_minhash"] = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5
      THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
digest AS (SELECT doc_id, sum(hash(s)::HUGEINT) AS d, count(*) AS n FROM sh GROUP BY doc_id),
class AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY d, n) AS rep FROM digest),
rsh AS (SELECT doc_id, s FROM sh WHERE doc_id IN (SELECT rep FROM class)),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both FROM rsh a JOIN rsh b
    ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT x, y FROM shared JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y
  WHERE 100 * n_both >= 85 * (p.n + q.n - n_both)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (
  SELECT DISTINCT rep AS x, rep AS y FROM class
  UNION SELECT reach.x, edge.y FROM reach JOIN edge ON reach.y = edge.x),
comp AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT w.doc_id, coalesce(size.n, 0) AS n_shingles, coalesce(comp.c, w.doc_id) AS component_id,
  w.doc_id = coalesce(comp.c, w.doc_id) AS kept
FROM words w LEFT JOIN size USING (doc_id) LEFT JOIN class USING (doc_id)
LEFT JOIN comp ON comp.x = class.rep
"""


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SPACED = ("regexp_replace(lower(text), "
           "'[\\p{Han}\\p{Hiragana}\\p{Katakana}\\p{Thai}\\p{Lao}\\p{Khmer}\\p{Myanmar}]', ' \\0 ', 'g')")
ORACLE_SQL["op1_decontamination"] = f"""
WITH dw AS (SELECT doc_id, regexp_extract_all({_SPACED}, '[\\p{{L}}\\p{{N}}]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all({_SPACED}, '[\\p{{L}}\\p{{N}}]+') AS w FROM benchmark),
width AS (SELECT DISTINCT least(len(w), 5) AS k FROM iw WHERE len(w) > 0),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - k + 2),
         lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s FROM dw, width WHERE len(w) >= k),
s AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
         lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM iw WHERE len(w) > 0 AND item_id IS NOT NULL),
n AS (SELECT item_id, count(*) AS n_item FROM s GROUP BY item_id)
SELECT doc_id, item_id, n_item, count(*) AS n_shared
FROM ds JOIN s USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING count(*) * 100 >= n_item * 80
"""


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_pack.pack_documents(table(spark, sf_dir, "documents"))


@query
def op10_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.training_order(table(spark, sf_dir, "documents"))


@query
def op4_warc_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_normalise.page_archives(spark, table(spark, sf_dir, "pages"))


ORACLE_SQL["op4_warc_normalise"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
             sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p),
r AS (SELECT *, CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM top THEN top END AS refers_to
      FROM g)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM r
"""


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_fm.op5_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gbt.op7_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.op3_licenses(table(spark, sf_dir, "documents"))


_TEMPLATE_ROWS = ", ".join("({}, '{}', '{}')".format(i, k, t.replace("'", "''"))
                           for i, (k, t) in enumerate(license_scan.TEMPLATES))
ORACLE_SQL["op3_license_scan"] = f"""
WITH doc AS (
  SELECT doc_id, text, array_to_string(list_concat([coalesce(source, 'unknown')],
      regexp_extract_all(doc_id::VARCHAR, '[0-9]')[1:-2]), '/') AS dir,
    CASE WHEN regexp_matches(text, '(?i)licen[cs]e') THEN 'LICENSE-' || doc_id ELSE doc_id || '.txt' END
      AS name
  FROM documents),
file AS (SELECT *, dir || '/' || name AS path, regexp_matches(name, '^LICENSE-') AS is_licence FROM doc),
template(t, license, said) AS (VALUES {_TEMPLATE_ROWS}),
tt AS (SELECT t, license, term, count(*) AS tf FROM
    (SELECT t, license, unnest(regexp_extract_all(lower(said), '[\\p{{L}}\\p{{N}}]+')) AS term FROM template)
  GROUP BY ALL),
total AS (SELECT count(*) AS n FROM file),
held AS (SELECT term, count(*) AS df FROM
    (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS term FROM file)
  WHERE term IN (SELECT term FROM tt) GROUP BY term),
idf AS (SELECT term, ln((1.0 + n) / (1.0 + coalesce(df, 0))) + 1 AS idf
  FROM (SELECT DISTINCT term FROM tt) LEFT JOIN held USING (term), total),
tw AS (SELECT t, license, term, tf * idf AS w FROM tt JOIN idf USING (term)),
tn AS (SELECT t, sqrt(sum(w * w)) AS norm FROM tw GROUP BY t),
said AS (
  SELECT path, line, unnest(regexp_extract_all(lower(s), '[\\p{{L}}\\p{{N}}]+')) AS term FROM (
    SELECT path, generate_subscripts(string_split(text, chr(10)), 1) AS line,
      unnest(string_split(text, chr(10))) AS s FROM file
    UNION ALL SELECT path, -1, text FROM file WHERE is_licence)),
v AS (SELECT path, line, term, count(*) AS n FROM said GROUP BY ALL),
x AS (SELECT path, line, term, v.n * coalesce(idf, ln(1.0 + total.n) + 1) AS x
  FROM v LEFT JOIN idf USING (term), total),
vn AS (SELECT path, line, sqrt(sum(x * x)) AS size FROM x GROUP BY ALL),
tl AS (SELECT t, list(term) AS terms, sum(tf)::BIGINT AS n FROM tt GROUP BY t),
place AS (SELECT path, w, unnest(range(1, len(w) + 1)) AS i FROM
    (SELECT path, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM file)),
run AS (SELECT path, t, i, unnest(w[i:i + n - 1]) AS term FROM place JOIN tl ON list_contains(terms, w[i])),
rv AS (SELECT path, t, i, term, count(*) AS n FROM run GROUP BY ALL),
rx AS (SELECT path, t, i, term, rv.n * coalesce(idf, ln(1.0 + total.n) + 1) AS x
  FROM rv LEFT JOIN idf USING (term), total),
score AS (
  SELECT path, license, round(sum(x * w) / (any_value(size) * any_value(norm)), 6) AS cosine
  FROM x JOIN tw USING (term) JOIN tn USING (t) JOIN vn USING (path, line)
  GROUP BY path, line, t, license
  UNION ALL
  SELECT path, any_value(license), round(sum(x * coalesce(w, 0)) / (sqrt(sum(x * x)) * any_value(norm)), 6) AS cosine
  FROM rx LEFT JOIN tw USING (t, term) JOIN tn USING (t) GROUP BY path, t, i),
own AS (SELECT path, first(license ORDER BY cosine DESC, license) AS license, max(cosine) AS cosine
  FROM score WHERE cosine >= 0.6 GROUP BY path),
granted AS (SELECT dir, first(own.license ORDER BY cosine DESC, path) AS license
  FROM own JOIN file USING (path) WHERE is_licence GROUP BY dir),
up AS (SELECT DISTINCT f.dir, g.dir AS above, g.license FROM (SELECT DISTINCT dir FROM file) f JOIN granted g
  ON f.dir = g.dir OR starts_with(f.dir, g.dir || '/')),
near AS (SELECT dir, arg_max(license, length(above)) AS dir_license, arg_max(above, length(above)) AS from_dir
  FROM up GROUP BY dir)
SELECT doc_id, path, coalesce(own.license, dir_license) AS license, cosine,
  CASE WHEN own.license IS NOT NULL THEN 'own' WHEN dir_license IS NOT NULL THEN 'inherited' END AS origin,
  CASE WHEN own.license IS NULL THEN from_dir END AS from_dir
FROM file LEFT JOIN own USING (path) LEFT JOIN near USING (dir)
"""


@query
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_merge.count_tokens(spark, table(spark, sf_dir, "documents"))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feast_whiten.whiten(spark, table(spark, sf_dir, "embeddings"))


@query
def op12_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair(table(spark, sf_dir, "conversations"))
