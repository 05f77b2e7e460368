"""Thin queries over sharding, ranked search and spelling variants, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import impact, sharding, spelling


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.decide(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return impact.rank(docs, items)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# The CRC table is made from its polynomial; the curve's rule runs once for each distinct cell.
OP11_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS c FROM range(256) r(i))
), texts AS (
  SELECT doc_id, lang, source, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) + 1 AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST(('0x' || x) AS BIGINT)) AS bytes FROM documents
), keyed AS (
  SELECT row_number() OVER () AS place, doc_id, size, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32,
    coalesce('v' || lang, 'w') AS d0, coalesce('v' || source, 'w') AS d1, length(bin(size)) - 1 AS power FROM texts, crc_table
), dimensions AS (
  SELECT place, doc_id, size, text_crc32, d0, d1, lpad(CAST(power * 4 + (CASE WHEN power >= 2 THEN size >> CAST(power - 2 AS BIGINT) ELSE size << CAST(2 - power AS BIGINT) END & 3) + 1 AS VARCHAR), 3, '0') AS d2, count(*) OVER () AS total FROM keyed
), cells0 AS (
  SELECT d0, ((2 * coalesce(sum(n) OVER (ORDER BY d0 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + n) * 256) // (2 * total) AS c0 FROM (SELECT d0, total, count(*) AS n FROM dimensions GROUP BY ALL)
), cells1 AS (
  SELECT d1, ((2 * coalesce(sum(n) OVER (ORDER BY d1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + n) * 256) // (2 * total) AS c1 FROM (SELECT d1, total, count(*) AS n FROM dimensions GROUP BY ALL)
), cells2 AS (
  SELECT d2, ((2 * coalesce(sum(n) OVER (ORDER BY d2 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + n) * 256) // (2 * total) AS c2 FROM (SELECT d2, total, count(*) AS n FROM dimensions GROUP BY ALL)
), points AS (
  SELECT place, doc_id, size, text_crc32, total, CAST(c0 AS BIGINT) AS c0, CAST(c1 AS BIGINT) AS c1, CAST(c2 AS BIGINT) AS c2 FROM dimensions JOIN cells0 USING (d0) JOIN cells1 USING (d1) JOIN cells2 USING (d2)
), turned AS (
  SELECT c0, c1, c2, c0 AS x0, c1 AS x1, c2 AS x2, 128::BIGINT AS bit, 0 AS axis FROM (SELECT DISTINCT c0, c1, c2 FROM points)
  UNION ALL
  SELECT c0, c1, c2,
    xor(x0, CASE WHEN own & bit <> 0 THEN bit - 1 ELSE xor(x0, own) & (bit - 1) END),
    CASE WHEN axis = 1 AND own & bit = 0 THEN xor(x1, xor(x0, own) & (bit - 1)) ELSE x1 END,
    CASE WHEN axis = 2 AND own & bit = 0 THEN xor(x2, xor(x0, own) & (bit - 1)) ELSE x2 END,
    CASE WHEN axis = 2 THEN bit >> 1 ELSE bit END, (axis + 1) % 3
  FROM (SELECT *, CASE axis WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x2 END AS own FROM turned WHERE bit > 1)
), gray AS (
  SELECT c0, c1, c2, x0 AS g0, xor(x0, x1) AS g1, xor(xor(x0, x1), x2) AS g2 FROM turned WHERE bit = 1
), flipped AS (
  SELECT c0, c1, c2, g0, g1, g2, list_reduce(list_prepend(0::BIGINT, list_transform(range(1, 8), lambda k: CASE WHEN (g2 >> k) & 1 = 1 THEN (1::BIGINT << k) - 1 ELSE 0 END)), lambda a, b: xor(a, b)) AS f FROM gray
), curve AS (
  SELECT c0, c1, c2, list_sum(list_transform(range(0, 8), lambda k: (((xor(g0, f) >> k) & 1) << (3 * k + 2)) + (((xor(g1, f) >> k) & 1) << (3 * k + 1)) + (((xor(g2, f) >> k) & 1) << (3 * k)))) AS curve FROM flipped
), ordered AS (
  SELECT p.*, row_number() OVER (ORDER BY curve, size, text_crc32, doc_id NULLS LAST, place) - 1 AS before FROM points p JOIN curve USING (c0, c1, c2)
)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST((before * 16) // total AS INTEGER) AS shard,
  CAST(before - (((before * 16) // total) * total + 15) // 16 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM ordered
"""

OP12_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), items AS (
  SELECT row_number() OVER () AS qid, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms FROM benchmark
), asked AS (
  SELECT qid, item_id, unnest(terms) AS term FROM items
), totals AS (
  SELECT count(*) FILTER (len(terms) > 0) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM texts
), entries AS (
  SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(terms) AS n, unnest(terms) AS term FROM texts) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM entries, totals GROUP BY term, n_docs
), scores AS (
  SELECT a.qid, a.item_id, e.rid, e.doc_id, CAST(sum(w.w * ((1000000000 * e.tf) // (1000 * e.tf + 8 * (10 + (90 * e.n * t.n_docs) // t.n_terms)))) AS BIGINT) AS score
  FROM asked a JOIN entries e ON a.term = e.term JOIN weights w ON a.term = w.term, totals t GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

# Words one edit apart share a word that one deletion at most makes of each.
OP13_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS c FROM range(256) r(i))
), runs AS (
  SELECT rid, id, run, count(*) AS n FROM (
    SELECT row_number() OVER () AS rid, coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents
  ) GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(id || ':' || run)), '..'), lambda x: CAST(('0x' || x) AS BIGINT))), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM runs, crc_table
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, CAST(h % length(run) AS INTEGER)) || substring(run, CAST(h % length(run) + 2 AS INTEGER)) ELSE run END AS word, n FROM hashed
  ) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), coded AS (
  SELECT word, n, length(word) AS len, translate(word, (SELECT string_agg(chr(CAST(i AS INTEGER)), '' ORDER BY i) FROM range(192, 256) r(i)), (SELECT string_agg(chr(CAST(i AS INTEGER)), '' ORDER BY i) FROM range(32, 96) r(i))) AS code FROM words
), cuts AS (
  SELECT word, n, code, len, unnest(range(0, len)) AS cut FROM coded
), keys AS (
  SELECT word, n, code, substring(code, 1, CAST(cut AS INTEGER)) || substring(code, CAST(cut + 2 AS INTEGER)) AS key FROM cuts UNION ALL SELECT word, n, code, code FROM coded
), pairs AS (
  SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM keys a JOIN keys b ON a.key = b.key AND a.word <> b.word WHERE levenshtein(a.code, b.code) = 1
), best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS most, arg_min(near, struct_pack(a := -near_n, b := near)) AS near FROM pairs GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.most >= 2 * w.n THEN b.near END AS form, CASE WHEN b.most >= 2 * w.n THEN b.most END AS form_n FROM words w LEFT JOIN best b ON w.word = b.word
), chain AS (
  SELECT word, word AS root, form FROM forms UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON c.form = f.word
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, c.root FROM forms f JOIN chain c ON f.word = c.word AND c.form IS NULL
"""

QUERIES = {"op11_sharding": op11_sharding, "op12_ranked_search": op12_ranked_search, "op13_spelling_variants": op13_spelling_variants}
SQL = {"op11_sharding": OP11_SQL, "op12_ranked_search": OP12_SQL, "op13_spelling_variants": OP13_SQL}
