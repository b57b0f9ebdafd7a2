"""The registered queries of the dealt operators, with production parameters over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentalytics.llm import (codes, decontam, langid, ordermin, packing, pii, quality, render, rules, search,
                             simhash, tokens, urls)
from rentalytics.llm.common import table

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def with_crc(df: DataFrame) -> DataFrame:
    """Replace ids by their unsigned crc32."""
    return df.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@register
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_crc(tokens.read_token_files(tokens.write_token_files(table(spark, sf_dir, "documents"))))


@register
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_crc(packing.pack(table(spark, sf_dir, "documents")))


@register
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), span=decontam.SPAN).drop("h")


ORACLE_SQL["op7_decontamination"] = r"""
WITH words AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + 12], ' ') AS win, least(len(w), 13) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
places AS (
  SELECT rid, doc_id, i AS start, size, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (SELECT rid, doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
hits AS (SELECT rid, start, p.size, item_id FROM places p JOIN windows USING (win)),
covered AS (SELECT rid, count(DISTINCT pos) AS n_hit
            FROM (SELECT rid, unnest(range(start, start + size)) AS pos FROM hits) GROUP BY rid),
named AS (SELECT rid, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id COLLATE C)) AS items_sha256
          FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY rid),
asked AS MATERIALIZED (
  SELECT row_number() OVER () AS pid, item_id, ws
  FROM (SELECT DISTINCT item_id, list_sort(list_distinct(w[i : i + 12])) AS ws
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0))),
held AS (SELECT rid, unnest(w) AS t, generate_subscripts(w, 1) AS pos FROM words),
sought AS (SELECT pid, unnest(ws) AS t FROM asked),
often AS (SELECT t, count(*) AS n FROM held WHERE t IN (SELECT t FROM sought) GROUP BY t),
rarest AS (SELECT pid, arg_min(t, {'n': coalesce(n, 0), 't': t}) AS t FROM sought LEFT JOIN often USING (t) GROUP BY pid),
reach AS (
  SELECT rid, item_id, ws, greatest(pos - 25, 1) AS lo, pos, w
  FROM rarest JOIN held USING (t) JOIN asked USING (pid) JOIN words USING (rid)
  WHERE list_has_all(w[greatest(pos - 25, 1) : pos + 25], ws)),
around AS (
  SELECT rid, count(DISTINCT item_id) AS n_near
  FROM reach WHERE len(list_filter(range(lo, pos + 1), lambda s: list_has_all(w[s : s + 25], ws))) > 0 GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       coalesce(n_near, 0)::BIGINT AS n_near_items
FROM words LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid) LEFT JOIN around USING (rid)
"""


@register
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("failed_rules")


@register
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordermin.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


@register
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, ["doc_id"])


@register
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))
    return found.withColumn("base_sha256", F.sha2("base", 256)).drop("base")


@register
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.extract(table(spark, sf_dir, "pages"))


@register
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


@register
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.label(docs, langid.fit(docs))


@register
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL["op11_ranked_search"] = r"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS MATERIALIZED (
  SELECT row_number() OVER () AS iid, item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
total AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM docs WHERE len(w) > 0),
tf AS MATERIALIZED (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(w) AS t FROM docs) GROUP BY rid, t),
asked AS (SELECT iid, t, count(*) AS times FROM (SELECT iid, unnest(w) AS t FROM items) GROUP BY iid, t),
weight AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY t, n_docs),
scored AS (
  SELECT iid, rid, sum(times * weight.w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(docs.w) * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weight USING (t) JOIN tf USING (t) JOIN docs USING (rid), total GROUP BY iid, rid),
ranked AS (
  SELECT iid, doc_id, score, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM scored JOIN docs USING (rid) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked JOIN items USING (iid) WHERE rank <= 10
"""


@register
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings")).drop("label")


def vector_code_sql(rounds: int = codes.ROUNDS) -> str:
    """Whole scans in every round, where the operator compares the moved entries only."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS rid, vec_id, label,
         list_transform(embedding, lambda x: floor({codes.SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT rid, p, list_slice(v, (len(v) * p) // 4 + 1, (len(v) * (p + 1)) // 4) AS x
  FROM kept, range({codes.PARTS}) AS r(p)),
book0 AS MATERIALIZED (SELECT p, rid AS entry, x FROM parts WHERE rid < {codes.ENTRIES})"""]
    for r in range(rounds + 1):
        steps.append(f"""
code{r} AS MATERIALIZED (
  SELECT rid, p, x, far['d'] AS d, far['e'] AS entry FROM (
    SELECT rid, a.p, any_value(a.x) AS x, min({{'d': list_inner_product(a.x, a.x) - 2 * list_inner_product(a.x, b.x)
           + list_inner_product(b.x, b.x), 'e': b.entry}}) AS far
    FROM parts a JOIN book{r} b ON a.p = b.p GROUP BY rid, a.p))""")
        if r < rounds:
            steps.append(f"""
moved{r} AS (
  SELECT p, entry, list(c ORDER BY i) AS x FROM (
    SELECT p, entry, i, floor(sum(c) / count(*)) AS c FROM (
      SELECT p, entry, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM code{r}) GROUP BY p, entry, i) GROUP BY p, entry),
book{r + 1} AS MATERIALIZED (
  SELECT b.p, b.entry, coalesce(m.x, b.x) AS x FROM book{r} b LEFT JOIN moved{r} m ON b.p = m.p AND b.entry = m.entry)""")
    return f"""
WITH {",".join(steps)},
coded AS (
  SELECT rid, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM code{rounds} GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY p, entry, i))
        FROM (SELECT p, entry, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM book{rounds})) AS codebooks_sha256
FROM kept JOIN coded USING (rid)
"""


ORACLE_SQL["op12_vector_codes"] = vector_code_sql()


@register
def op13_simhash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))
