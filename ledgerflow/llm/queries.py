"""The queries of the operators on the given tables, and the SQL that some must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import (
    decontaminate,
    fill_middle,
    main_text,
    ngram_join,
    passages,
    pieces,
    quality,
    token_counts,
    token_files,
    top_k,
    warc,
    whitening,
)
from ledgerflow.llm.common import table
from ledgerflow.llm.url_filter import judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return register


# The rules of the contract.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

URL_SQL = """
WITH rules(rhost, rpath, action) AS (VALUES ('net','/','block'), ('example.net','/en/','allow'),
  ('example.com','/de/','block'), ('org','/fr/','allow')),
cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw, coalesce(rest, '') AS rest FROM cut),
urls AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM parts)
SELECT page_id, host, path, rhost || rpath AS rule, coalesce(action, 'allow') AS verdict
FROM urls LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) = 1
"""


@query("op4_url_filter", URL_SQL)
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, action string")
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


@query("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = pieces.Vocabulary.load()
    coded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary)
    return pieces.decode(coded, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, token_counts.read_ranks()).drop("text")


@query("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs, table(spark, sf_dir, "labels")).drop("text")


NGRAM_SQL = """
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
grams AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] END) AS g FROM split),
sets AS (SELECT DISTINCT doc_id, g FROM grams),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id WHERE 100 * c >= 90 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, y FROM reach r JOIN edges ON x = r.other)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM documents d JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY d.doc_id
"""


@query("op5_ngram_join", NGRAM_SQL)
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(table(spark, sf_dir, "documents"))


@query("op6_main_text")
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = main_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")
    return pages.withColumn("n_chars", F.length("text").cast("long"))


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM pairs QUALIFY rank <= 5
"""


@query("op7_top_k", TOP_K_SQL)
def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = top_k.stable(top_k.quantised(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")))
    return top_k.search(top_k.build_index(vectors), vectors.where(F.col("vec_id") % 50 == 0), 5)


WARC_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM f
"""


@query("op9_warc", WARC_SQL)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return warc.read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_decontaminate")
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


@query("op1_passages")
def op1_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.passage_pairs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_a", "doc_b", F.size("passages").alias("n_passages"), "passages")


@query("op11_token_files")
def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_ids(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return token_files.read_documents(manifest)


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    # A sum that no long can hold is null.
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS long)"))


FILL_SQL = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS h,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w FROM documents),
u AS (
  SELECT *, len(w) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
    ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM t),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
parts AS (
  SELECT *, coalesce(array_to_string(w[1:a], ''), '') AS p, coalesce(array_to_string(w[a + 1:b], ''), '') AS m,
    coalesce(array_to_string(w[b + 1:n], ''), '') AS s FROM cut)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""


@query("op13_fill_middle", FILL_SQL)
def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
