"""One registered query per operator, with its SQL check where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from rootlens.llm import (
    audit,
    bpe,
    collocations,
    embedding_dedup,
    jaccard,
    language,
    licenses,
    mixing,
    neighbours,
    quality,
    toxicity,
    url_rules,
    warc,
)
from rootlens.session import reach_package

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- 5: urls

URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, url_rules.RULES)
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
URL_SQL = f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULE_ROWS}),
rests AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
),
numbered AS (SELECT *, row_number() OVER () AS n FROM parts),
fits AS (
  SELECT n, rule_host || rule_path AS rule, rule_verdict,
    row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
  FROM numbered JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM numbered LEFT JOIN fits ON fits.n = numbered.n AND place = 1
"""


# ---------------------------------------------------------------- 7: archives


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.archive_pages(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "fault")


WARC_SQL = """
WITH digests AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
),
coded AS (
  SELECT page_id, payload_bytes,
    array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform([15, 10, 5, 0], lambda s:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * g, 5))::BIGINT >> s) & 31)::BIGINT, 1)), '')), '') AS payload_digest
  FROM digests
),
firsts AS (SELECT payload_digest, max(page_id) AS first_id FROM coded GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to,
  CAST(NULL AS VARCHAR) AS fault
FROM coded JOIN firsts USING (payload_digest)
"""


# ---------------------------------------------------------------- 1: nearest neighbours


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), every=20)


# ---------------------------------------------------------------- 2: byte-pair encoding


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.load()
    coded = bpe.encode(table(spark, sf_dir, "documents"), vocabulary)
    back = bpe.decode(coded, vocabulary, keep=("doc_id", "ids"))
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )


# ---------------------------------------------------------------- 3: languages


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return language.identify(documents, language.train(documents))


# ---------------------------------------------------------------- 4: mixing


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_copies(table(spark, sf_dir, "documents"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return plan.select("doc_id", "size", "source_size", "target", taken, "copies")


# ---------------------------------------------------------------- 6: toxicity


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.judge(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))


# ---------------------------------------------------------------- 8: licenses


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.withColumn("n_licenses", F.size("licenses").cast("long")).drop("licenses")


# ---------------------------------------------------------------- 9: near duplicates


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


JACCARD_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
shingles AS MATERIALIZED (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS s FROM words
),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (any_value(p.n) + any_value(q.n) - count(*))
),
reach(x, y) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r.y) AS component_id
FROM documents d JOIN reach r ON r.x = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
GROUP BY d.doc_id
"""


# ---------------------------------------------------------------- 10: quality


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.assess(documents, quality.train(documents, table(spark, sf_dir, "labels")))


# ---------------------------------------------------------------- 11: collocations


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


COLLOCATION_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
),
numbered AS (SELECT row_number() OVER () AS piece_id, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
words AS MATERIALIZED (
  SELECT lang, a, lead(a, 1) OVER piece AS b, lead(a, 2) OVER piece AS c, lead(a, 3) OVER piece AS d
  FROM (SELECT piece_id, lang, unnest(w) AS a, generate_subscripts(w, 1) AS pos FROM numbered)
  WINDOW piece AS (PARTITION BY piece_id ORDER BY pos)
),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
runs AS (
  SELECT lang, 1 AS size, a AS phrase FROM words
  UNION ALL SELECT lang, 2, a || ' ' || b FROM words WHERE b IS NOT NULL
  UNION ALL SELECT lang, 3, a || ' ' || b || ' ' || c FROM words WHERE c IS NOT NULL
  UNION ALL SELECT lang, 4, a || ' ' || b || ' ' || c || ' ' || d FROM words WHERE d IS NOT NULL
),
counts AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 30),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size >= 2),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM candidates c, range(1, 4) AS t(k)
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
  WHERE k < c.size
),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM cuts),
parts AS (
  SELECT lang, a, unnest(list_transform(range(1, size - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM candidates, range(2, 4) AS t(m) WHERE m < size
),
longer AS (SELECT lang, phrase, max(a) AS most FROM parts GROUP BY ALL),
kept AS (
  SELECT l.* FROM lowest l LEFT JOIN longer g ON g.lang = l.lang AND g.phrase = l.phrase
  WHERE place = 1 AND NOT coalesce(100::HUGEINT * g.most >= 80::HUGEINT * l.a, false)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


# ---------------------------------------------------------------- 12: filters


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


AUDIT_SQL = """
WITH base AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
),
read AS (
  SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS fails_e
  FROM base
),
masks AS (
  SELECT doc_id, part,
    (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT + 4 * (100 * capitals > 5 * length(t))::INT
      + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * fails_e::INT AS mask
  FROM read
),
marks AS (
  SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic
  FROM labels GROUP BY doc_id
),
cells AS MATERIALIZED (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM masks LEFT JOIN marks USING (doc_id) GROUP BY part, mask
),
letters(f, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
),
places AS (
  SELECT filter_order, step::INT AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier
  FROM orders, range(1, 6) AS s(step)
),
counted AS (
  SELECT part, filter_order, step, bit,
    sum(n) FILTER (mask & (earlier | bit) = 0) AS kept,
    sum(n) FILTER (mask & earlier = 0 AND mask & bit <> 0) AS removed,
    sum(n) FILTER (mask & earlier <> 0 AND mask & bit <> 0) AS redundant,
    sum(n) FILTER (mask = bit) AS unique_fails,
    sum(good) FILTER (mask & earlier = 0 AND mask & bit <> 0) AS good_lost,
    sum(toxic) FILTER (mask & earlier = 0 AND mask & bit <> 0) AS toxic_lost
  FROM cells, places GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed, coalesce(redundant, 0) AS redundant,
  coalesce(unique_fails, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost, coalesce(toxic_lost, 0) AS toxic_lost,
  sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit) AS shapley
FROM counted
"""


# ---------------------------------------------------------------- 13: near-duplicate embeddings


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


EMBEDDING_SQL = """
WITH RECURSIVE given AS (
  SELECT row_number() OVER () AS n, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
),
valid AS MATERIALIZED (
  SELECT *, sqrt(list_dot_product(v, v)) AS size FROM given
  WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
),
links AS MATERIALIZED (
  SELECT a.n AS x, b.n AS y FROM valid a JOIN valid b ON a.label = b.label AND a.n <> b.n AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.98
),
reach(x, y) AS (
  SELECT n, n FROM given
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
),
least AS (SELECT reach.x, min(given.vec_id) AS component_id FROM reach JOIN given ON given.n = reach.y GROUP BY reach.x),
degree AS (SELECT x, count(*) AS n_links FROM links GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM given JOIN least ON least.x = given.n LEFT JOIN degree ON degree.x = given.n
"""


QUERIES: dict[str, Query] = {
    "op1_neighbours": op1_neighbours,
    "op2_bpe": op2_bpe,
    "op3_language": op3_language,
    "op4_mixing": op4_mixing,
    "op5_url_rules": op5_url_rules,
    "op6_toxicity": op6_toxicity,
    "op7_warc": op7_warc,
    "op8_licenses": op8_licenses,
    "op9_jaccard": op9_jaccard,
    "op10_quality": op10_quality,
    "op11_collocations": op11_collocations,
    "op12_filter_audit": op12_filter_audit,
    "op13_embedding_dedup": op13_embedding_dedup,
    "pipeline": corpus_pipeline.run,
}
ORACLE: dict[str, str] = {
    "op5_url_rules": URL_SQL,
    "op7_warc": WARC_SQL,
    "op9_jaccard": JACCARD_SQL,
    "op11_collocations": COLLOCATION_SQL,
    "op12_filter_audit": AUDIT_SQL,
    "op13_embedding_dedup": EMBEDDING_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
