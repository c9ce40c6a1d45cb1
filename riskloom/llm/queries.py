"""Queries of the operators over the given tables: ``queries()`` and ``oracle_sql()``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.token_counts import document_tokens
    return document_tokens(_table(spark, sf_dir, "documents"))


def op4_divergence_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.quality import quality
    return quality(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "char_distance", "word_distance")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.jaccard_join import jaccard_components
    return jaccard_components(_table(spark, sf_dir, "documents"), k=5, percent=80)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.decontaminate import contaminated
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), percent=80)


def op1_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every packed row; its ids as CRC-32 of the id matrix row."""
    from pyspark.sql import functions as F

    from riskloom.llm.packing import pack
    return pack(_table(spark, sf_dir, "documents")).select(
        "row_id", F.crc32("ids").alias("ids_crc32"), "n_tokens", F.size("doc_ids").alias("n_segments"), "cu_seqlens",
        "position_resets", "doc_ids", "doc_offsets")


def op2_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from riskloom.llm.mixing import mix
    return mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
        "source", "rate", "copies")


#: Fixed rules of the query: host, path, block.
URL_RULES = [("org", "/", False), ("example.org", "/es/", True), ("example.org", "/en/1", True),
             ("com", "/fr/", False), ("com", "/de/", True)]


def op6_url_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.url_filter import judge_urls
    rules = spark.createDataFrame(URL_RULES, "host string, path string, block boolean")
    return judge_urls(_table(spark, sf_dir, "pages"), rules)


def op8_toxicity_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from riskloom.llm.toxicity import remainder, toxicity
    scores = toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scores.select("doc_id", F.coalesce(remainder() == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its pseudonyms; the number of values of each kind."""
    from pyspark.sql import functions as F

    from riskloom.llm.pii import KINDS, pseudonymised
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    def number(kind):
        return F.size(F.filter("_pii_spans", lambda x: x["kind"] == kind))

    kinds = [number(k).alias(f"n_{k}") for k in KINDS]
    return pseudonymised(docs, b"query key").select("doc_id", F.size("_pii_spans").alias("n_pii"), *kinds, "text")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.line_dedup import line_clusters
    return line_clusters(_table(spark, sf_dir, "documents"), edits=3, min_chars=1, edit_chars=4)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from riskloom.llm.hard_negatives import hard_negatives
    rows = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from riskloom.llm.quality_discriminant import quality_scores
    from riskloom.llm.toxicity import remainder
    scores = quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scores.select("doc_id", F.coalesce(remainder() == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults by CRC-32 of ``conv_id:turn``; dropped rows stay with ``present`` false."""
    from pyspark.sql import functions as F
    def text_of(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text_of("text"), "[.!?]", "")).otherwise(text_of("text"))
    role = F.when(kind == 4, "user").otherwise(text_of("role"))
    times = F.sequence(F.lit(0), F.when(kind == 3, 1).otherwise(0))
    return (conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind != 0).alias("present"), F.explode(times))
            .drop("col"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from riskloom.llm.conversation_repair import repair
    return repair(damaged(_table(spark, sf_dir, "conversations")), present=F.col("present"))


_QUERIES = [op1_token_packing, op2_entropy_mixing, op3_separator_scan, op4_divergence_quality, op5_ngram_jaccard_join, op6_url_range_join, op7_benchmark_decontamination, op8_toxicity_nbsvm, op9_pii_pseudonyms, op10_line_dedup,
            op11_hard_negatives, op12_quality_discriminant, op13_conversation_repair]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op5_ngram_jaccard_join": _JACCARD_SQL, "op6_url_range_join": _url_sql(), "op11_hard_negatives": _NEGATIVES_SQL}


#: All pairs of documents with a common shingle, and the closure of their links.
_JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_sort(list_distinct(
    CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM w),
n AS (SELECT doc_id, s, len(s) AS n FROM s),
u AS (SELECT doc_id, n, unnest(s) AS x FROM n),
e AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS node, doc_id AS low FROM n UNION SELECT e.b, r.low FROM r JOIN e ON r.node = e.a),
c AS (SELECT node, min(low) AS low FROM r GROUP BY node),
q AS (SELECT s, count(*) AS k FROM n GROUP BY s)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, c.low AS component_id, CASE WHEN n.n > 0 THEN q.k END AS n_equal
FROM n JOIN c ON n.doc_id = c.node JOIN q ON n.s = q.s
"""


#: Every anchor against every row; both rankings by window.
_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 5
"""


def _url_sql() -> str:
    """The rules by plain comparison of every page with every rule."""
    rules = ", ".join(f"('{h}', '{p}', {str(b).lower()})" for h, p, b in URL_RULES)
    return f"""
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
r(rhost, rpath, block) AS (VALUES {rules}),
m AS (
  SELECT p.page_id, p.host, p.path, rhost || rpath AS rule, block,
         row_number() OVER (PARTITION BY p.page_id, p.host, p.path
                            ORDER BY length(rhost || rpath) DESC, length(rhost) DESC, block DESC) AS k
  FROM p JOIN r ON (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath))
SELECT p.page_id, p.host, p.path, m.rule,
       CASE WHEN m.block IS NULL THEN 'allow' WHEN m.block THEN 'block' ELSE 'allow' END AS verdict
FROM p LEFT JOIN m ON p.page_id = m.page_id AND p.host = m.host AND p.path = m.path AND m.k = 1
"""
