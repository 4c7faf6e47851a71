"""The queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterloom.llm import (
    alignment, contamination, exact_dedup, hard_negatives, html_text, language, line_dedup, mixing, ngram_join,
    sharding, simhash, suffix_dedup, warc,
)
from chatterloom.llm.common import table
from chatterloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@_query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents arrive in two batches, larger ids first, as of equal texts the largest id is to stay."""
    rows = exact_dedup.digest_rows(table(spark, sf_dir, "documents"))
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "index"), exact_dedup.default_buckets(spark))
    low, high = rows.agg(F.min("id"), F.max("id")).first()
    later = F.coalesce(F.col("id") > ((low or 0) + (high or 0)) // 2, F.lit(False))
    index.admit(rows.filter(later))
    index.admit(rows.filter(~later))
    found = exact_dedup.verdicts(rows, index)
    index.close()  # the groups are stored
    return found.withColumnRenamed("id", "doc_id")


ORACLE["op10_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
    AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
  text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


@_query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of three-word shingles, linked at two or fewer differing bits."""
    rows = simhash.fingerprints(table(spark, sf_dir, "documents"), simhash.EXACT)
    found = simhash.near_components(rows, simhash.EXACT)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


@_query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that a mix of all sources takes from each document."""
    docs = table(spark, sf_dir, "documents")
    narrow = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    stored, found, row = mixing.allot(narrow)
    taken = F.col("copies") * F.col("size") + F.col("part")
    joined = stored.select("doc_id", row).join(found.hint("merge"), row)
    return joined.select("doc_id", "size", "source_size", "target", taken.cast("bigint").alias("taken"))


@_query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents shuffled into eight shards, as read back from the shards' files."""
    path = sharding.write_shards(table(spark, sf_dir, "documents"), 8)
    text = F.coalesce("text", F.lit(""))
    return spark.read.parquet(path).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit(sharding.LAW).alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hit words of every document, with the items they come from."""
    docs, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    found = contamination.judge(docs, benchmark, keep=["doc_id"])
    digest = F.sha2(F.concat_ws(",", "items").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated", "longest_match")


@_query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for all documents by a network trained on those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs)
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@_query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records into ZIP packages and read back from them."""
    manifest = warc.write_packages(table(spark, sf_dir, "pages"), package_bytes=8 << 20)
    found = warc.read_packages(spark, manifest)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


ORACLE["op1_warc"] = """
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS payload FROM pages),
h AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id,
    array_to_string(list_transform(string_split(sha1(payload), ''),
      lambda c: bin(('0x' || c)::INTEGER)[-4:].lpad(4, '0')), '') AS bits
  FROM p)
SELECT page_id, octet_length(payload) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + list_sum(list_transform(range(5), lambda k: CASE WHEN bits[5 * i + k + 1] = '1' THEN 16 >> k::INTEGER ELSE 0 END))::INTEGER,
    1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to, url
FROM h
"""


@_query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the strings of 50 bytes that a document with a smaller id has."""
    return suffix_dedup.repeats_digest(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@_query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences that stood in an earlier place are removed from every document; runs under five words are spared."""
    found = line_dedup.deduplicate_units(table(spark, sf_dir, "documents"), unit="sentence", least_words=5)
    return found.select(F.col("id").alias("doc_id"), "text", "n_units", "n_removed", "removed")


@_query
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages, by weights trained on layouts around the words of some."""
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.fit(pages))


@_query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between byte-level and piece tokens of every text, with their counts in the corpus."""
    found = alignment.link_counts(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


@_query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five negatives for each anchor (every hundredth id) and each of its five positives; each seventh label is off by one."""
    found = hard_negatives.hard_negatives(
        table(spark, sf_dir, "embeddings"),
        lambda key: key % 100 == 0,
        relabel=lambda key, label: F.when(key % 7 == 0, (label + 1) % 10),
    )
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE["op12_hard_negatives"] = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
    list_inner_product(a.q, r.q)::BIGINT AS score
  FROM e a JOIN e r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""


@_query
def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles have a Jaccard similarity of 0.85 or more."""
    found = ngram_join.similar_groups(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


ORACLE["op13_ngram_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS shingle
  FROM w WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
b AS (
  SELECT x.doc_id AS u, y.doc_id AS v, count(*) AS n_both
  FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (
  SELECT u, v FROM b JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v
  WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)),
r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.v FROM r JOIN l ON r.reached = l.u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.reached) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN r USING (doc_id) GROUP BY 1, 2
"""


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
