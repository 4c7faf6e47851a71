"""The registered queries on the smallest tables: columns, types and rows; SQL where there is some."""

import duckdb
import pytest
from pyspark.sql import functions as F

from chatterloom.llm.queries import ORACLE, QUERIES
from tools.check import TABLES, compare

SMALL = "/root/testdata/sf0.001"
CONTRACT = {
    "op1_warc": ("pages", "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"),
    "op2_language": ("documents", "doc_id bigint, held_out boolean, lang_pred string, score double"),
    "op3_html_text": ("pages", "page_id bigint, url string, text string, n_chars bigint"),
    "op4_decontamination": ("documents", "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"),
    "op5_suffix_dedup": ("documents", "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"),
    "op6_mixing": ("documents", "doc_id bigint, size bigint, source_size bigint, target double, taken bigint"),
    "op7_sharding": ("documents", "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int"),
    "op8_simhash": ("documents", "doc_id bigint, fingerprint string, component_id bigint"),
    "op9_line_dedup": ("documents", "doc_id bigint, text string, n_units bigint, n_removed bigint"),
    "op10_exact_dedup": ("documents", "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string"),
    "op11_token_alignment": ("documents", "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"),
    "op13_ngram_join": ("documents", "doc_id bigint, n_shingles bigint, component_id bigint"),
}
#: Queries that return other rows than one for each of a table.
SHAPES = {
    "op12_hard_negatives": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract(spark, name):
    table, columns = CONTRACT[name]
    given = spark.read.parquet(f"{SMALL}/{table}.parquet")
    found = QUERIES[name](spark, SMALL)
    kinds = dict(found.dtypes)
    for column in columns.split(", "):
        column, kind = column.split(" ")
        assert kinds[column] == kind
    key = columns.split(" ")[0]
    found = found.cache()
    assert sorted(r[0] for r in found.select(key).collect()) == sorted(r[0] for r in given.select(key).collect())
    if name in ORACLE:
        db = duckdb.connect()
        for one in TABLES:
            db.execute(f"CREATE VIEW {one} AS SELECT * FROM '{SMALL}/{one}.parquet'")
        assert compare(found, db.sql(ORACLE[name])) == ""
    found.unpersist()


@pytest.mark.parametrize("name", sorted(SHAPES))
def test_shape(spark, name):
    found = QUERIES[name](spark, SMALL).cache()
    assert [f"{c} {kind}" for c, kind in found.dtypes][: SHAPES[name].count(",") + 1] == SHAPES[name].split(", ")
    if name in ORACLE:
        db = duckdb.connect()
        for one in TABLES:
            db.execute(f"CREATE VIEW {one} AS SELECT * FROM '{SMALL}/{one}.parquet'")
        assert compare(found, db.sql(ORACLE[name])) == ""
    found.unpersist()


def test_op10_equals_sql_with_ties_and_nulls(spark, tmp_path):
    rows = [(1, "A b"), (2, "a B"), (5, "a b"), (3, None), (4, ""), (9, "É"), (8, "é")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = QUERIES["op10_exact_dedup"](spark, str(tmp_path))
    assert compare(found, db.sql(ORACLE["op10_exact_dedup"])) == ""
    assert found.agg(F.count_if("kept")).first()[0] == 4


def test_op7_hashes(spark):
    found = QUERIES["op7_sharding"](spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet"), "doc_id")
    wrong = (F.crc32(F.col("text").cast("binary")) != F.col("text_crc32")) | (F.octet_length("text") + 1 != F.col("size"))
    assert found.filter(wrong).count() == 0
