from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from chatterloom.llm import contamination, language
from chatterloom.llm.common import store
from chatterloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, documents):
    """What each stage got and gave."""
    docs, found = documents, {}
    for name, stage in pipeline.STAGES:
        given, docs = docs, store(stage(spark, docs, SMALL), name)
        found[name] = (given, docs)
    return found


def rows(df, *columns):
    return Counter(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def test_columns_and_decisions(stages, documents):
    for name, (given, kept) in stages.items():
        if name != "sharding":
            assert kept.columns == documents.columns
        extra = rows(kept, *documents.columns) - rows(given)
        assert not extra or (name == "mixing" and all(extra[r] <= rows(given)[r] for r in extra))


def test_language_stage_rejects_what_has_no_language(spark, documents):
    odd = spark.createDataFrame([(-1, None, "en", "s", 0), (-2, "12 34", "en", "s", 5), (-3, "", None, None, None)], documents.schema)
    kept = pipeline.language_stage(spark, documents.unionByName(odd), SMALL)
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {-1, -2, -3} and len(ids) >= documents.count() * 0.99
    assert language.UNKNOWN == "und"


def test_near_copies_go_and_clean_documents_stay(stages):
    """Exactly one document of each component of links at 0.8 stays, by brute force."""
    given, kept = (df.collect() for df in stages["near_dedup"])
    shingles = {}
    for r in given:
        words = r.text.lower().split()
        shingles[r.doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    root = {doc_id: doc_id for doc_id in shingles}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in shingles.items():
        for b, y in shingles.items():
            if a < b and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert sorted(r.doc_id for r in kept) == sorted({find(x) for x in shingles})


def test_clashing_columns_pass_through(spark, edge_docs):
    docs = store(edge_docs.withColumn("lang_pred", edge_docs.doc_id.cast("string")), "clashes")
    for stage in (pipeline.language_stage, pipeline.near_dedup_stage, pipeline.decontamination_stage):
        kept = stage(spark, docs, SMALL)
        assert kept.columns == docs.columns
        assert not rows(kept) - rows(docs)


def test_contaminated_documents_go(spark, stages, benchmark):
    given, kept = stages["decontamination"]
    bad = contamination.judge(given, benchmark, keep=["doc_id"]).filter("contaminated")
    gone = {r.doc_id for r in given.collect()} - {r.doc_id for r in kept.collect()}
    assert gone == {r.doc_id for r in bad.collect()} and gone


def test_shards_hold_the_mix(stages):
    given, kept = stages["sharding"]
    assert rows(given) == rows(kept, *given.columns)
    sizes = Counter(r.shard for r in kept.collect())
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1


def test_stages_take_empty_and_odd_documents(spark, documents, tmp_path):
    for docs in (documents.limit(0), documents.selectExpr("doc_id", "null as text", "lang", "source", "n_chars").limit(5)):
        docs = store(docs.selectExpr("doc_id", "string(text) as text", "lang", "source", "n_chars"), "odd")
        for name, stage in pipeline.STAGES:
            docs = store(stage(spark, docs, SMALL), name)
        assert docs.collect() == []


def test_all_operators_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(QUERIES) <= set(names)
