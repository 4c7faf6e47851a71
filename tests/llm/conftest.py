import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns that carry names the operators use themselves.
CLASHES = "row string, id string, shard string, slot string, score string, n_hit string, size string, chunk string, mix_row string, key string, digest string"
LONG = " ".join(f"word{i % 977} of{i % 31} the{i % 7} tale." for i in range(12_000))
BASE = "The quick brown fox jumps over the lazy dog while seven old sailors count the silver stars above the quiet harbour tonight."

ROWS = [
    (7, BASE, "en", "b", 1),
    (3, BASE, "en", "a", 1),
    (3, BASE, "en", "a", 1),
    (4, BASE.upper(), None, None, None),
    (5, None, "en", "a", None),
    (6, None, None, None, None),
    (8, "", "fr", "a", 0),
    (9, " \n\t ", "fr", "a", 4),
    (None, "Nobody numbered this one, yet it stands here.", "en", None, 5),
    (None, BASE, "en", "b", 5),
    (10, LONG, "en", "c", len(LONG)),
    (11, LONG + " And an end.", "de", "c", None),
    (12, "été déjà vu, naïve façade — 漢字 \x00 end", "fr", "b", 9),
    (13, "...", "fr", "b", 3),
    (-2, f"Other words first. {BASE} Other words last.", "es", "b", 3),
    (14, "in in in in in in in in in in in in in in in in in in in in in in in in in in in in in in in in in in in", "es", "b", 3),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [(*r, *(f"x{i}" for i in range(len(CLASHES.split(","))))) for r in ROWS]
    return spark.createDataFrame(rows, f"{DOC}, {CLASHES}").repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], f"{DOC}, {CLASHES}")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")


@pytest.fixture(scope="session")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
