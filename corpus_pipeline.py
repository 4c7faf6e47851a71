"""From documents to shuffled training shards, stage by stage.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet to the shared folder and read again
as the next one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterloom.llm import contamination, language, mixing, sharding, simhash
from chatterloom.llm.common import free_name, store, table

SHARDS = 8
#: A text in which no language reaches this share of the position probabilities is rejected.
LEAST_SCORE = 0.35


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that are null, without a letter, or in no language that the labels know.

    Each row is judged by its text alone: repeated rows share their verdict. Columns with the names of the prediction
    pass through as they are. No rows give no rows.
    """
    model = language.fit(docs)
    inside = free_name(docs.columns, "given")
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    found = language.predict(docs.select("text", F.struct(*others).alias(inside)), model)
    usable = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return found.filter(usable).select(*[c if c == "text" else F.col(f"{inside}.`{c}`") for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group that links join: SimHash fingerprints of five-word shingles, repeats included, that
    differ in 2 or fewer of 64 bits, and sets of these shingles with a Jaccard similarity of 0.8 or more.

    The smallest id stays, a null id only alone; texts that are null or without a word are copies of each other, as are
    repeated rows. All columns pass through, whatever their names.
    """
    return simhash.keep_one(docs, simhash.by_sets(shingle=5, percent=80))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes documents contaminated by the benchmark."""
    return contamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and leaves out documents so that sources come near their targets."""
    return mixing.mix(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shuffles the documents into shards: adds ``shard`` and ``slot``."""
    return sharding.shuffled(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: No stage can be said in SQL; each is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
