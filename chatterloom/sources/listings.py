"""Landed listing pages: the JSON documents a listing endpoint returned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterloom.functions.casts import TOLERANT
from chatterloom.operators.decode import CORRUPT
from chatterloom.schemas import LISTING_ITEM_TYPES, LISTING_PAGE, ddl

# Endpoint of a page -> type of the events on it.
ENDPOINT_EVENT_TYPE = {"new": "POST", "comments": "COMMENT"}


def read_listings(
    spark: SparkSession, root: str, *, streaming: bool = False, **options: str
) -> DataFrame:
    """Pages under ``root/endpoint=<name>/`` with their endpoint, one per line.

    A page that cannot be parsed keeps its text in ``_corrupt``. Pretty-printed
    pages need the option ``multiLine``. As a stream, the checkpoint remembers
    which files were read.
    """
    reader = spark.readStream if streaming else spark.read
    schema = ddl({**LISTING_PAGE, CORRUPT: "string", "endpoint": "string"})
    return reader.schema(schema).options(columnNameOfCorruptRecord=CORRUPT, **options).json(root)


def children(pages: DataFrame) -> DataFrame:
    """One row per child of every page, with ``reasons`` why it gives no event.

    A page without children, corrupt or of an unknown endpoint, is one row of
    its own, as none of it can be used.
    """
    event_type = F.lit(None).cast("string")
    for endpoint, kind in ENDPOINT_EVENT_TYPE.items():
        event_type = F.when(F.col("endpoint") == endpoint, kind).otherwise(event_type)
    corrupt = F.col(CORRUPT) if CORRUPT in pages.columns else F.lit(None).cast("string")
    exploded = pages.select(
        "endpoint",
        event_type.alias("event_type"),
        corrupt.alias(CORRUPT),
        F.explode_outer("data.children").alias("child"),
    )
    item = F.col("child.data")
    time = TOLERANT["timestamp"](item["created_utc"])
    rules = [
        ("page:corrupt", F.col(CORRUPT).isNotNull()),
        ("page:endpoint", F.col("event_type").isNull()),
        ("child:missing", F.col(CORRUPT).isNull() & item.isNull()),
        ("created_utc:type", item["created_utc"].isNotNull() & time.isNull()),
    ]
    for name, kind in LISTING_ITEM_TYPES.items():
        if name != "created_utc":
            unfit = item[name].isNotNull() & TOLERANT[kind](item[name]).isNull()
            rules.append((f"{name}:type", unfit))
    reasons = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]))
    return exploded.select("endpoint", "event_type", CORRUPT, item.alias("item"), reasons.alias("reasons"))


def split_items(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable items, quarantined pages and children with their reasons)."""
    rows = children(pages)
    usable = rows.filter(F.size("reasons") == 0).select("endpoint", "event_type", "item")
    payload = F.coalesce(F.col(CORRUPT), F.to_json("item"))
    rejected = rows.filter(F.size("reasons") > 0).select(
        "endpoint", payload.alias("payload"), "reasons"
    )
    return usable, rejected


def items(pages: DataFrame) -> DataFrame:
    """The usable items of known endpoints: ``endpoint``, ``event_type`` and ``item``."""
    return split_items(pages)[0]
