"""Daily sentiment and weekly topics kept up to date as parts of the lake arrive.

Counts, sums and sums of squares of a group can be added to and taken from, so an update reads the days of its own
events (and a margin for their copies), never older ones. A later copy of an event withdraws the one that counted
before. What cannot be taken back, minimum, maximum and the first ids of a group, is recounted for the groups that lost
an event, from the events kept for that day.

State lies in one folder, each table in folders of days or weeks. An update is first written beside it in whole, marked,
and then moved into place by overwriting folders; an update that was interrupted is finished by the next call, so that
no part is counted twice or half.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatterloom.functions.time import bucket_start
from chatterloom.operators.ranking import first_per_group
from chatterloom.operators.sentiment import SAMPLE_IDS
from chatterloom.plans.batch import _NEWEST_FIRST, COPY_MARGIN, unique_events
from chatterloom.session import delete_path, path_exists, scratch_path

_EVENT = {
    "event_id": "string", "timestamp": "timestamp", "score": "int", "enrichment_sentiment": "double",
    "posted_in_subreddit": "string", "enrichment_topics": "array<string>",
}
_SUMS = {
    "post_count": "bigint", "sentiment_count": "bigint", "sentiment_sum": "double", "sentiment_squares": "double",
    "score_count": "bigint", "score_sum": "double",
}
_DAILY = {
    "subreddit": "string", **_SUMS, "sentiment_min": "double", "sentiment_max": "double", "sample_event_ids": "array<string>",
}
#: Tables of the state: their columns and the folder each row is in.
STATE = {
    "events": (_EVENT, "day"),
    "daily": (_DAILY, "day"),
    "topics": ({"topic": "string", "mentions": "bigint"}, "week"),
}


def read_state(spark: SparkSession, root: str, name: str, folders: Iterable[date] | None = None) -> DataFrame:
    """One table of the state, or just some days or weeks of it, which are all that is read."""
    columns, key = STATE[name]
    schema = ", ".join(f"`{n}` {t}" for n, t in {**columns, key: "date"}.items())
    path = f"{root}/{name}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    table = spark.read.schema(schema).parquet(path)
    return table if folders is None else table.filter(F.col(key).isin(sorted(folders)))


def _replace(rows: DataFrame, path: str, key: str) -> None:
    writer = rows.hint("rebalance", key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(key).parquet(path)


def _finish(spark: SparkSession, root: str) -> None:
    """Moves a complete update into place; an incomplete one is forgotten."""
    pending = f"{root}/pending"
    if path_exists(spark, f"{pending}/ready"):
        days = {r[0] for r in spark.read.schema("day date").parquet(f"{pending}/daily").distinct().collect()}
        for name, (columns, key) in STATE.items():
            schema = ", ".join(f"`{n}` {t}" for n, t in {**columns, key: "date", "live": "boolean"}.items())
            rows = spark.read.schema(schema).parquet(f"{pending}/{name}")
            if name == "events":  # it holds the days around, too, which stay as they are
                rows = rows.filter(F.col(key).isin(sorted(days)))
            # A folder without any live row still has to lose what it holds.
            _replace(rows.filter("live").drop("live"), f"{root}/{name}", key)
            filled = rows.groupBy(key).agg(F.max("live").alias("any")).filter("not any")
            for (folder,) in filled.select(key).collect():
                delete_path(spark, f"{root}/{name}/{key}={folder.isoformat()}")
    delete_path(spark, pending)


def _deltas(rows: DataFrame) -> dict[str, Column]:
    s, score, sign = F.col("enrichment_sentiment"), F.col("score"), F.col("sign")
    zero = F.lit(0.0)
    return {
        "post_count": F.sum(sign),
        "sentiment_count": F.sum(F.when(s.isNotNull(), sign).otherwise(0)),
        "sentiment_sum": F.sum(F.coalesce(s * sign, zero)),
        "sentiment_squares": F.sum(F.coalesce(s * s * sign, zero)),
        "score_count": F.sum(F.when(score.isNotNull(), sign).otherwise(0)),
        "score_sum": F.sum(F.coalesce(score * sign, F.lit(0)).cast("double")),
    }


def _daily(changes: DataFrame, kept: DataFrame, old: DataFrame) -> DataFrame:
    """The daily rows of all days that change: ``changes`` are signed events, ``kept`` those that now count."""
    # One struct as the key, so that a null group equals itself.
    bucket = F.struct("day", "subreddit").alias("bucket")
    changes, kept = (rows.select("*", bucket) for rows in (changes, kept))
    deltas = changes.groupBy("bucket").agg(
        *[value.alias(f"d_{name}") for name, value in _deltas(changes).items()], F.min("sign").alias("lost"),
        F.min("enrichment_sentiment").alias("low"), F.max("enrichment_sentiment").alias("high"),
    )
    both = old.select(bucket, *[c for c in old.columns if c not in ("day", "subreddit")]).join(deltas, "bucket", "full")
    # Groups that lost an event have their extremes again from their events; the ids are few, so all that changed do.
    lost = deltas.filter("lost < 0").select("bucket")
    again = kept.join(lost, "bucket", "left_semi").groupBy("bucket").agg(
        F.min("enrichment_sentiment").alias("again_min"), F.max("enrichment_sentiment").alias("again_max")
    )
    touched = kept.join(deltas.select("bucket"), "bucket", "left_semi").select("bucket", "event_id")
    ids = first_per_group(touched, ["bucket"], [F.asc_nulls_last("event_id")], SAMPLE_IDS)
    ids = ids.groupBy("bucket").agg(F.array_sort(F.collect_list("event_id")).alias("new_ids"))
    merged = both.join(again, "bucket", "left").join(ids, "bucket", "left")
    recount = F.coalesce(F.col("lost") < 0, F.lit(False))
    return merged.select(
        "bucket.day", "bucket.subreddit",
        *[(F.coalesce(n, F.lit(0)) + F.coalesce(f"d_{n}", F.lit(0))).cast(t).alias(n) for n, t in _SUMS.items()],
        F.when(recount, F.col("again_min")).otherwise(F.least("sentiment_min", "low")).alias("sentiment_min"),
        F.when(recount, F.col("again_max")).otherwise(F.greatest("sentiment_max", "high")).alias("sentiment_max"),
        F.coalesce("new_ids", "sample_event_ids").alias("sample_event_ids"),
    ).withColumn("live", F.col("post_count") > 0)


def _topics(changes: DataFrame, old: DataFrame) -> DataFrame:
    signed = changes.select(bucket_start("week", F.col("timestamp")).cast("date").alias("week"), "sign", F.explode("enrichment_topics").alias("topic"))
    new = signed.groupBy("week", "topic").agg(F.sum("sign").alias("mentions"))
    total = old.select("week", "topic", "mentions").unionByName(new).groupBy("week", "topic").agg(F.sum("mentions").alias("mentions"))
    return total.withColumn("live", F.col("mentions") > 0)


def update(spark: SparkSession, root: str, part: DataFrame, *, margin: timedelta = COPY_MARGIN) -> None:
    """Takes a part of the lake (rows in any order, copies included) into the state below ``root``.

    Copies of an event lie at most ``margin`` apart. Events without a time belong to no day and are left out.
    """
    _finish(spark, root)
    new = unique_events(part, _EVENT).filter(F.col("timestamp").isNotNull())
    new = new.select(*[F.col(n).cast(t).alias(n) for n, t in _EVENT.items()])
    staged = scratch_path(spark, "part")
    new.withColumn("day", F.to_date("timestamp")).write.parquet(staged)
    new = spark.read.parquet(staged)
    days = {r[0] for r in new.select("day").distinct().collect()}  # of the part
    if not days:
        return
    reach = range(-margin.days - 1, margin.days + 2) if margin else range(1)
    near = {d + timedelta(days=n) for d in days for n in reach}
    old = read_state(spark, root, "events", near)
    both = old.withColumn("fresh", F.lit(0)).unionByName(new.withColumn("fresh", F.lit(1)))
    # The order of ``unique_events``; of equal copies the one that counts already stays.
    rest = [c for c in _EVENT if c not in ("event_id", *_NEWEST_FIRST)]
    order = [F.desc_nulls_last(c) for c in (*_NEWEST_FIRST, *rest)] + [F.asc("fresh")]
    place = F.row_number().over(Window.partitionBy("event_id").orderBy(*order))
    # Those that count from now on, and, not live, those that counted before: one table says what changes and what stays.
    pending = f"{root}/pending"
    judged = both.withColumn("live", place == 1).filter("live or fresh = 0")
    judged.write.parquet(f"{pending}/events")
    judged = spark.read.parquet(f"{pending}/events")
    changes = judged.filter("fresh = 1 or not live").withColumn("sign", F.when(F.col("live"), 1).otherwise(-1))
    changed = {r[0] for r in changes.select("day").distinct().collect()}
    if changed:
        kept = judged.filter("live").filter(F.col("day").isin(sorted(changed)))
        named = F.col("posted_in_subreddit").alias("subreddit")
        daily = _daily(changes.select("*", named), kept.select("*", named), read_state(spark, root, "daily", changed))
        weeks = {d - timedelta(days=d.weekday()) for d in changed}
        tables = {
            "daily": daily,
            "topics": _topics(changes, read_state(spark, root, "topics", weeks)),
        }
        for name, rows in tables.items():
            rows.write.mode("overwrite").parquet(f"{pending}/{name}")
        spark.range(1).write.mode("overwrite").parquet(f"{pending}/ready")
    _finish(spark, root)


def daily_sentiment(spark: SparkSession, root: str) -> DataFrame:
    """The daily sentiment table of all events taken so far."""
    n = F.nullif(F.col("sentiment_count"), F.lit(0))
    mean = F.col("sentiment_sum") / n
    spread = F.when(n.isNotNull(), F.sqrt(F.greatest(F.col("sentiment_squares") / n - mean * mean, F.lit(0.0))))
    return read_state(spark, root, "daily").select(
        F.col("day").cast("timestamp").alias("day_start"), "subreddit", mean.alias("avg_sentiment"), "sentiment_count", "post_count",
        (F.col("score_sum") / F.nullif(F.col("score_count"), F.lit(0))).alias("avg_score"), spread.alias("sentiment_stddev"),
        "sentiment_min", "sentiment_max", "sample_event_ids",
    )


def weekly_topics(spark: SparkSession, root: str) -> DataFrame:
    """The weekly topics table of all events taken so far."""
    return read_state(spark, root, "topics").select(
        F.col("week").cast("timestamp").alias("week_start"), "topic", F.col("mentions").alias("topic_count")
    )
