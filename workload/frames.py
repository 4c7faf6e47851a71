"""The given tables in the shapes the operators expect. Whole tables, always."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterloom.schemas import ENRICHMENT, LAKE_EVENT, struct_type


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone and arrays as text, as both engines print them."""
    columns = []
    for name, kind in df.dtypes:
        value = F.col(f"`{name}`")
        if kind == "timestamp":
            value = value.cast("timestamp_ntz")
        elif kind.startswith("array"):
            value = F.array_join(value, "|", "<null>")
        columns.append(value.alias(name))
    return df.select(columns)


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with its counter ``k`` and a zoned timestamp."""
    return _table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def lake_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched events; quarter-step sentiments keep every sum exact."""
    return source_events(spark, sf_dir).select(
        "event_id",
        "timestamp",
        F.col("event_type").alias("posted_in_subreddit"),
        F.concat_ws(" ", "event_type", "user_id").alias("title"),
        F.col("k").alias("score"),
        F.when(F.col("k") >= 5, F.floor(F.col("value") * 4) / 4).alias("enrichment_sentiment"),
        F.array(
            F.col("event_type"),
            F.concat(F.lit(" K"), F.floor(F.col("k") / 10), F.lit(" ")),
            F.when(F.col("k") < 50, "").otherwise(F.col("event_type")),
        ).alias("enrichment_topics"),
    )


def lake_events_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event twice; which copy is later depends on the score."""
    events = lake_events(spark, sf_dir)
    shift = F.make_dt_interval(secs=(F.col("score") - 50).cast("decimal(18,6)"))
    copies = events.withColumns(
        {"timestamp": F.col("timestamp") + shift, "score": F.lit(99) - F.col("score")}
    )
    return events.unionByName(copies)


def full_lake_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lake_events`` in the complete lake layout."""
    events = lake_events(spark, sf_dir)
    missing = [F.lit(None).cast(t).alias(n) for n, t in LAKE_EVENT.items() if n not in events.columns]
    return events.select("*", *missing).select(*LAKE_EVENT)


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with topics under the name the speed layer uses."""
    return lake_events(spark, sf_dir).select(
        "event_id", "timestamp", F.col("enrichment_topics").alias("topics")
    )


def _raw_columns() -> list[Column]:
    k, kind = F.col("k"), F.col("event_type")
    url = F.concat(F.lit("https://example.org/"), "event_id")
    return [
        F.col("event_id"),
        F.when(kind.isin("click", "view"), "POST").otherwise("COMMENT").alias("event_type"),
        kind.alias("posted_in_subreddit"),
        F.concat(F.lit("u"), "user_id").alias("author"),
        url.alias("url"),
        F.when(k >= 20, kind).alias("title"),
        F.concat(F.lit('He said "'), k, F.lit('"\n\\ é ،')).alias("content"),
        F.col("timestamp"),
        (k >= 50).alias("has_media"),
        F.when(k >= 50, F.array(url, url)).otherwise(F.array().cast("array<string>")).alias("media_urls"),
        F.when(k >= 10, k).alias("score"),
        (F.col("value") / 1000).alias("upvote_ratio"),
        F.col("user_id").cast("int").alias("num_comments"),
        (k < 10).alias("is_crosspost"),
        F.when(k < 10, kind).alias("original_subreddit"),
    ]


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete raw events."""
    return source_events(spark, sf_dir).select(*_raw_columns())


def enriched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete raw events, most of them with an enrichment."""
    k, kind = F.col("k"), F.col("event_type")
    enrichment = F.struct(
        F.when(k >= 30, F.array(F.lit("en"), F.lit("fr"))).alias("languages"),
        F.concat(F.lit("about "), kind).alias("translation"),
        F.when(k >= 5, F.col("value")).alias("sentiment_score"),
        F.lit("discussion").alias("intent"),
        F.when(k >= 40, F.array(kind, F.concat(F.lit("k"), k))).alias("topics"),
        F.array(
            F.struct(kind.alias("name"), F.lit("Person").alias("type")),
            F.struct(F.concat(F.lit("n"), k).alias("name"), F.lit("Location").alias("type")),
        ).alias("entities"),
    ).cast(struct_type(ENRICHMENT))
    return source_events(spark, sf_dir).select(
        *_raw_columns(), F.when(k < 90, enrichment).alias("enrichment")
    )


def doubtful_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched events of which each quality rule finds some wrong."""
    k, kind = F.col("k"), F.col("event_type")
    enrichment = F.struct(
        F.array(F.when(k >= 10, F.lit("en")).when(k >= 5, F.lit("klingon"))).alias("languages"),
        F.lit("about").alias("translation"),
        ((k - 50) / 40).alias("sentiment_score"),
        F.when(k % 10 < 7, "question").otherwise("riddle").alias("intent"),
        F.slice(F.array(kind, kind, kind, kind, kind), 1, F.greatest(k % 6, F.lit(1))).alias("topics"),
        F.array(
            F.struct(kind.alias("name"), F.when(k % 7 != 0, "Person").alias("type")),
            F.struct(kind.alias("name"), F.when(k % 5 == 0, "Planet").otherwise("Location").alias("type")),
        ).alias("entities"),
    ).cast(struct_type(ENRICHMENT))
    return source_events(spark, sf_dir).select(
        *_raw_columns(), F.when(k < 95, enrichment).alias("enrichment")
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as posts, seven seconds apart."""
    return _table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("source").alias("title"),
        F.col("text").alias("content"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 7).alias("timestamp"),
        "lang",
        "n_chars",
    )


def document_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as complete raw events."""
    return documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("event_id"),
        F.lit("POST").alias("event_type"),
        F.col("title").alias("posted_in_subreddit"),
        F.col("lang").alias("author"),
        F.concat(F.lit("https://example.org/"), "doc_id").alias("url"),
        "title",
        "content",
        "timestamp",
        F.lit(False).alias("has_media"),
        F.array().cast("array<string>").alias("media_urls"),
        F.col("n_chars").cast("int").alias("score"),
        F.lit(None).cast("double").alias("upvote_ratio"),
        F.lit(None).cast("int").alias("num_comments"),
        F.lit(False).alias("is_crosspost"),
        F.lit(None).cast("string").alias("original_subreddit"),
    )


def listing_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and conversations as JSON listing pages (``endpoint``, ``body``).

    A page holds a hundred documents or up to a hundred turns of a conversation.
    """
    posts = documents(spark, sf_dir).select(
        F.floor(F.col("doc_id") / 100).cast("string").alias("page"),
        F.struct(
            F.struct(
                F.concat(F.lit("t3_"), "doc_id").alias("name"),
                F.col("title").alias("subreddit"),
                F.when(F.col("lang") != "en", F.col("lang")).alias("author"),
                F.unix_timestamp("timestamp").cast("double").alias("created_utc"),
                F.concat(F.lit("https://example.org/"), "doc_id").alias("url"),
                "title",
                F.col("content").alias("selftext"),
                F.col("n_chars").alias("score"),
                (F.col("lang") == "fr").alias("is_crosspost"),
                F.array(F.struct(F.col("lang").alias("subreddit"))).alias("crosspost_parent_list"),
            ).alias("data")
        ).alias("child"),
    )
    comments = _table(spark, sf_dir, "conversations").select(
        F.concat_ws("_", "conv_id", F.floor(F.col("turn") / 100)).alias("page"),
        F.struct(
            F.struct(
                F.concat_ws("_", "conv_id", "turn").alias("id"),
                F.col("role").alias("subreddit"),
                F.col("role").alias("author"),
                (F.lit(1704067200) + F.col("turn") * 60).cast("double").alias("created_utc"),
                F.concat(F.lit("https://example.org/c/"), "conv_id").alias("link_url"),
                F.col("text").alias("body"),
            ).alias("data")
        ).alias("child"),
    )

    def pages(children: DataFrame, endpoint: str) -> DataFrame:
        body = F.struct(F.struct(F.collect_list("child").alias("children")).alias("data"))
        return children.groupBy("page").agg(F.to_json(body).alias("body")).select(
            F.lit(endpoint).alias("endpoint"), "body"
        )

    return pages(posts, "new").unionByName(pages(comments, "comments"))


def damaged_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per document (``endpoint``, ``body``); by its id, a page or child may be damaged."""
    kind = F.col("doc_id") % 10
    number = F.col("doc_id").cast("string")
    child = F.struct(
        F.concat(F.lit("t3_"), number).alias("name"),
        F.col("source").alias("subreddit"),
        F.lit("a").alias("author"),
        F.when(kind == 1, "yesterday")
        .when(kind == 2, "2024-01-01T00:00:07Z")
        .otherwise((F.lit(1704067200) + F.col("doc_id") * 7).cast("string"))
        .alias("created_utc"),
        F.lit("u").alias("url"),
        F.col("text").alias("selftext"),
        F.when(kind == 3, "many").otherwise(number).alias("score"),
        F.when(kind == 4, "maybe").when(kind == 5, "true").alias("is_crosspost"),
    )
    body = F.to_json(F.struct(F.struct(F.array(F.struct(child.alias("data"))).alias("children")).alias("data")))
    body = F.when(kind == 6, F.concat(F.lit("<html> "), number)).when(
        kind == 7, '{"data": {"children": [{"kind": "none"}]}}'
    ).otherwise(body)
    endpoint = F.when(kind == 8, "about").otherwise("new")
    return _table(spark, sf_dir, "documents").select(
        "doc_id", endpoint.alias("endpoint"), body.alias("body")
    )


def page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as listing items whose media are the page's links."""
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)
    source = F.transform(
        links,
        lambda link, at: F.struct(
            at.cast("string").alias("key"),
            F.struct(
                F.struct(
                    F.when(F.pmod(at, F.lit(3)) != 1, F.concat(link, F.lit("?a&amp;b"))).alias("u"),
                    F.when(F.pmod(at, F.lit(3)) != 2, F.concat(link, F.lit(".gif&amp;c"))).alias("gif"),
                ).alias("s")
            ).alias("value"),
        ),
    )
    url = F.col("url")
    item = F.struct(
        F.when(F.length(url) > 40, F.concat(url, F.lit(".png"))).otherwise(url).alias("url"),
        url.startswith("https://m.").alias("is_video"),
        F.struct(F.struct(url.alias("fallback_url")).alias("reddit_video")).alias("secure_media"),
        url.startswith("https").alias("is_gallery"),
        F.map_from_entries(source).alias("media_metadata"),
        F.lit("image").alias("post_hint"),
    )
    kind = F.when(url.contains(".org"), "COMMENT").otherwise("POST")
    return _table(spark, sf_dir, "pages").select("page_id", kind.alias("event_type"), item.alias("item"))
