import json

import pytest
from support import rows

from chatterloom.__main__ import main
from chatterloom.schemas import TABLES
from chatterloom.sinks.tables import read_table


def test_whole_flow(spark, path, tmp_path):
    folder = tmp_path / "pages" / "endpoint=new"
    folder.mkdir(parents=True)
    items = [
        {"data": {"name": f"t3_{i}", "subreddit": "g", "created_utc": 1704067200 + 60 * i, "url": "u", "title": "lovely weather", "score": i}}
        for i in range(4)
    ]
    (folder / "1.json").write_text(json.dumps({"data": {"children": items}}))
    common = ["--format", "text", "--checkpoints", path("checkpoints"), "--once"]
    odd = ["--quarantine", path("odd")]
    main(["ingestion", "--source", path("pages"), "--output", path("raw"), *odd, *common])
    routes = ["--output", path("ok"), "--dead-letter", path("dlq"), "--quarantine", path("bad")]
    main(["processing", "--source", path("raw"), *routes, *common])
    main(["storage", "--source", path("ok"), "--output", path("lake"), "--quarantine", path("left"), *common])
    for job in ("save_raw", "trending_words", "tumbling_counts"):
        extra = ["--quarantine", path("bad_raw")] if job == "save_raw" else ["--batch-limit", "7"]
        main([job, "--source", path("raw"), "--output", path("tables"), *extra, *common])
    for job in ("save_enriched", "trending_topics"):
        extra = ["--quarantine", path("bad_raw")] if job == "save_enriched" else []
        main([job, "--source", path("ok"), "--output", path("tables"), *extra, *common])
    main(["live_rates", "--source", path("raw"), "--output", path("live"), *common])
    assert {r.stream for r in read_table(spark, TABLES["event_rates"], path("live") + "/event_rates").collect()} == {"raw"}
    again = ["--output", path("ok"), "--dead-letter", path("dlq"), "--final", path("final"), "--quarantine", path("bad")]
    (tmp_path / "dlq").mkdir(exist_ok=True)
    main(["retry", *again, *common])
    main(["event_rates", "--lake", path("tables"), "--output", path("tables")])
    main(["top_posts", "--lake", path("lake"), "--output", path("tables")])
    main(["all_batch", "--lake", path("lake"), "--output", path("tables")])

    def table(name):
        return read_table(spark, TABLES[name], f"{path('tables')}/{name}")

    assert table("raw_events").count() == table("enriched_events").count() == 4
    assert rows(table("batch_top_posts").select("event_id", "score")) == [(f"t3_{i}", i) for i in range(4)]
    assert rows(table("batch_weekly_topics").select("topic", "topic_count")) == [
        ("dummy-data", 4),
        ("testing", 4),
        ("workflow-validation", 4),
    ]
    assert {r.word for r in table("trending_words_metrics").collect()} == {"lovely", "weather"}
    assert table("trending_topics_metrics").count() > 0
    assert table("event_rates").count() == 8 and table("tumbling_counts_metrics").count() > 0


def test_unknown_job():
    with pytest.raises(SystemExit):
        main(["nonsense", "--output", "x"])


@pytest.mark.parametrize(
    ("job", "given", "missing"),
    [
        ("processing", ["--quarantine", "q", "--checkpoints", "c"], "--dead-letter"),
        ("processing", ["--dead-letter", "d", "--checkpoints", "c"], "--quarantine"),
        ("save_raw", ["--checkpoints", "c"], "--quarantine"),
        ("storage", ["--checkpoints", "c"], "--quarantine"),
        ("ingestion", ["--checkpoints", "c"], "--quarantine"),
        ("trending_words", [], "--checkpoints"),
        ("retry", ["--dead-letter", "d", "--quarantine", "q", "--checkpoints", "c"], "--final"),
    ],
)
def test_missing_arguments_are_named(capsys, job, given, missing):
    with pytest.raises(SystemExit):
        main([job, "--source", "s", "--output", "o", *given])
    assert missing in capsys.readouterr().err


def test_batch_jobs_need_a_lake(capsys):
    with pytest.raises(SystemExit):
        main(["top_posts", "--output", "o"])
    assert "--lake" in capsys.readouterr().err


def test_equal_targets_are_refused(spark, path, tmp_path):
    (tmp_path / "log").mkdir()
    same = ["--output", path("x"), "--dead-letter", path("x"), "--quarantine", path("y")]
    with pytest.raises(ValueError, match="target each"):
        main(["processing", "--source", path("log"), *same, "--format", "text", "--checkpoints", path("c"), "--once"])
