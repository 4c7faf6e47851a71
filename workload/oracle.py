"""The SQL each query is checked against."""

from __future__ import annotations

# The frames of workload.frames, as common table expressions.

_SOURCE = """
src AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS timestamp, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""

_LAKE = _SOURCE + """,
ev AS (
  SELECT event_id, timestamp, event_type AS posted_in_subreddit,
         event_type || ' ' || user_id AS title, k AS score,
         CASE WHEN k >= 5 THEN floor(value * 4) / 4 END AS enrichment_sentiment,
         [event_type, ' K' || CAST(k // 10 AS VARCHAR) || ' ',
          CASE WHEN k < 50 THEN '' ELSE event_type END] AS enrichment_topics
  FROM src)"""

_COPIES = _LAKE + """,
copies AS (
  SELECT * FROM ev
  UNION ALL BY NAME
  SELECT * REPLACE (timestamp + to_seconds(score - 50) AS timestamp, 99 - score AS score) FROM ev)"""

_UNIQUE = _COPIES + """,
uniq AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY event_id
      ORDER BY timestamp DESC, score DESC NULLS LAST, enrichment_sentiment DESC NULLS LAST) AS rn
    FROM copies)
  WHERE rn = 1)"""

_RAW = _SOURCE + """,
raw AS (
  SELECT event_id,
         CASE WHEN event_type IN ('click', 'view') THEN 'POST' ELSE 'COMMENT' END AS event_type,
         event_type AS posted_in_subreddit, 'u' || user_id AS author,
         'https://example.org/' || event_id AS url,
         CASE WHEN k >= 20 THEN event_type END AS title,
         'He said "' || k || '"' || chr(10) || '\\ é ،' AS content,
         timestamp, k >= 50 AS has_media,
         CASE WHEN k >= 50 THEN 'https://example.org/' || event_id || '|https://example.org/' || event_id
              ELSE '' END AS media_urls,
         CASE WHEN k >= 10 THEN k END AS score,
         value / 1000 AS upvote_ratio, CAST(user_id AS INTEGER) AS num_comments,
         k < 10 AS is_crosspost, CASE WHEN k < 10 THEN event_type END AS original_subreddit
  FROM src)"""

_ENRICHED = _RAW + """,
enr AS (
  SELECT raw.*, src.k < 90 AS has_enrichment, src.event_type AS kind, src.k,
         CASE WHEN src.k < 90 AND src.k >= 5 THEN src.value END AS sentiment
  FROM raw JOIN src USING (event_id))"""

_DOCS = """
docs AS (
  SELECT doc_id, source AS title, text AS content, lang, n_chars,
         TIMESTAMP '2024-01-01' + to_seconds(doc_id * 7) AS timestamp,
         regexp_replace(source || chr(10) || chr(10) || text,
           '^[\\s\\x0b\\x1c-\\x1f\\x{85}\\pZ]+|[\\s\\x0b\\x1c-\\x1f\\x{85}\\pZ]+$', '', 'g') AS text
  FROM documents)"""

_PACKED = _DOCS + """,
numbered AS (
  SELECT *, doc_id // 192 AS piece,
         row_number() OVER (PARTITION BY title, doc_id // 192 ORDER BY doc_id) - 1 AS rn FROM docs),
chunked AS (SELECT *, rn // 5 AS chunk, rn % 5 + 1 AS position FROM numbered)"""


def _reply(length: str) -> str:
    """Outcome of the length-driven provider for texts of that length."""
    return f"""
  CASE {length} % 10 WHEN 0 THEN 'reply:missing' WHEN 1 THEN 'provider:RuntimeError'
                     WHEN 2 THEN 'languages:unknown' END AS reason,
  CASE WHEN {length} % 10 > 2 THEN {length} / 100.0 END AS sentiment_score,
  CASE WHEN {length} % 10 > 2 THEN 't' || ({length} % 10) END AS topics"""


_STOP_WORDS = """
('the','and','this','that','with','from','for','what','your','would','want','have','when','they',
 'there','which','about','like','just','more','here','actually','https','what''s','most','being',
 'thing','were','ever','eli','mta3','ala','fama','haka','bech','fi','ken','houwa','hiyya','mouch',
 'bara','aya')"""

_WORDS = _DOCS + f""",
spoken AS (
  SELECT timestamp, unnest(regexp_split_to_array(
    regexp_replace(lower(title || ' ' || content), '[[:punct:]]', ' ', 'g'), '\\s+')) AS word
  FROM docs),
rows AS (SELECT * FROM spoken WHERE length(word) > 3 AND word NOT IN {_STOP_WORDS})"""


def _windows(key: str, size: int, slide: int) -> str:
    """Rows per sliding window, from a table ``rows``."""
    return f"""
windows AS (
  SELECT time_bucket(INTERVAL {slide} SECOND, timestamp, TIMESTAMP '1970-01-01')
           - to_seconds({slide} * step) AS window_start, {key}
  FROM rows, range({size} // {slide}) AS r(step)),
counted AS (
  SELECT window_start, window_start + INTERVAL {size} SECOND AS window_end, {key},
         count(*) AS count
  FROM windows GROUP BY ALL)"""


_CLOSED = "WHERE window_end <= (SELECT max(timestamp) - INTERVAL 30 SECOND FROM rows)"

_RATES = """
rates AS (
  SELECT event_type AS stream, date_trunc('minute', ts) AS minute_start, count(*) AS events
  FROM events GROUP BY ALL)"""


def _sentiment(grain: str) -> str:
    return f"""
WITH {_UNIQUE}
SELECT date_trunc('{grain}', timestamp) AS {grain}_start, posted_in_subreddit AS subreddit,
       avg(enrichment_sentiment) AS avg_sentiment, count(enrichment_sentiment) AS sentiment_count,
       count(*) AS post_count, avg(score) AS avg_score,
       round(stddev_pop(enrichment_sentiment), 6) AS sentiment_stddev,
       min(enrichment_sentiment) AS sentiment_min, max(enrichment_sentiment) AS sentiment_max,
       array_to_string(list_sort(list(event_id))[1:10], '|') AS sample_event_ids
FROM uniq GROUP BY ALL"""


_LISTED = """
listed AS (
  SELECT 't3_' || doc_id AS event_id, 'POST' AS event_type, source AS posted_in_subreddit,
         CASE WHEN lang <> 'en' THEN lang ELSE '[deleted]' END AS author,
         'https://example.org/' || doc_id AS url, source AS title, text AS content,
         TIMESTAMP '2024-01-01' + to_seconds(doc_id * 7) AS timestamp,
         CAST(n_chars AS INTEGER) AS score, lang = 'fr' AS is_crosspost,
         CASE WHEN lang = 'fr' THEN lang END AS original_subreddit
  FROM documents
  UNION ALL
  SELECT conv_id || '_' || turn, 'COMMENT', role, role, 'https://example.org/c/' || conv_id, '', text,
         TIMESTAMP '2024-01-01' + to_seconds(turn * 60), NULL, false, NULL
  FROM conversations)"""

_MEDIA = """
pg AS (
  SELECT page_id, url, CASE WHEN url LIKE '%.org%' THEN 'COMMENT' ELSE 'POST' END AS event_type,
         regexp_extract_all(html, 'href="([^"]*)"', 1) AS links FROM pages),
attached AS (
  SELECT page_id, pos,
         CASE WHEN pos % 3 <> 1 THEN replace(link || '?a&amp;b', '&amp;', '&') END AS u,
         CASE WHEN pos % 3 <> 2 THEN replace(link || '.gif&amp;c', '&amp;', '&') END AS gif
  FROM (SELECT page_id, unnest(links) AS link, generate_subscripts(links, 1) - 1 AS pos FROM pg)),
maps AS (
  SELECT page_id, string_agg(u, '|' ORDER BY pos) AS us,
         string_agg(coalesce(u, gif), '|' ORDER BY pos) AS any_links
  FROM attached GROUP BY page_id),
media AS (
  SELECT page_id, event_type,
         CASE WHEN event_type = 'COMMENT' THEN coalesce(any_links, '')
              WHEN starts_with(url, 'https://m.') THEN url
              WHEN starts_with(url, 'https') THEN coalesce(us, '')
              WHEN length(url) > 40 THEN url || '.png'
              WHEN regexp_matches(url, '\\.(jpg|png|gif|jpeg)$') THEN url
              ELSE '' END AS media_urls
  FROM pg LEFT JOIN maps USING (page_id))"""

_REPOSTS = _RAW + """,
reposts AS (
  SELECT event_id, CASE WHEN score IS NULL THEN timestamp + INTERVAL 1 SECOND ELSE timestamp END AS timestamp,
         * EXCLUDE (event_id, timestamp) FROM raw),
fresh AS (
  SELECT * FROM reposts b
  WHERE NOT EXISTS (SELECT 1 FROM raw t WHERE t.event_id = b.event_id AND t.timestamp = b.timestamp))"""

_DAMAGED = _SOURCE + """,
bad AS (
  SELECT *, CASE
    WHEN k < 10 THEN 'corrupt'
    WHEN k BETWEEN 10 AND 19 THEN 'event_id:missing'
    WHEN k BETWEEN 20 AND 29 THEN 'event_type:unknown'
    WHEN k BETWEEN 30 AND 39 THEN 'timestamp:missing,timestamp:type'
    WHEN k BETWEEN 50 AND 59 THEN 'score:type'
    WHEN k BETWEEN 70 AND 74 THEN 'url:missing' END AS reasons
  FROM src)"""

_RAW_COLUMNS = """event_id, event_type, posted_in_subreddit, author, url, title, content, timestamp,
       has_media, media_urls, score, upvote_ratio, num_comments, is_crosspost, original_subreddit"""

_FLAT_ENRICHED = f"""
WITH {_ENRICHED}
SELECT {_RAW_COLUMNS},
       CASE WHEN has_enrichment AND k >= 30 THEN 'en|fr' END AS languages,
       CASE WHEN has_enrichment THEN 'about ' || kind END AS translation,
       sentiment AS sentiment_score,
       CASE WHEN has_enrichment THEN 'discussion' END AS intent,
       CASE WHEN has_enrichment AND k >= 40 THEN kind || '|k' || k END AS topics,
       CASE WHEN has_enrichment THEN '[{{"name":"' || kind || '","type":"Person"}},{{"name":"n' || k
            || '","type":"Location"}}]' END AS entities
FROM enr"""

_LAKE_LAYOUT = f"""
WITH {_ENRICHED}
SELECT {_RAW_COLUMNS},
       CASE WHEN k >= 30 THEN 'en|fr' ELSE '' END AS enrichment_languages,
       'about ' || kind AS enrichment_translation, sentiment AS enrichment_sentiment,
       'discussion' AS enrichment_intent,
       CASE WHEN k >= 40 THEN kind || '|k' || k ELSE '' END AS enrichment_topics,
       kind || '|n' || k AS enrichment_entity_names, 'Person|Location' AS enrichment_entity_types
FROM enr WHERE has_enrichment"""

_LAKE_STORED = f"""
SELECT *, CAST(year(timestamp) AS INTEGER) AS year, CAST(month(timestamp) AS INTEGER) AS month,
       CAST(day(timestamp) AS INTEGER) AS day
FROM ({_LAKE_LAYOUT})"""

_TOPIC_SENTIMENT = f"""
WITH {_UNIQUE}
SELECT date_trunc('day', timestamp) AS day_start, topic, avg(enrichment_sentiment) AS avg_sentiment,
       count(enrichment_sentiment) AS sentiment_count, count(*) AS post_count
FROM (SELECT timestamp, enrichment_sentiment, unnest(enrichment_topics) AS topic FROM uniq)
GROUP BY ALL"""

_MENTIONS = """
rows AS (
  SELECT timestamp, lower(trim(topic)) AS topic
  FROM (SELECT timestamp, unnest(enrichment_topics) AS topic FROM ev)
  WHERE trim(topic) <> '')"""

_TUMBLING = """
tumbling AS (
  SELECT date_trunc('minute', timestamp) AS window_start,
         date_trunc('minute', timestamp) + INTERVAL 1 MINUTE AS window_end, count(*) AS count
  FROM rows GROUP BY ALL)"""

_DOC_EVENTS = """
doc_events AS (
  SELECT CAST(doc_id AS VARCHAR) AS event_id, 'POST' AS event_type, title AS posted_in_subreddit,
         lang AS author, 'https://example.org/' || doc_id AS url, title, content, timestamp,
         false AS has_media, '' AS media_urls, CAST(n_chars AS INTEGER) AS score,
         CAST(NULL AS DOUBLE) AS upvote_ratio, CAST(NULL AS INTEGER) AS num_comments,
         false AS is_crosspost, CAST(NULL AS VARCHAR) AS original_subreddit, text
  FROM docs)"""

# Which documents have which damage as listing children.
_DAMAGED_PAGES = """
damaged AS (
  SELECT *, doc_id % 10 AS kind,
         CASE doc_id % 10 WHEN 1 THEN 'created_utc:type' WHEN 3 THEN 'score:type'
                          WHEN 4 THEN 'is_crosspost:type' WHEN 6 THEN 'page:corrupt'
                          WHEN 7 THEN 'child:missing' WHEN 8 THEN 'page:endpoint' END AS reasons
  FROM documents)"""

ORACLE = {
    "daily_sentiment": _sentiment("day"),
    "hourly_sentiment": _sentiment("hour"),
    "daily_sentiment_bounded": _sentiment("day"),
    "job_suite_daily": _sentiment("day"),
    "job_suite_hourly": _sentiment("hour"),
    "job_suite_topic": _TOPIC_SENTIMENT,
    "topic_sentiment": _TOPIC_SENTIMENT,
    "weekly_topics": f"""
WITH {_UNIQUE}
SELECT date_trunc('week', timestamp)::TIMESTAMP AS week_start, topic, count(*) AS topic_count
FROM (SELECT timestamp, unnest(enrichment_topics) AS topic FROM uniq) GROUP BY ALL""",
    "weekly_topics_incremental": f"""
WITH {_UNIQUE}
SELECT date_trunc('week', timestamp)::TIMESTAMP AS week_start, topic, count(*) AS topic_count
FROM (SELECT timestamp, unnest(enrichment_topics) AS topic FROM uniq) GROUP BY ALL""",
    "daily_sentiment_incremental": _sentiment("day"),
    "top_posts": f"""
WITH {_UNIQUE}
SELECT date_trunc('day', timestamp) AS day_start, posted_in_subreddit AS subreddit, event_id, title,
       score, enrichment_sentiment AS sentiment_score
FROM uniq
QUALIFY row_number() OVER (PARTITION BY date_trunc('day', timestamp), posted_in_subreddit
                           ORDER BY score DESC NULLS LAST, event_id) <= 10""",
    "job_suite_weekly_topics": f"""
WITH {_UNIQUE}
SELECT date_trunc('week', timestamp)::TIMESTAMP AS week_start, topic, count(*) AS topic_count
FROM (SELECT timestamp, unnest(enrichment_topics) AS topic FROM uniq) GROUP BY ALL""",
    "job_suite_top_posts": f"""
WITH {_UNIQUE}
SELECT date_trunc('day', timestamp) AS day_start, posted_in_subreddit AS subreddit, event_id, title,
       score, enrichment_sentiment AS sentiment_score
FROM uniq
QUALIFY row_number() OVER (PARTITION BY date_trunc('day', timestamp), posted_in_subreddit
                           ORDER BY score DESC NULLS LAST, event_id) <= 10""",
    "dedup_latest_events": f"""
WITH {_UNIQUE}
SELECT * REPLACE (array_to_string(enrichment_topics, '|') AS enrichment_topics) FROM uniq""",
    "dedup_report_events": f"""
WITH {_COPIES}
SELECT count(*) AS rows_before, count(DISTINCT event_id) AS rows_after,
       count(*) - count(DISTINCT event_id) AS rows_removed FROM copies""",
    "trending_words_batch": f"WITH {_WORDS}, {_windows('word', 30, 15)} SELECT * FROM counted",
    "trending_words_wide": f"WITH {_WORDS}, {_windows('word', 600, 300)} SELECT * FROM counted",
    "trending_words_stream": f"WITH {_WORDS}, {_windows('word', 30, 15)} SELECT * FROM counted {_CLOSED}",
    "trending_topics_batch": f"""
WITH {_LAKE}, {_MENTIONS}, {_windows('topic', 30, 15)} SELECT * FROM counted""",
    "trending_topics_stream": f"""
WITH {_ENRICHED},
rows AS (
  SELECT timestamp, lower(unnest([kind, 'k' || k])) AS topic
  FROM enr WHERE has_enrichment AND k >= 40),
{_windows('topic', 30, 15)} SELECT * FROM counted {_CLOSED}""",
    "trending_topics_unique_stream": f"""
WITH {_ENRICHED},
rows AS (
  SELECT timestamp, lower(unnest([kind, 'k' || k])) AS topic
  FROM enr WHERE has_enrichment AND k >= 40),
{_windows('topic', 30, 15)} SELECT * FROM counted
WHERE window_end <= (SELECT max(timestamp) - INTERVAL 30 SECOND FROM src)""",
    "save_raw_stream": f"WITH {_RAW} SELECT {_RAW_COLUMNS} FROM raw",
    "save_enriched_stream": _FLAT_ENRICHED,
    "tumbling_counts_batch": f"""
WITH {_DOCS}, rows AS (SELECT timestamp FROM docs)
SELECT date_trunc('minute', timestamp) AS window_start,
       date_trunc('minute', timestamp) + INTERVAL 1 MINUTE AS window_end, count(*) AS count
FROM rows GROUP BY ALL""",
    "tumbling_counts_stream": f"""
WITH {_DOCS}, rows AS (SELECT timestamp FROM docs), {_TUMBLING}
SELECT * FROM tumbling {_CLOSED}""",
    "late_drop_stream": f"""
WITH {_DOCS}, rows AS (SELECT timestamp FROM docs), {_TUMBLING}
SELECT *, true AS some_refused FROM tumbling {_CLOSED}""",
    "late_rows_stream": f"""
WITH {_DOCS},
span AS (SELECT min(epoch(timestamp)) AS low, max(epoch(timestamp)) AS high FROM docs),
twice AS (
  SELECT doc_id, timestamp, false AS again FROM docs
  UNION ALL
  SELECT doc_id, timestamp, true FROM docs, span WHERE epoch(timestamp) < low + (high - low) / 3),
judged AS (
  SELECT *, again AND epoch(date_trunc('minute', timestamp)) + 60 <= high - 30 AS late FROM twice, span)
SELECT 'counted' AS kind, date_trunc('minute', timestamp) AS time, CAST(NULL AS VARCHAR) AS event_id, count(*) AS count
FROM judged WHERE NOT late GROUP BY ALL
UNION ALL
SELECT 'late', timestamp, CAST(doc_id AS VARCHAR), 1 FROM judged WHERE late
UNION ALL
SELECT 'late_total', NULL, NULL, count(*) FROM judged WHERE late""",
    "live_rates_stream": f"""
WITH {_RATES},
averaged AS (
  SELECT *, avg(events) OVER (
    PARTITION BY stream ORDER BY minute_start
    RANGE BETWEEN INTERVAL 4 MINUTE PRECEDING AND CURRENT ROW) AS rolling_avg
  FROM rates)
SELECT * FROM averaged
WHERE minute_start + INTERVAL 1 MINUTE <= (SELECT max(ts) - INTERVAL 30 SECOND FROM events)""",
    "dead_letter_retries": f"""
WITH {_DOCS}
SELECT CAST(doc_id AS VARCHAR) AS event_id, CASE WHEN length(text) % 5 < 4 THEN length(text) / 100 END AS sentiment_score,
       CASE WHEN length(text) % 5 < 4 THEN 'enriched' ELSE 'given up' END AS outcome
FROM docs""",
    "window_cap": f"""
WITH {_LAKE}
SELECT event_id, timestamp, date_trunc('hour', timestamp) AS window_start, row_number() OVER (
  PARTITION BY date_trunc('hour', timestamp) ORDER BY timestamp, event_id) > 3 AS over_cap
FROM ev""",
    "window_cap_stream": f"""
WITH {_RAW}
SELECT {_RAW_COLUMNS}, row_number() OVER (
  PARTITION BY date_trunc('hour', timestamp) ORDER BY timestamp, event_id) > 3 AS over_cap
FROM raw""",
    "window_cap_state_stream": f"""
WITH {_RAW}
SELECT {_RAW_COLUMNS}, row_number() OVER (
  PARTITION BY date_trunc('hour', timestamp) ORDER BY timestamp, event_id) > 3 AS over_cap
FROM raw""",
    "raw_roundtrip": f"WITH {_RAW} SELECT {_RAW_COLUMNS} FROM raw",
    "enriched_flatten": _FLAT_ENRICHED,
    "lake_flatten": _LAKE_LAYOUT,
    "lake_roundtrip": _LAKE_STORED,
    "store_log_stream": _LAKE_STORED,
    "validate_usable": f"""
WITH {_DAMAGED}
SELECT event_id, 'POST' AS event_type, timestamp, k AS score,
       CASE WHEN k BETWEEN 60 AND 69 THEN 3 ELSE k END AS num_comments
FROM bad WHERE reasons IS NULL""",
    "quarantine_reasons": f"""
WITH {_DAMAGED}
SELECT reasons, count(*) AS messages FROM bad WHERE reasons IS NOT NULL GROUP BY ALL""",
    "quality_report": f"""
WITH {_ENRICHED}
SELECT event_id, CASE WHEN k < 95 THEN concat_ws(',',
    CASE WHEN k < 10 THEN 'languages' END,
    CASE WHEN NOT (k - 50) / 40.0 BETWEEN -1 AND 1 THEN 'sentiment_score' END,
    CASE WHEN k % 10 >= 7 THEN 'intent' END,
    CASE WHEN NOT greatest(k % 6, 1) BETWEEN 2 AND 4 THEN 'topics' END,
    CASE WHEN k % 7 = 0 OR k % 5 = 0 THEN 'entities' END) ELSE '' END AS flags
FROM enr""",
    "normalize_listing": f"""
WITH {_LISTED}
SELECT *, false AS has_media, '' AS media_urls, CAST(NULL AS DOUBLE) AS upvote_ratio,
       CAST(NULL AS INTEGER) AS num_comments FROM listed""",
    "ingest_to_lake": f"""
WITH {_LISTED},
asked AS (
  SELECT *, length(regexp_replace(
    title || chr(10) || chr(10) || content,
    '^[\\s\\x0b\\x1c-\\x1f\\x{{85}}\\pZ]+|[\\s\\x0b\\x1c-\\x1f\\x{{85}}\\pZ]+$', '', 'g')) AS n
  FROM listed),
replied AS (SELECT *, {_reply('n')} FROM asked)
SELECT event_id, event_type, posted_in_subreddit, author, url, title, content, timestamp,
       false AS has_media, '' AS media_urls, score, CAST(NULL AS DOUBLE) AS upvote_ratio,
       CAST(NULL AS INTEGER) AS num_comments, is_crosspost, original_subreddit,
       'fr' AS enrichment_languages, CAST(NULL AS VARCHAR) AS enrichment_translation,
       sentiment_score AS enrichment_sentiment, CAST(NULL AS VARCHAR) AS enrichment_intent,
       topics AS enrichment_topics, '' AS enrichment_entity_names, '' AS enrichment_entity_types,
       CAST(year(timestamp) AS INTEGER) AS year, CAST(month(timestamp) AS INTEGER) AS month,
       CAST(day(timestamp) AS INTEGER) AS day
FROM replied WHERE reason IS NULL""",
    "route_dead_letters": f"""
WITH {_DOCS}, {_DOC_EVENTS}, replied AS (SELECT *, {_reply('length(text)')} FROM doc_events)
SELECT {_RAW_COLUMNS}, CAST(NULL AS VARCHAR) AS languages, CAST(NULL AS VARCHAR) AS translation,
       CAST(NULL AS DOUBLE) AS sentiment_score, CAST(NULL AS VARCHAR) AS intent,
       CAST(NULL AS VARCHAR) AS topics, CAST(NULL AS VARCHAR) AS entities
FROM replied WHERE reason IS NOT NULL""",
    "route_quarantine": f"""
WITH {_DAMAGED},
fields AS (
  SELECT *, CASE WHEN k BETWEEN 10 AND 19 THEN '' ELSE event_id END AS id_text,
         CASE WHEN k BETWEEN 20 AND 29 THEN 'LINK' ELSE 'POST' END AS type_text,
         CASE WHEN k BETWEEN 30 AND 39 THEN 'bad'
              ELSE strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') END AS time_text,
         CASE WHEN k BETWEEN 50 AND 59 THEN 'abc' ELSE CAST(k AS VARCHAR) END AS score_text
  FROM bad WHERE reasons IS NOT NULL)
SELECT reasons, CASE WHEN k < 10 THEN 'not json ' || event_id ELSE
  '{{"event_id":"' || id_text || '","event_type":"' || type_text || '","posted_in_subreddit":"' || event_type
  || '","author":"a",' || CASE WHEN k BETWEEN 70 AND 74 THEN '' ELSE '"url":"u",' END
  || '"timestamp":"' || time_text || '","score":"' || score_text || '","num_comments":"' || k || '"}}' END AS payload
FROM fields""",
    "log_of_two_streams": f"""
WITH {_LISTED}
SELECT *, false AS has_media, '' AS media_urls, CAST(NULL AS DOUBLE) AS upvote_ratio,
       CAST(NULL AS INTEGER) AS num_comments FROM listed""",
    "damaged_listing_events": f"""
WITH {_DAMAGED_PAGES}
SELECT 't3_' || doc_id AS event_id, 'POST' AS event_type, source AS posted_in_subreddit, 'a' AS author,
       'u' AS url, CAST(NULL AS VARCHAR) AS title, text AS content,
       CASE WHEN kind = 2 THEN TIMESTAMP '2024-01-01 00:00:07'
            ELSE TIMESTAMP '2024-01-01' + to_seconds(doc_id * 7) END AS timestamp,
       false AS has_media, '' AS media_urls, CAST(doc_id AS INTEGER) AS score,
       CAST(NULL AS DOUBLE) AS upvote_ratio, CAST(NULL AS INTEGER) AS num_comments,
       kind = 5 AS is_crosspost, CAST(NULL AS VARCHAR) AS original_subreddit
FROM damaged WHERE reasons IS NULL""",
    "damaged_listing_quarantine": f"""
WITH {_DAMAGED_PAGES}
SELECT CASE WHEN kind = 8 THEN 'about' ELSE 'new' END AS endpoint, reasons, count(*) AS children
FROM damaged WHERE reasons IS NOT NULL GROUP BY ALL""",
    "media_links": f"WITH {_MEDIA} SELECT page_id, media_urls FROM media",
    "media_stats": f"""
WITH {_MEDIA}
SELECT event_type, count(*) AS events, count(*) FILTER (WHERE media_urls <> '') AS with_media
FROM media GROUP BY ALL""",
    "incremental_cursor": f"""
WITH {_LAKE},
marks AS (
  SELECT posted_in_subreddit, timestamp AS t, event_id AS i FROM ev
  QUALIFY row_number() OVER (PARTITION BY posted_in_subreddit
                             ORDER BY score DESC, timestamp DESC, event_id DESC) = 1)
SELECT posted_in_subreddit, timestamp, event_id, score FROM ev JOIN marks USING (posted_in_subreddit)
WHERE timestamp > t OR (timestamp = t AND event_id > i)""",
    "poll_since_mark": f"""
WITH {_LAKE},
marks AS (
  SELECT posted_in_subreddit, max(timestamp) - INTERVAL 10 DAY AS t FROM ev GROUP BY ALL)
SELECT posted_in_subreddit, timestamp, event_id FROM ev JOIN marks USING (posted_in_subreddit)
WHERE timestamp > t""",
    "poll_twice": f"""
WITH {_LAKE}
SELECT posted_in_subreddit, timestamp, event_id, CAST((place - 1) // 100 AS INTEGER) AS poll FROM (
  SELECT *, row_number() OVER (PARTITION BY posted_in_subreddit ORDER BY timestamp, event_id) AS place FROM ev)
WHERE place <= 200""",
    "poll_newest": f"""
WITH {_LAKE}
SELECT posted_in_subreddit, timestamp, event_id FROM ev
QUALIFY row_number() OVER (PARTITION BY posted_in_subreddit ORDER BY timestamp DESC, event_id) <= 100""",
    "prompt_texts": f"WITH {_DOCS} SELECT doc_id, text FROM docs",
    "prompt_pack": f"""
WITH {_PACKED}
SELECT title, piece, chunk, count(*) AS items,
       string_agg('Item ' || position || ':' || chr(10) || text, chr(10) || chr(10) ORDER BY position) AS prompt
FROM chunked GROUP BY ALL""",
    "enrich_dummy": f"""
WITH {_PACKED}
SELECT doc_id, 'en' AS languages, 'Dummy translation for item ' || position AS translation,
       'testing' AS intent, 'testing|dummy-data|workflow-validation' AS topics,
       CAST(0.0 AS DOUBLE) AS sentiment_score, 'Dummy Entity|Test Location' AS entity_names,
       'Organization|Location' AS entity_types
FROM chunked""",
    "enrich_route": f"""
WITH {_DOCS}, replied AS (SELECT doc_id, {_reply('length(text)')} FROM docs)
SELECT *, CASE WHEN reason IS NULL THEN 'success' ELSE 'failed' END AS status FROM replied""",
    "enrich_odd_replies": f"""
WITH {_DOCS},
replied AS (
  SELECT doc_id, length(text) % 10 AS kind,
         CASE length(text) % 10 WHEN 0 THEN 'reply:missing' WHEN 1 THEN 'languages:type'
           WHEN 2 THEN 'topics:type' WHEN 3 THEN 'translation:type' WHEN 4 THEN 'intent:type'
           WHEN 6 THEN 'entities:type' WHEN 7 THEN 'reply:shape' WHEN 8 THEN 'reply:shape' END AS reason
  FROM docs)
SELECT doc_id, reason, CASE WHEN reason IS NULL THEN 'success' ELSE 'failed' END AS status,
       CASE WHEN kind = 0 THEN 3 ELSE 1 END AS attempts,
       CASE WHEN reason IS NULL THEN 'a|b' END AS topics
FROM replied""",
    "enrich_outcomes": f"""
WITH {_DOCS}, replied AS (SELECT title, {_reply('length(text)')} FROM docs)
SELECT title, CASE WHEN reason IS NULL THEN 'success' ELSE 'failed' END AS status, count(*) AS events
FROM replied GROUP BY ALL""",
    "insert_ignore_join": f"WITH {_REPOSTS} SELECT * FROM fresh",
    "insert_ignore_table": f"""
WITH {_REPOSTS}
SELECT * FROM raw UNION ALL BY NAME SELECT * FROM fresh""",
    "append_only_table": f"""
WITH {_RAW}
SELECT * FROM raw UNION ALL SELECT * FROM raw""",
    "retention": f"""
WITH {_LAKE}
SELECT event_id, timestamp FROM ev
WHERE timestamp >= (SELECT max(timestamp) - INTERVAL 10 DAY FROM ev)""",
    "event_rate": f"WITH {_RATES} SELECT * FROM rates",
    "event_rates_job": f"""
WITH {_ENRICHED},
times AS (
  SELECT 'raw_events' AS stream, timestamp FROM raw
  UNION ALL SELECT 'enriched_events', timestamp FROM enr WHERE has_enrichment),
minutes AS (
  SELECT stream, date_trunc('minute', timestamp) AS minute_start, count(*) AS events FROM times GROUP BY ALL)
SELECT *, avg(events) OVER (
  PARTITION BY stream ORDER BY minute_start
  RANGE BETWEEN INTERVAL 4 MINUTE PRECEDING AND CURRENT ROW) AS rolling_avg
FROM minutes""",
    "rate_gauge": f"""
WITH {_RATES}
SELECT stream, max(minute_start) AS minute_start, arg_max(events, minute_start) AS events
FROM rates GROUP BY ALL""",
    "rolling_avg_5m": f"""
WITH {_RATES}
SELECT stream, minute_start, avg(events) OVER (
  PARTITION BY stream ORDER BY minute_start
  RANGE BETWEEN INTERVAL 4 MINUTE PRECEDING AND CURRENT ROW) AS rolling_avg
FROM rates""",
}
