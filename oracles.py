"""The registered queries in DuckDB SQL, over the same test tables.

Written against the definitions of the layers, independently of the Spark code: CTEs from raw
records up to the marts, of which each query selects one.
"""

from __future__ import annotations

from trendmill.schemas import CATEGORY_NAMES, MOMENTUM_LABELS, REGIONS, SOURCE


def half_up(expression: str, digits: int) -> str:
    """Round the decimal rendering of a double half up, as Spark does."""
    exact = f"CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38, 15))"
    return f"CAST(round({exact}, {digits}) AS DOUBLE)"


BRONZE = rf"""
bronze AS (
  SELECT
    event_id, ts,
    CASE WHEN event_id % 211 = 0 THEN NULL ELSE 'v' || user_id END AS video_id,
    'c' || (user_id % 40) AS channel_id,
    'channel ' || (user_id % 40) AS channel_title,
    CASE event_type WHEN 'click' THEN 'US' WHEN 'view' THEN 'GB' WHEN 'purchase' THEN 'IN'
                    WHEN 'signup' THEN 'CA' ELSE '' END AS region,
    'title ' || user_id AS title,
    'description ' || event_id AS description,
    CASE WHEN event_id % 503 = 0 THEN 'n/a' ELSE CAST(user_id % 31 AS VARCHAR) END AS category_id,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 5 END AS n_tags,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE array_to_string(
      [ 'tag ' || ((event_id * 7 + i * 4) % 11) FOR i IN range(event_id % 5) ], '|') END AS tags,
    CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN 'P1DT2H'
         WHEN event_id % 19 = 0 THEN 'P0D'
         ELSE 'PT' || (event_id % 3) || 'H' || (event_id % 60) || 'M' END AS duration,
    'en' AS default_language,
    CASE WHEN event_id % 97 = 0 THEN 'bad'
         ELSE strftime(CAST(ts AS DATE) - CAST(user_id % 10 AS INTEGER), '%Y-%m-%d') || 'T00:00:00Z'
         END AS published_at,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ingested_at,
    CASE WHEN event_id % 101 = 0 THEN 0 ELSE CAST(round(value * 100) AS BIGINT) END AS view_count,
    CASE WHEN event_id % 89 = 0 THEN NULL
         ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS like_count,
    event_id % 50 AS comment_count,
    '{SOURCE}' AS source,
    '1.0' AS pipeline_version
  FROM events
)"""

DURATION = r"""
CASE WHEN regexp_matches(duration, '^P(\d+D)?T') THEN
    coalesce(try_cast(regexp_extract(duration, '^P(\d+)D', 1) AS BIGINT), 0) * 86400
  + coalesce(try_cast(regexp_extract(duration, 'T(\d+)H', 1) AS BIGINT), 0) * 3600
  + coalesce(try_cast(regexp_extract(duration, 'T(?:\d+H)?(\d+)M', 1) AS BIGINT), 0) * 60
  + coalesce(try_cast(regexp_extract(duration, 'T(?:\d+H)?(?:\d+M)?(\d+)S', 1) AS BIGINT), 0)
END"""


def silver(grain: str = "day") -> str:
    keys = "video_id, region" + (", CAST(ts AS DATE)" if grain == "day" else "")
    return rf"""
silver AS (
  SELECT
    video_id, channel_id, region, title, description, channel_title,
    try_cast(category_id AS BIGINT) AS category_id, tags, default_language,
    try_strptime(published_at, '%Y-%m-%dT%H:%M:%SZ') AS published_at, ts AS ingested_at,
    view_count, like_count, comment_count, source, {DURATION} AS duration_seconds,
    coalesce(n_tags, 0) AS tags_count,
    CASE WHEN view_count > 0 THEN CAST(like_count + comment_count AS DOUBLE) / view_count
         ELSE 0.0 END AS engagement_rate,
    CASE WHEN view_count > 0 THEN CAST(like_count AS DOUBLE) / view_count ELSE 0.0 END
      AS like_to_view_ratio,
    CAST(ts AS DATE) AS snapshot_date, pipeline_version AS _pipeline_version
  FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ts DESC) AS rn
    FROM bronze WHERE video_id IS NOT NULL AND region IS NOT NULL
  )
  WHERE rn = 1 AND region <> '' AND published_at <> 'bad'
)"""


GOLD = """
daily_trending_rank AS (
  SELECT *, row_number() OVER (
      PARTITION BY region, snapshot_date ORDER BY view_count DESC, video_id) AS trending_rank
  FROM silver
),
category_tops AS (
  SELECT category_id, region, snapshot_date, title, video_id
  FROM (SELECT *, row_number() OVER (
          PARTITION BY category_id, region, snapshot_date
          ORDER BY view_count DESC, video_id DESC) AS rn FROM silver)
  WHERE rn = 1
),
category_stats AS (
  SELECT
    s.category_id, s.region, s.snapshot_date, count(s.video_id) AS video_count,
    CAST(sum(view_count) AS BIGINT) AS total_views, CAST(sum(like_count) AS BIGINT) AS total_likes,
    CAST(sum(comment_count) AS BIGINT) AS total_comments,
    avg(view_count) AS avg_view_count, avg(like_count) AS avg_like_count,
    avg(comment_count) AS avg_comment_count, avg(engagement_rate) AS avg_engagement_rate,
    avg(duration_seconds) AS avg_duration_seconds, max(view_count) AS max_view_count,
    min(view_count) AS min_view_count, any_value(t.title) AS top_video_title,
    any_value(t.video_id) AS top_video_id
  FROM silver s JOIN category_tops t
    ON s.category_id IS NOT DISTINCT FROM t.category_id AND s.region = t.region
   AND s.snapshot_date = t.snapshot_date
  GROUP BY s.category_id, s.region, s.snapshot_date
),
channel_stats AS (
  SELECT
    channel_id, channel_title, region, snapshot_date, count(video_id) AS trending_video_count,
    CAST(sum(view_count) AS BIGINT) AS total_views, CAST(sum(like_count) AS BIGINT) AS total_likes,
    CAST(sum(comment_count) AS BIGINT) AS total_comments, avg(view_count) AS avg_view_count,
    avg(engagement_rate) AS avg_engagement_rate, max(view_count) AS max_video_views,
    string_agg(title, '|' ORDER BY title) AS trending_video_titles
  FROM silver GROUP BY channel_id, channel_title, region, snapshot_date
),
view_velocity AS (
  SELECT *, view_count - prev_views AS view_count_delta,
    CASE WHEN prev_views > 0 THEN CAST(view_count - prev_views AS DOUBLE) / prev_views * 100 END
      AS velocity_pct,
    date_diff('day', prev_date, snapshot_date) AS days_since_prev_snapshot
  FROM (SELECT *,
          lag(view_count) OVER w AS prev_views, lag(snapshot_date) OVER w AS prev_date
        FROM silver WINDOW w AS (PARTITION BY video_id, region ORDER BY snapshot_date))
)"""

_NAMED = " ".join(f"WHEN {number} THEN '{name}'" for number, name in CATEGORY_NAMES.items())
CATEGORY_NAME = f"CASE category_id {_NAMED} ELSE 'Unknown (' || CAST(category_id AS VARCHAR) || ')' END AS category_name"

STAGING = f"""
stg_daily_trending_rank AS (
  SELECT video_id, title, channel_id, channel_title, category_id, {CATEGORY_NAME}, region,
    snapshot_date, trending_rank, coalesce(view_count, 0) AS view_count,
    coalesce(like_count, 0) AS like_count, coalesce(comment_count, 0) AS comment_count,
    coalesce(engagement_rate, 0.0) AS engagement_rate,
    coalesce(like_to_view_ratio, 0.0) AS like_to_view_ratio, duration_seconds, tags_count,
    CAST(published_at AS DATE) AS published_date
  FROM daily_trending_rank
),
stg_category_stats AS (
  SELECT category_id, {CATEGORY_NAME}, region, snapshot_date, video_count,
    coalesce(total_views, 0) AS total_views, coalesce(total_likes, 0) AS total_likes,
    coalesce(total_comments, 0) AS total_comments, coalesce(avg_view_count, 0.0) AS avg_view_count,
    coalesce(avg_like_count, 0.0) AS avg_like_count,
    coalesce(avg_comment_count, 0.0) AS avg_comment_count,
    coalesce(avg_engagement_rate, 0.0) AS avg_engagement_rate,
    coalesce(avg_duration_seconds, 0.0) AS avg_duration_seconds,
    coalesce(max_view_count, 0) AS max_view_count, coalesce(min_view_count, 0) AS min_view_count,
    top_video_title, top_video_id
  FROM category_stats
),
stg_channel_stats AS (
  SELECT channel_id, channel_title, region, snapshot_date, trending_video_count,
    coalesce(total_views, 0) AS total_views, coalesce(total_likes, 0) AS total_likes,
    coalesce(total_comments, 0) AS total_comments, coalesce(avg_view_count, 0.0) AS avg_view_count,
    coalesce(avg_engagement_rate, 0.0) AS avg_engagement_rate,
    coalesce(max_video_views, 0) AS max_video_views, trending_video_titles
  FROM channel_stats
),
stg_view_velocity AS (
  SELECT video_id, title, channel_id, channel_title, category_id, region, snapshot_date,
    coalesce(view_count, 0) AS view_count, coalesce(like_count, 0) AS like_count,
    coalesce(comment_count, 0) AS comment_count,
    coalesce(engagement_rate, 0.0) AS engagement_rate, view_count_delta, velocity_pct,
    days_since_prev_snapshot,
    CASE WHEN velocity_pct IS NULL THEN NULL WHEN velocity_pct > 20 THEN 'accelerating'
         WHEN velocity_pct > 0 THEN 'growing' WHEN velocity_pct = 0 THEN 'flat'
         ELSE 'declining' END AS momentum_label
  FROM view_velocity
)"""

MARTS = f"""
fct_trending_leaderboard AS (
  SELECT *, date_diff('day', published_date, snapshot_date) AS days_to_trend,
    ntile(5) OVER (PARTITION BY region, snapshot_date
                   ORDER BY engagement_rate DESC, trending_rank) AS engagement_quintile
  FROM stg_daily_trending_rank WHERE trending_rank <= 10
),
fct_top_channels AS (
  SELECT channel_id, channel_title, region, snapshot_date,
    rank() OVER (PARTITION BY region, snapshot_date ORDER BY total_views DESC) AS channel_rank,
    trending_video_count, total_views, total_likes, total_comments,
    {half_up("avg_view_count", 0)} AS avg_view_count,
    {half_up("avg_engagement_rate * 100", 4)} AS avg_engagement_rate_pct, max_video_views,
    {half_up('''total_views::DOUBLE / nullif(CAST(sum(total_views)
       OVER (PARTITION BY region, snapshot_date) AS DOUBLE), 0) * 100''', 2)} AS view_share_pct
  FROM stg_channel_stats
),
category_totals AS (
  SELECT category_id, snapshot_date, CAST(sum(video_count) AS BIGINT) AS global_video_count,
    CAST(sum(total_views) AS BIGINT) AS global_total_views,
    avg(avg_engagement_rate) AS global_avg_engagement
  FROM stg_category_stats GROUP BY category_id, snapshot_date
),
fct_category_performance AS (
  SELECT category_id, category_name, region, snapshot_date,
    rank() OVER (PARTITION BY region, snapshot_date ORDER BY total_views DESC)
      AS category_rank_in_region,
    video_count, total_views, total_likes, total_comments,
    {half_up("avg_view_count", 0)} AS avg_view_count,
    {half_up("avg_engagement_rate * 100", 4)} AS avg_engagement_rate_pct,
    {half_up("avg_duration_seconds / 60.0", 1)} AS avg_duration_minutes, max_view_count,
    top_video_title, top_video_id, global_video_count, global_total_views,
    {half_up("global_avg_engagement * 100", 4)} AS global_avg_engagement_pct,
    {half_up("total_views::DOUBLE / nullif(global_total_views, 0) * 100", 2)}
      AS region_view_share_pct
  FROM stg_category_stats JOIN category_totals USING (category_id, snapshot_date)
),
fct_momentum_videos AS (
  SELECT video_id, title, channel_id, channel_title, category_id, region, snapshot_date,
    velocity_rank, view_count, view_count_delta, {half_up("velocity_pct", 2)} AS velocity_pct,
    days_since_prev_snapshot, momentum_label, like_count, comment_count,
    {half_up("engagement_rate * 100", 4)} AS engagement_rate_pct
  FROM (SELECT *, rank() OVER (PARTITION BY region, snapshot_date ORDER BY velocity_pct DESC)
          AS velocity_rank
        FROM stg_view_velocity WHERE velocity_pct IS NOT NULL)
  WHERE velocity_rank <= 20
)"""


def layers(select: str, grain: str = "day") -> str:
    return "WITH " + ",".join([BRONZE, silver(grain), GOLD, STAGING, MARTS]) + "\n" + select


def raw(select: str) -> str:
    return "WITH " + BRONZE + "\n" + select


SILVER_COLUMNS = """
  video_id, channel_id, region, title, description, channel_title, category_id, tags, default_language,
  CAST(published_at AS VARCHAR) AS published_at, CAST(ingested_at AS VARCHAR) AS ingested_at,
  view_count, like_count, comment_count, source, duration_seconds, tags_count, engagement_rate,
  like_to_view_ratio, year(published_at) AS published_year, month(published_at) AS published_month,
  CAST(CAST(published_at AS DATE) AS VARCHAR) AS published_date, _pipeline_version"""

KEYS = """
  video_id, region, CAST(snapshot_date AS VARCHAR) AS snapshot_date,
  CAST(ingested_at AS VARCHAR) AS ingested_at, view_count"""

TRENDING = """
  video_id, title, channel_id, channel_title, category_id, region,
  CAST(snapshot_date AS VARCHAR) AS snapshot_date, view_count, like_count, comment_count,
  engagement_rate, like_to_view_ratio, duration_seconds, tags_count,"""

DAY = "CAST(snapshot_date AS VARCHAR) AS snapshot_date"


def rounded(table: str, *columns: str) -> str:
    """All columns of a table, with the date as text and averages of doubles rounded."""
    replaced = ", ".join([DAY, *[f"round({c}, 9) AS {c}" for c in columns]])
    return f"SELECT * REPLACE ({replaced}) FROM {table}"


VELOCITY = f"""
SELECT video_id, title, channel_id, channel_title, category_id, region, {DAY}, view_count,
  like_count, comment_count, engagement_rate, view_count_delta, velocity_pct,
  days_since_prev_snapshot FROM view_velocity"""

LEADERBOARD = f"""
SELECT {TRENDING} category_name, trending_rank, CAST(published_date AS VARCHAR) AS published_date,
  days_to_trend, engagement_quintile FROM fct_trending_leaderboard"""

RANKED = f"""
SELECT {TRENDING} CAST(CAST(published_at AS DATE) AS VARCHAR) AS published_date, trending_rank
FROM daily_trending_rank"""

FLATTENED = """
SELECT 'e' || event_id AS video_id, channel_id, region, title,
  CASE WHEN event_id % 11 = 0 THEN '' ELSE substring(repeat(description, 40), 1, 500) END
    AS description,
  channel_title, category_id, coalesce(n_tags, 0) AS tags_count, coalesce(tags, '') AS tags, duration, default_language,
  published_at, max(ingested_at) OVER (PARTITION BY region, event_id // 50) AS ingested_at,
  view_count,
  CASE WHEN event_id % 71 = 0 THEN 0 ELSE coalesce(like_count, 0) END AS like_count,
  CASE WHEN event_id % 73 = 0 THEN 0 ELSE comment_count END AS comment_count,
  source, pipeline_version
FROM bronze WHERE (event_id // 50) % 37 <> 0"""

INGEST = """
SELECT region, records, unreadable_payloads, malformed_items,
  CASE WHEN unreadable_payloads > 0 OR malformed_items > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status
FROM (
  SELECT region, count(*) FILTER ((event_id // 50) % 37 <> 0) AS records,
    count(DISTINCT event_id // 50) FILTER ((event_id // 50) % 37 = 0) AS unreadable_payloads,
    count(*) FILTER ((event_id // 50) % 37 <> 0 AND event_id % 73 = 0) AS malformed_items
  FROM bronze GROUP BY region)"""


def _seen(name: str, region: str = "") -> str:
    where = f" WHERE region <> '{region}'" if region else ""
    return f"SELECT '{name}' AS seen, category_id, region, {DAY}, video_count, total_views, top_video_id FROM category_stats{where}"


TIED = """
SELECT video_id, region, CAST(CAST(ts AS DATE) AS VARCHAR) AS snapshot_date, title, description, view_count, like_count, comment_count
FROM (SELECT *, row_number() OVER (PARTITION BY video_id, region, CAST(ts AS DATE) ORDER BY channel_id DESC NULLS LAST,
        title DESC NULLS LAST, description DESC NULLS LAST) AS rn
      FROM (SELECT * REPLACE (CASE WHEN like_count IS NOT NULL THEN comment_count END AS comment_count) FROM bronze)
      WHERE video_id IS NOT NULL AND region IS NOT NULL)
WHERE rn = 1"""


def _conditions() -> list[tuple[str, str]]:
    return [(name, unexpected) for name, _, _, unexpected, _ in _rows() if unexpected not in ("n_key > 1", "false")]


def _rows() -> list[tuple]:
    """The 15 expectations as (name, critical, missing, unexpected, mostly)."""
    rows = []
    for column in ["video_id", "region", "ingested_at", "view_count", "channel_id"]:
        rows.append((f"{column}_not_null", True, "0", f"{column} IS NULL", 1.0))
    rows.append(("region_in_expected_set", True, "region IS NULL", f"region NOT IN {tuple(REGIONS)}", 1.0))
    for column in ["view_count", "like_count", "comment_count"]:
        rows.append((f"{column}_non_negative", True, f"{column} IS NULL", f"{column} < 0", 1.0))
    rows.append((f"source_is_{SOURCE}", True, "source IS NULL", f"source <> '{SOURCE}'", 1.0))
    for column, pattern in [
        ("published_at", r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"),
        ("ingested_at", r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"),
        ("duration", r"^PT(\d+H)?(\d+M)?(\d+S)?$"),
    ]:
        bad = f"NOT regexp_matches({column}, '{pattern}')"
        rows.append((f"{column}_iso8601_format", True, f"{column} IS NULL", bad, 0.95))
    rows.append(("video_region_key_mostly_unique", False, "0", "n_key > 1", 0.95))
    rows.append(("dataset_not_empty", True, "0", "false", 1.0))
    return rows


def _checks() -> str:
    parts = [
        f"SELECT '{name}' AS expectation, {critical} AS critical, count(*) AS element_count, "
        f"count(*) FILTER ({'false' if missing == '0' else missing}) AS missing_count, "
        f"count(*) FILTER ({bad}) AS unexpected_count, {mostly} AS mostly FROM keyed"
        for name, critical, missing, bad, mostly in _rows()
    ]
    return (
        "WITH " + BRONZE + """, keyed AS (
  SELECT *, count(*) OVER (PARTITION BY concat_ws('::', video_id, region)) AS n_key FROM bronze
), counted AS (""" + "\nUNION ALL ".join(parts) + """), results AS (
  SELECT expectation, critical,
    CASE WHEN expectation = 'dataset_not_empty' THEN element_count >= 1
         WHEN element_count = missing_count THEN true
         ELSE (element_count - missing_count - unexpected_count)::DOUBLE
              / (element_count - missing_count) >= mostly END AS success,
    element_count, missing_count, unexpected_count
  FROM counted)
"""
    )


TESTED = {
    "daily_trending_rank": ["video_id", "trending_rank", "region", "snapshot_date"],
    "category_stats": ["category_id", "region", "snapshot_date"],
    "channel_stats": ["channel_id", "region", "snapshot_date"],
    "view_velocity": ["video_id", "region", "snapshot_date"],
    "fct_trending_leaderboard": ["video_id", "region", "snapshot_date", "trending_rank", "engagement_quintile"],
    "fct_top_channels": ["channel_id", "region", "snapshot_date", "channel_rank"],
    "fct_category_performance": ["category_id", "region", "snapshot_date"],
    "fct_momentum_videos": ["video_id", "region", "snapshot_date", "velocity_rank", "momentum_label"],
}
TESTED |= {f"stg_{name}": columns for name, columns in TESTED.items() if not name.startswith("fct")}


def _verdicts(counts: list[str]) -> str:
    return (
        "SELECT *, failures <> 0 AS should_warn, failures <> 0 AS should_error FROM ("
        + "\nUNION ALL ".join(counts)
        + ")"
    )


def _not_null() -> str:
    return _verdicts(
        [
            f"SELECT '{table}' AS table_name, 'not_null' AS test, '{column}' AS column_name, "
            f"count(*) FILTER ({column} IS NULL) AS failures FROM {table}"
            for table, columns in TESTED.items()
            for column in columns
        ]
    )


ACCEPTED_VALUES = [
    ("stg_daily_trending_rank", "region", tuple(REGIONS)),
    ("stg_view_velocity", "momentum_label", tuple(MOMENTUM_LABELS)),
    ("fct_trending_leaderboard", "engagement_quintile", (1, 2, 3, 4, 5)),
    ("fct_momentum_videos", "momentum_label", tuple(MOMENTUM_LABELS)),
]


def _accepted() -> str:
    return _verdicts(
        [
            f"SELECT '{table}' AS table_name, 'accepted_values' AS test, '{column}' AS column_name, "
            f"count(DISTINCT {column}) FILTER ({column} NOT IN {values}) AS failures FROM {table}"
            for table, column, values in ACCEPTED_VALUES
        ]
    )


def _row_counts() -> str:
    marts = ["fct_trending_leaderboard", "fct_top_channels", "fct_category_performance", "fct_momentum_videos"]
    return "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in marts)


def sql() -> dict[str, str]:
    top_channels = layers(f"SELECT * REPLACE ({DAY}) FROM fct_top_channels")
    momentum = layers(f"SELECT * REPLACE ({DAY}) FROM fct_momentum_videos")
    category = layers(f"SELECT * REPLACE ({DAY}) FROM fct_category_performance")
    latest_silver = layers(f"SELECT {SILVER_COLUMNS} FROM silver", "latest")
    daily_silver = layers(f"SELECT {SILVER_COLUMNS} FROM silver")
    return {
        "silver_videos": daily_silver,
        "silver_latest_only": latest_silver,
        "latest_per_day": layers(f"SELECT {KEYS} FROM silver"),
        "latest_per_video_region": layers(f"SELECT {KEYS} FROM silver", "latest"),
        "duration_seconds": raw(f"SELECT duration, {DURATION} AS duration_seconds FROM bronze"),
        "json_flatten": raw(FLATTENED),
        "json_flatten_variant": raw(FLATTENED),
        "ingest_summary": raw(INGEST),
        "region_counts": raw("SELECT region, count(*) AS records FROM bronze GROUP BY region"),
        "daily_trending_rank": layers(RANKED),
        "daily_trending_rank_in_cells": layers(RANKED),
        "category_stats": layers(rounded("category_stats", "avg_engagement_rate")),
        "channel_stats": layers(rounded("channel_stats", "avg_engagement_rate")),
        "channel_titles": layers(f"SELECT channel_id, channel_title, region, {DAY}, title FROM silver"),
        "view_velocity": layers(VELOCITY),
        "stg_daily_trending_rank": layers(
            f"SELECT * REPLACE ({DAY}, CAST(published_date AS VARCHAR) AS published_date) "
            "FROM stg_daily_trending_rank"
        ),
        "stg_category_stats": layers(rounded("stg_category_stats", "avg_engagement_rate")),
        "stg_channel_stats": layers(rounded("stg_channel_stats", "avg_engagement_rate")),
        "stg_view_velocity": layers(f"SELECT * REPLACE ({DAY}) FROM stg_view_velocity"),
        "fct_trending_leaderboard": layers(LEADERBOARD),
        "fct_top_channels": top_channels,
        "fct_top_channels_in_cells": top_channels,
        "fct_category_performance": category,
        "fct_category_performance_by_join": category,
        "fct_momentum_videos": momentum,
        "fct_momentum_videos_by_join": momentum,
        "partition_values": layers(
            "SELECT DISTINCT region, year(published_at) AS published_year, "
            "month(published_at) AS published_month FROM silver"
        ),
        "loss_accounting": raw(
            "SELECT count(*) AS raw_rows, count(*) FILTER (video_id IS NOT NULL AND region IS NOT NULL) "
            "AS kept_rows, count(*) FILTER (video_id IS NULL OR region IS NULL) AS dropped_rows FROM bronze"
        ),
        "dq_expectations": _checks() + "SELECT * FROM results",
        "dq_summary": _checks()
        + "SELECT count(*) AS total_expectations, count(*) FILTER (success) AS passed, "
        "count(*) FILTER (NOT success AND critical) AS critical_failures, "
        "count(*) FILTER (NOT success AND NOT critical) AS warning_failures, "
        "count(*) FILTER (NOT success AND critical) = 0 AS overall_success FROM results",
        "dq_duplicates": raw(
            "SELECT concat_ws('::', video_id, region) AS key, count(*) AS rows FROM bronze "
            "GROUP BY 1 HAVING count(*) > 1"
        ),
        "dq_violations": raw(
            " UNION ALL ".join(
                f"SELECT '{name}' AS expectation, video_id, region, ingested_at "
                f"FROM bronze WHERE {bad}"
                for name, bad in _conditions()
            )
        ),
        "dq_report": _checks() + """, totals AS (
  SELECT count(*) AS total_expectations, count(*) FILTER (success) AS passed,
    count(*) FILTER (NOT success AND critical) AS critical_failures,
    count(*) FILTER (NOT success AND NOT critical) AS warning_failures,
    count(*) FILTER (NOT success AND critical) = 0 AS overall_success FROM results)
SELECT 'events' AS bronze_path, totals.*, CAST(list_position(""" + str([row[0] for row in _rows()]) + """, expectation) - 1 AS BIGINT)
  AS position, expectation, unexpected_count FROM results, totals""",
        "latest_with_ties": raw(TIED),
        "gold_after_late_day": layers(VELOCITY),
        "ranks_after_late_day": layers(RANKED),
        "feed_gold_changes": layers(VELOCITY),
        "quarantine_counts": raw(
            "SELECT event_id % 8 AS part, count(*) AS lines, count(*) FILTER (NOT unread AND NOT wrong AND NOT keyless) AS sound, "
            "count(*) FILTER (unread) AS not_json, count(*) FILTER (wrong AND NOT unread) AS wrong_type, "
            "count(*) FILTER (keyless AND NOT unread AND NOT wrong) AS no_key FROM (SELECT event_id, event_id % 37 = 0 AS unread, "
            "event_id % 41 = 0 AS wrong, video_id IS NULL AS keyless FROM bronze) GROUP BY 1"
        ),
        "quarantine_replay": daily_silver,
        "velocity_in_buckets": layers(VELOCITY),
        "dq_gate": _checks() + """SELECT CASE WHEN count(*) FILTER (NOT success AND critical) = 0 THEN '' ELSE
  count(*) FILTER (NOT success AND critical) || ' critical expectation(s) not met: ' ||
  string_agg(expectation, ', ' ORDER BY place) FILTER (NOT success AND critical) END AS stop,
  coalesce(string_agg(expectation, ', ' ORDER BY place) FILTER (NOT success AND NOT critical), '') AS warnings
FROM (SELECT *, list_position(""" + str([row[0] for row in _rows()]) + """, expectation) AS place FROM results)""",
        "dq_day_by_day": _checks() + "SELECT * FROM results",
        "feed_arrivals": raw(
            "SELECT region, hour, records, coalesce(hour_start + INTERVAL 3 HOUR <= max(last_seen) OVER (), false) AS closed FROM ("
            "SELECT region, strftime(ts, '%Y-%m-%d %H') AS hour, date_trunc('hour', ts) AS hour_start, count(*) AS records, "
            "max(ts) AS last_seen FROM bronze GROUP BY ALL)"
        ),
        "sql_functions": raw(
            f"SELECT video_id, region, ingested_at, {DURATION} AS duration_seconds, try_cast(category_id AS BIGINT) AS category_id, "
            "coalesce(n_tags, 0) AS tags_count, CASE WHEN view_count > 0 THEN CAST(like_count + comment_count AS DOUBLE) / view_count "
            "ELSE 0.0 END AS engagement_rate, CASE WHEN view_count > 0 THEN CAST(like_count AS DOUBLE) / view_count ELSE 0.0 END "
            "AS like_to_view_ratio, published_at = 'bad' AS bad_time FROM bronze"
        ),
        "incremental_marts": momentum,
        "catalog_roundtrip": layers(rounded("category_stats", "avg_engagement_rate")),
        "catalog_evolution": layers(rounded("category_stats", "avg_engagement_rate")),
        "table_versions": layers(f"{_seen('one', 'US')} UNION ALL {_seen('two')} UNION ALL {_seen('catalog', 'US')}"),
        "crash_between_versions": layers(f"{_seen('one', 'US')} UNION ALL {_seen('two')} UNION ALL {_seen('catalog')}"),
        "observed_counts": layers(
            " UNION ALL ".join(
                f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) AS written_rows FROM {source}"
                for t, source in {
                    "daily_trending_rank": "daily_trending_rank", "category_stats": "category_stats",
                    "channel_stats": "channel_stats", "channel_titles": "silver", "view_velocity": "view_velocity",
                }.items()
            )
        ),
        "report_order": layers(
            f"SELECT row_number() OVER (ORDER BY region, snapshot_date, trending_rank) AS position, region, {DAY}, "
            "trending_rank, video_id FROM fct_trending_leaderboard"
        ),
        "ingest_total": raw(
            "SELECT CAST(sum(records) AS BIGINT) AS total_records, coalesce(string_agg(region, ',' ORDER BY region) "
            "FILTER (status <> 'SUCCESS'), '') AS failed_regions, CASE WHEN count(*) FILTER (status <> 'SUCCESS') = 0 "
            f"THEN 'SUCCESS' ELSE 'PARTIAL' END AS status FROM ({INGEST})"
        ),
        "dq_not_null": layers(_not_null()),
        "dq_accepted_values": layers(_accepted()),
        "dq_observed": layers(f"{_not_null()} UNION ALL {_accepted()}"),
        "dq_value_histogram": layers(
            " UNION ALL ".join(
                f"SELECT '{table}' AS table_name, '{column}' AS column_name, CAST({column} AS VARCHAR) AS value_field, "
                f"count(*) AS n_records FROM {table} GROUP BY {column}"
                for table, column, _ in ACCEPTED_VALUES
            )
        ),
        "dq_row_counts": layers(_row_counts()),
        "partitioned_roundtrip": daily_silver,
        "json_lines_roundtrip": raw("SELECT * EXCLUDE (event_id, ts, n_tags), "
                                    "coalesce(n_tags, -1) AS tags_count FROM bronze"),
        "incremental_silver": daily_silver,
        "incremental_latest_only": latest_silver,
    }
