"""The checks' expected results, as SQL over the ``events`` table.

Written for DuckDB and independent of the Spark code: deduplication is a ranked window
here, buckets are spelled out, and CSV lines are taken apart by splitting.
"""

from __future__ import annotations

_RAW = r"""
base AS (
  SELECT
    event_id,
    CASE event_id % 80 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE CAST(user_id AS VARCHAR) END AS user_id,
    CASE WHEN event_id % 80 = 10 THEN NULL ELSE 'sess_' || CAST(event_id AS VARCHAR) END AS session_id,
    CASE WHEN event_id % 80 = 20 THEN 'unknown_action' ELSE event_type END AS action,
    CASE WHEN event_id % 80 = 30 THEN '2024-13-45 25:61:61'
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS "timestamp",
    CASE WHEN event_id % 80 = 40 THEN NULL
         ELSE 'region_' || CAST(user_id % 8 AS VARCHAR) END AS region,
    CASE WHEN event_id % 80 = 50 THEN 'smart_watch'
         WHEN event_id % 80 = 51 THEN NULL
         WHEN event_id % 3 = 0 THEN 'mobile'
         WHEN event_id % 3 = 1 THEN 'desktop'
         ELSE 'tablet' END AS device,
    CASE event_id % 80 WHEN 60 THEN -17 WHEN 61 THEN NULL
         ELSE CAST(1 + (event_id * 37) % 600 AS INTEGER) END AS duration_sec,
    'prod_' || CAST(1000 + event_id % 9000 AS VARCHAR) AS product_id,
    CASE event_id % 80 WHEN 70 THEN CAST(-10.5 AS DOUBLE) WHEN 71 THEN NULL
         ELSE value * 2 END AS price
  FROM events
),
delivered AS (
  SELECT event_id, user_id, session_id, action, "timestamp", region, device,
         CASE WHEN spoilt THEN -1 ELSE duration_sec END AS duration_sec, product_id, price
  FROM (
    SELECT *, unnest(CASE event_id % 50 WHEN 7 THEN [false, false]
                                        WHEN 9 THEN [false, true]
                                        ELSE [false] END) AS spoilt
    FROM base
  )
),
raw AS (SELECT * EXCLUDE (event_id) FROM delivered)"""

_DEDUPED = r""",
deduped AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY user_id, session_id, "timestamp"
      ORDER BY action NULLS FIRST, region NULLS FIRST, device NULLS FIRST,
               duration_sec NULLS FIRST, product_id NULLS FIRST, price NULLS FIRST
    ) AS place
    FROM raw
  ) WHERE place = 1
)"""

_STRICT_TIME = r"""CASE WHEN regexp_full_match("timestamp", '\d{4}-\d\d-\d\d \d\d:\d\d:\d\d')
       THEN try_strptime("timestamp", '%Y-%m-%d %H:%M:%S') END"""

_FILLED_COLUMNS = """coalesce(user_id, 'unknown_user') AS user_id, session_id, action, "timestamp",
         coalesce(region, 'Неизвестно') AS region, coalesce(device, 'unknown') AS device,
         duration_sec, product_id, price"""

_SESSION_CATEGORY = """CASE WHEN duration_sec < 60 THEN 'short'
            WHEN duration_sec BETWEEN 60 AND 300 THEN 'medium' ELSE 'long' END"""

_PRICE_CATEGORY = """CASE WHEN price < 100 THEN 'low'
            WHEN price BETWEEN 100 AND 500 THEN 'medium' ELSE 'high' END"""

_TIME_FEATURES = """CAST(event_timestamp AS DATE) AS event_date,
         CAST(hour(event_timestamp) AS INTEGER) AS event_hour,
         CAST(dayofweek(event_timestamp) + 1 AS INTEGER) AS event_dayofweek"""

_VALID = "user_id <> '' AND duration_sec > 0 AND price >= 0 AND event_timestamp IS NOT NULL"


def _enriched(source: str) -> str:
    return f"""SELECT *, {_TIME_FEATURES},
         {_SESSION_CATEGORY} AS session_category,
         {_PRICE_CATEGORY} AS price_category
  FROM (SELECT *, {_STRICT_TIME} AS event_timestamp FROM {source})"""


_CLEANED = f""",
filled AS (SELECT {_FILLED_COLUMNS} FROM deduped),
enriched AS ({_enriched("filled")}),
cleaned AS (SELECT * FROM enriched WHERE {_VALID})"""

_LINES = r""",
lines AS (
  SELECT CASE event_id % 40
           WHEN 3 THEN line || ',EXTRA'
           WHEN 4 THEN array_to_string(string_split(line, ',')[1:5], ',')
           WHEN 5 THEN regexp_replace(line, '^(([^,]*,){6})[^,]*', '\1abc')
           ELSE line END AS value
  FROM (
    SELECT event_id,
           coalesce(user_id, '') || ',' || coalesce(session_id, '') || ',' ||
           coalesce(action, '') || ',' || "timestamp" || ',' || coalesce(region, '') || ',' ||
           coalesce(device, '') || ',' || coalesce(CAST(duration_sec AS VARCHAR), '') || ',' ||
           product_id || ',' || coalesce(CAST(price AS VARCHAR), '') AS line
    FROM delivered
  )
),
cells AS (
  SELECT value, c,
         len(c) = 9
         AND (c[7] = '' OR try_cast(c[7] AS INTEGER) IS NOT NULL)
         AND (c[9] = '' OR try_cast(c[9] AS DOUBLE) IS NOT NULL) AS fits
  FROM (SELECT value, string_split(value, ',') AS c FROM lines)
)"""

_VALID_LINES = """
SELECT nullif(c[1], '') AS user_id, nullif(c[2], '') AS session_id,
       nullif(c[3], '') AS action, nullif(c[4], '') AS "timestamp", nullif(c[5], '') AS region,
       nullif(c[6], '') AS device, CAST(nullif(c[7], '') AS INTEGER) AS duration_sec,
       nullif(c[8], '') AS product_id, CAST(nullif(c[9], '') AS DOUBLE) AS price
FROM cells WHERE fits"""

_EXACT = "TRY_CAST(price AS DECIMAL(28,10))"
_TOTAL = f"CAST(sum({_EXACT}) AS DOUBLE)"
_UNSUMMED = f"CAST(count(*) FILTER (WHERE price IS NOT NULL AND {_EXACT} IS NULL) AS BIGINT)"
_COUNT = "CAST(count(*) AS BIGINT)"

_ACTIVITY = f"""
SELECT region, event_date, event_hour, {_COUNT} AS total_events,
       count(DISTINCT user_id) AS unique_users, avg(duration_sec) AS avg_duration,
       {_TOTAL} AS total_revenue, {_TOTAL} / count({_EXACT}) AS avg_price
FROM cleaned GROUP BY region, event_date, event_hour"""

_DEVICES = f"""
SELECT device, session_category, {_COUNT} AS session_count, avg(duration_sec) AS avg_duration,
       count(DISTINCT user_id) AS unique_users
FROM cleaned GROUP BY device, session_category"""

_USERS = f"""
SELECT user_id, region, {_COUNT} AS total_sessions,
       CAST(sum(duration_sec) AS BIGINT) AS total_time, {_TOTAL} AS total_spent,
       min(event_date) AS first_date, max(event_date) AS last_date,
       {_UNSUMMED} AS unsummed_prices
FROM cleaned GROUP BY user_id, region"""

_TOP = f"""
SELECT user_id, region, total_sessions, total_time, total_spent,
       CAST(row_number() OVER (ORDER BY total_sessions DESC, user_id, region) AS BIGINT) AS rank
FROM ({_USERS}) QUALIFY rank <= 100"""

_DAILY = f"""
SELECT event_date, {_COUNT} AS daily_events, count(DISTINCT user_id) AS daily_users,
       {_TOTAL} AS daily_revenue
FROM cleaned GROUP BY event_date"""

_REGIONS = f"""
SELECT region, {_COUNT} AS total_events FROM cleaned GROUP BY region"""

_NO_INPUT = """CAST(NULL AS BIGINT) AS raw_rows, CAST(NULL AS BIGINT) AS valid_rows,
       CAST(NULL AS BIGINT) AS corrupt_rows"""
_ALL_VALID = f"""(SELECT {_COUNT} FROM raw) AS raw_rows, (SELECT {_COUNT} FROM raw) AS valid_rows,
       CAST(0 AS BIGINT) AS corrupt_rows"""
_SOME_VALID = f"""(SELECT {_COUNT} FROM cells) AS raw_rows,
       (SELECT {_COUNT} FROM cells WHERE fits) AS valid_rows,
       (SELECT {_COUNT} FROM cells WHERE NOT fits) AS corrupt_rows"""


def _summary(input_counts: str) -> str:
    return f"""
SELECT {input_counts}, {_COUNT} AS cleaned_rows, CAST(15 AS INTEGER) AS column_count,
       min(event_date) AS min_date, max(event_date) AS max_date,
       count(DISTINCT user_id) AS distinct_users, count(DISTINCT region) AS distinct_regions,
       {_UNSUMMED} AS unsummed_prices
FROM cleaned"""


_PROFILE = f"""
SELECT {_COUNT} AS total_rows, count(DISTINCT user_id) AS unique_users,
       count(DISTINCT region) AS unique_regions,
       min("timestamp") AS min_timestamp, max("timestamp") AS max_timestamp,
       CAST(count(*) FILTER (WHERE coalesce(user_id, '') = '') AS BIGINT) AS blank_user_ids,
       CAST(count(*) FILTER (WHERE duration_sec < 0) AS BIGINT) AS negative_durations,
       CAST(count(*) FILTER (WHERE isnan(price)) AS BIGINT) AS nan_prices,
       {_UNSUMMED} AS unsummed_prices
FROM raw"""

_SAMPLE_ORDER = """event_timestamp, user_id, session_id, action, "timestamp", region, device,
         duration_sec, product_id, price"""

#: What reading a CSV cell back gives: empty text is a missing value.
_FROM_CSV = r""",
reread AS (SELECT * REPLACE (nullif(user_id, '') AS user_id) FROM raw)"""

_LINES_CLEANED = (
    f",\nreread AS ({_VALID_LINES})" + _DEDUPED.replace("FROM raw", "FROM reread") + _CLEANED
)

_CORRUPT = 'SELECT value AS "_corrupt_record" FROM cells WHERE NOT fits'

#: Dataset, its rows, its key columns, and its two counts and two amounts.
_DATASETS = [
    (
        "clickstream_cleaned",
        "SELECT * FROM cleaned",
        ["user_id", "session_id", '"timestamp"', "action", "device"],
        ["duration_sec", "event_hour", "price", "NULL"],
    ),
    (
        "activity_by_region_hour",
        _ACTIVITY,
        ["region", "event_date", "event_hour"],
        ["total_events", "unique_users", "total_revenue", "avg_price"],
    ),
    (
        "device_statistics",
        _DEVICES,
        ["device", "session_category"],
        ["session_count", "unique_users", "avg_duration", "NULL"],
    ),
    (
        "top_users",
        _TOP,
        ["rank", "user_id", "region"],
        ["total_sessions", "total_time", "total_spent", "NULL"],
    ),
    (
        "daily_activity",
        _DAILY,
        ["event_date"],
        ["daily_events", "daily_users", "daily_revenue", "NULL"],
    ),
    (
        "user_activity",
        _USERS,
        ["user_id", "region", "first_date", "last_date"],
        ["total_sessions", "total_time", "total_spent", "unsummed_prices"],
    ),
]
_REPORTS = ("activity_by_region_hour", "device_statistics", "top_users", "daily_activity")


def _written(input_counts: str, corrupt: bool) -> str:
    summary = (
        "run_summary",
        _summary(input_counts),
        ["min_date", "max_date", "raw_rows", "valid_rows", "corrupt_rows"],
        ["cleaned_rows", "distinct_users", "distinct_regions", "unsummed_prices"],
    )
    aside = ("corrupt_records", _CORRUPT, ['"_corrupt_record"'], ["NULL"] * 4)
    parts = []
    for name, body, keys, values in [*_DATASETS, summary, *([aside] if corrupt else [])]:
        key = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in keys)
        count, users, amount, mean = values
        formats = {"corrupt_records": ["text"]}.get(name, ["parquet", "csv"][: 1 + (name in _REPORTS)])
        parts += [
            f"""SELECT '{name}' AS dataset, '{fmt}' AS format, {key} AS key,
       CAST({count} AS BIGINT) AS count, CAST({users} AS BIGINT) AS users,
       CAST({amount} AS DOUBLE) AS amount, CAST({mean} AS DOUBLE) AS mean FROM ({body})"""
            for fmt in formats
        ]
    return "\nUNION ALL ".join(parts)


def _verify() -> str:
    columns = {"clickstream_cleaned": 15, "activity_by_region_hour": 8, "device_statistics": 5}
    columns |= {"top_users": 6, "daily_activity": 4, "user_activity": 8}
    found = [(name, "parquet", body, columns[name]) for name, body, _, _ in _DATASETS]
    found += [(name, "csv", body, columns[name]) for name, body, _, _ in _DATASETS if name in _REPORTS]
    found += [("run_summary", "parquet", "SELECT 1", 10), ("corrupt_records", "text", _CORRUPT, 1)]
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS dataset, '{fmt}' AS format, true AS found, "
        f"{_COUNT} AS rows, CAST({n} AS INTEGER) AS columns FROM ({body})"
        for name, fmt, body, n in found
    )


_RECONCILE = "\nUNION ALL ".join(
    f"SELECT '{check}' AS \"check\", n AS expected, n AS actual, true AS ok "
    f"FROM (SELECT {_COUNT} AS n FROM ({body}))"
    for check, body in [
        ("events in daily_activity", "SELECT * FROM cleaned"),
        ("events in activity_by_region_hour", "SELECT * FROM cleaned"),
        ("events in device_statistics", "SELECT * FROM cleaned"),
        ("report rows of activity_by_region_hour", _ACTIVITY),
        ("report rows of device_statistics", _DEVICES),
        ("report rows of top_users", _TOP),
        ("report rows of daily_activity", _DAILY),
        ("events in user_activity", "SELECT * FROM cleaned"),
        ("cleaned rows in run_summary", "SELECT * FROM cleaned"),
        ("valid and corrupt rows of the input", "SELECT * FROM cells"),
        ("last rank of top_users", _TOP),
    ]
)


def _raw(body: str) -> str:
    return f"WITH {_RAW}\n{body}"


def _cleaned(body: str) -> str:
    return f"WITH {_RAW}{_DEDUPED}{_CLEANED}\n{body}"


def _lines(body: str) -> str:
    return f"WITH {_RAW}{_LINES}\n{body}"


def _lines_cleaned(body: str) -> str:
    return f"WITH {_RAW}{_LINES}{_LINES_CLEANED}\n{body}"


def oracle_sql() -> dict[str, str]:
    """Expected result of each registered query."""
    return {
        # cleaning
        "clickstream_raw": _raw("SELECT * FROM raw"),
        "dedupe_events": f"WITH {_RAW}{_DEDUPED}\nSELECT * FROM deduped",
        "fill_defaults": _raw(f"SELECT {_FILLED_COLUMNS} FROM raw"),
        "filter_valid": _raw(
            f"""SELECT * EXCLUDE (event_timestamp)
FROM (SELECT *, {_STRICT_TIME} AS event_timestamp FROM raw) WHERE {_VALID}"""
        ),
        "parse_event_time": _raw(f'SELECT "timestamp", {_STRICT_TIME} AS event_timestamp FROM raw'),
        "time_features": _raw(
            f"""SELECT event_timestamp, {_TIME_FEATURES}
FROM (SELECT {_STRICT_TIME} AS event_timestamp FROM raw)"""
        ),
        "session_category": _raw(
            f"SELECT duration_sec, {_SESSION_CATEGORY} AS session_category FROM raw"
        ),
        "price_category": _raw(f"SELECT price, {_PRICE_CATEGORY} AS price_category FROM raw"),
        "enrich": _raw(_enriched("raw")),
        "cleaned_events": _cleaned("SELECT * FROM cleaned"),
        # metrics
        "activity_by_region_hour": _cleaned(_ACTIVITY),
        "device_statistics": _cleaned(_DEVICES),
        "user_activity": _cleaned(_USERS),
        "top_users": _cleaned(_TOP),
        "daily_activity": _cleaned(_DAILY),
        "region_rollup": _cleaned(_REGIONS),
        "top_regions": _cleaned(f"{_REGIONS} ORDER BY total_events DESC, region LIMIT 5"),
        "recent_days": _cleaned(f"{_DAILY} ORDER BY event_date DESC LIMIT 5"),
        "distinct_users": _cleaned("SELECT DISTINCT user_id FROM cleaned"),
        "distinct_regions": _cleaned("SELECT DISTINCT region FROM cleaned"),
        "cleaned_sample": _cleaned(f"SELECT * FROM cleaned ORDER BY {_SAMPLE_ORDER} LIMIT 5"),
        "daily_sample": _cleaned(f"{_DAILY} ORDER BY event_date LIMIT 3"),
        # quality
        "raw_profile": _raw(_PROFILE),
        "run_summary": _cleaned(_summary(_ALL_VALID)),
        # sources and sinks
        "read_clickstream": f"WITH {_RAW}{_FROM_CSV}\nSELECT * FROM reread",
        "valid_rows": _lines(_VALID_LINES),
        "corrupt_rows": _lines(_CORRUPT),
        "write_corrupt": _lines(_CORRUPT),
        "read_cleaned": _cleaned("SELECT * FROM cleaned"),
        "aggregate_activity_by_region_hour": _cleaned(_ACTIVITY),
        "aggregate_device_statistics": _cleaned(_DEVICES),
        "aggregate_top_users": _cleaned(_TOP),
        "aggregate_daily_activity": _cleaned(_DAILY),
        "report_activity_by_region_hour": _cleaned(_ACTIVITY),
        "report_device_statistics": _cleaned(_DEVICES),
        "report_top_users": _cleaned(_TOP),
        "report_daily_activity": _cleaned(_DAILY),
        "latest_run": _cleaned(
            f"SELECT *, '20240102_000000' AS run_id FROM ({_summary(_NO_INPUT)})"
        ),
        "load": _cleaned(_written(_NO_INPUT, corrupt=False)),
        # whole runs, from CSV files
        "quarantined_run": _lines_cleaned(_written(_SOME_VALID, corrupt=True)),
        "verify_outputs": _lines_cleaned(_verify()),
        "reconcile_outputs": _lines_cleaned(_RECONCILE),
    }
