"""Registry of named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Added before rounding on both sides: an exact half then rounds the same way whatever the
# summation order was.
NUDGE = 1e-9
DIGITS = 6


def present(df: DataFrame) -> DataFrame:
    """Rows in the plain types both engines print alike: text, bigint and rounded double."""
    shown = []
    for field in df.schema:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            col = F.round(col.cast("double") + NUDGE, DIGITS)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(kind, T.BooleanType):
            col = col.cast("int").cast("bigint")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("bigint")
        elif isinstance(kind, T.ArrayType):
            col = F.array_join(F.transform(col, lambda x: x.cast("string")), ",")
        shown.append(col.alias(field.name))
    return df.select(*shown)


def query(key: str, sql: str | None = None):
    """Register a query; its result is brought into presentable types."""
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[key] = lambda spark, sf_dir: present(build(spark, sf_dir))
        if sql is not None:
            ORACLES[key] = sql
        return build

    return register


SHOW = {
    "": "{c}",
    "r": f"round(CAST({{c}} AS DOUBLE) + {NUDGE}, {DIGITS})",
    "t": "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')",
    "d": "strftime({c}, '%Y-%m-%d')",
    "i": "CAST({c} AS BIGINT)",
    "b": "CAST(CAST({c} AS INTEGER) AS BIGINT)",
    "a": "array_to_string({c}, ',')",
}


def oracle(columns: str, body: str, *views: str) -> str:
    """SQL over the named views. ``columns`` lists name or name:kind, the kinds of ``SHOW``."""
    shown = []
    for item in columns.split():
        name, _, kind = item.partition(":")
        shown.append(f"{SHOW[kind].format(c=name)} AS {name}")
    ordered: list[str] = []

    def need(view: str) -> None:
        deps, _ = VIEWS[view]
        for dep in deps:
            need(dep)
        if view not in ordered:
            ordered.append(view)

    for view in views:
        need(view)
    head = ", ".join(f"{v} AS ({VIEWS[v][1]})" for v in ordered)
    return (f"WITH {head} " if head else "") + f"SELECT {', '.join(shown)} FROM ({body}) AS result"


AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
DEVICE = "'DEV-' || CASE WHEN user_id < 1000 THEN lpad(CAST(user_id AS VARCHAR), 4, '0') ELSE CAST(user_id AS VARCHAR) END"


def one_of(number: str, *values: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {number} % {len(values)} {cases} END"


TYPES = ("CNC_Mill", "Hydraulic_Press", "Conveyor", "Compressor", "Welding_Robot")
ZONES = ("Zone_A", "Zone_B", "Zone_C", "Zone_D")
WORDS = "list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')"

VIEWS: dict[str, tuple[list[str], str]] = {
    "telemetry": ([], f"""
        SELECT event_id, {DEVICE} AS device_id, {one_of('user_id', *TYPES)} AS device_type,
               {one_of('user_id', *ZONES)} AS location, ts AS event_time, 60 + value * 0.3 AS temperature,
               ((event_id * 7919) % 1000) / 250.0e0 AS vibration,
               40 + ((event_id * 104729) % 2300) / 10.0e0 AS pressure,
               30.0e0 + event_id % 21 AS humidity, 10 + ((event_id * 15485863) % 900) / 10.0e0 AS power_usage,
               500.0e0 + event_id % 2500 AS rpm,
               CASE WHEN event_type = 'error' THEN 'ERR_OVERHEAT' END AS error_code
        FROM events"""),
    "device_versions": ([], f"""
        SELECT {DEVICE} AS device_id, {one_of('user_id', *TYPES)} AS device_type,
               {one_of('user_id', 'Maker_A', 'Maker_B', 'Maker_C')} AS manufacturer,
               'M-' || CAST(user_id % 7 AS VARCHAR) AS model,
               DATE '2020-01-01' + CAST(user_id % 365 AS INTEGER) AS install_date,
               {one_of('user_id', *ZONES)} AS location, 'Z' || CAST(user_id % 4 AS VARCHAR) AS zone,
               CASE user_id % 4 WHEN 0 THEN 30 WHEN 1 THEN 60 WHEN 2 THEN 90 ELSE 180 END AS maintenance_interval_days,
               DATE '2024-01-31' - CAST((user_id * 13) % 200 AS INTEGER) AS last_maintenance_date,
               CASE WHEN version = 1 THEN 'active' WHEN user_id % 6 = 4 THEN 'maintenance'
                    WHEN user_id % 6 = 5 THEN 'decommissioned' ELSE 'active' END AS status,
               CASE WHEN version = 1 THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-01-15' END AS updated_at
        FROM (SELECT DISTINCT user_id FROM events) u, (VALUES (1), (2)) AS v(version)"""),
    "device_latest": (["device_versions"], """
        SELECT * EXCLUDE (rn), date_diff('day', last_maintenance_date, DATE '2024-01-31') AS days_since_maintenance FROM (
            SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY updated_at DESC) AS rn FROM device_versions)
        WHERE rn = 1"""),
    "dim": (["device_latest"], """
        SELECT *, CASE WHEN days_since_maintenance > maintenance_interval_days THEN 1 ELSE 0 END AS maintenance_due
        FROM device_latest"""),
    "scored": (["telemetry"], f"""
        SELECT *, CASE WHEN anomaly_score >= 50 THEN 'CRITICAL' WHEN anomaly_score >= 30 THEN 'WARNING'
                       ELSE 'NORMAL' END AS severity, {AS_OF} AS scored_at
        FROM (SELECT *, CASE WHEN temperature > 95 THEN 30 ELSE 0 END + CASE WHEN vibration > 3 THEN 25 ELSE 0 END
                      + CASE WHEN pressure > 250 OR pressure < 50 THEN 20 ELSE 0 END
                      + CASE WHEN power_usage > 90 THEN 15 ELSE 0 END
                      + CASE WHEN error_code IS NOT NULL THEN 10 ELSE 0 END AS anomaly_score FROM telemetry)"""),
    "alerts": (["scored"], f"""
        SELECT event_id, sha256(CAST(event_id AS VARCHAR) || '|ANOMALY_SCORE') AS alert_id, device_id,
               'ANOMALY_SCORE' AS alert_type, severity,
               'Anomaly detected on device ' || device_id || ' (score=' || CAST(anomaly_score AS VARCHAR)
                   || ', severity=' || severity || ')' AS message,
               'anomaly_score' AS metric_name, CAST(anomaly_score AS DOUBLE) AS metric_value, 30.0e0 AS threshold,
               event_time AS timestamp, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS resolved,
               {AS_OF} AS ingested_at
        FROM scored WHERE anomaly_score >= 30"""),
    "incidents": ([], f"""
        SELECT event_id AS incident_id, {DEVICE} AS device_id, 'Incident ' || CAST(event_id AS VARCHAR) AS title,
               props AS description, CASE WHEN event_id % 2 = 1 THEN 'Replaced part' END AS resolution,
               {one_of('event_id', 'low', 'medium', 'high', 'critical')} AS severity, ts AS created_at
        FROM events WHERE event_type = 'error'"""),
    "requests": ([], """
        SELECT event_id AS request_id, ts, CAST(user_id AS VARCHAR) AS "user",
               CASE WHEN user_id % 2 = 0 THEN 'blue' ELSE 'green' END AS slot, event_id - event_id % 2 AS prompt_id,
               CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS backend, value * 10 AS latency_ms,
               event_type = 'error' AS failed,
               CASE WHEN event_type IN ('view', 'click') THEN 'GET' ELSE 'POST' END AS method,
               '/api/' || event_type AS endpoint, CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status,
               event_id % 50 + 1 AS tokens_in, event_id % 20 + 1 AS tokens_out
        FROM events"""),
    "hourly": (["telemetry"], """
        SELECT device_id, date_trunc('hour', event_time) AS reading_hour, avg(temperature) AS avg_temperature,
               max(temperature) AS max_temperature, avg(vibration) AS avg_vibration, max(vibration) AS max_vibration,
               avg(pressure) AS avg_pressure, avg(power_usage) AS avg_power_usage, count(*) AS reading_count
        FROM telemetry GROUP BY ALL"""),
    "daily": (["hourly"], """
        SELECT device_id, CAST(reading_hour AS DATE) AS reading_date, avg(avg_temperature) AS avg_temperature,
               max(max_temperature) AS max_temperature, avg(avg_vibration) AS avg_vibration,
               max(max_vibration) AS max_vibration, avg(avg_pressure) AS avg_pressure,
               avg(avg_power_usage) AS avg_power_usage, sum(reading_count) AS reading_count
        FROM hourly GROUP BY ALL"""),
    "latest_alert": (["alerts"], """
        SELECT device_id, max(severity) FILTER (WHERE rn = 1) AS latest_alert_severity, count(*) AS alert_count
        FROM (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY timestamp DESC, alert_id DESC) AS rn
              FROM alerts) GROUP BY device_id"""),
    "features": (["device_latest", "alerts"], f"""
        SELECT d.device_id, d.days_since_maintenance, d.maintenance_interval_days,
               count(a.alert_id) FILTER (WHERE a.timestamp >= {AS_OF} - INTERVAL 24 HOUR AND a.timestamp <= {AS_OF})
                   AS alert_count_24h
        FROM device_latest d LEFT JOIN alerts a ON a.device_id = d.device_id GROUP BY ALL"""),
    "corpus": ([], """
        SELECT doc_id, 'doc://' || CAST(doc_id AS VARCHAR) AS url, lang AS type, source AS name, text FROM documents"""),
    "messages": ([], """
        SELECT CAST(conv_id AS VARCHAR) AS session_id, conv_id, turn, role, text AS content,
               TIMESTAMP '2024-01-01' + to_seconds(conv_id * 3600 + turn * 60) AS created_at FROM conversations"""),
    "terms": ([], "SELECT item_id AS query_id, text AS query FROM benchmark"),
    "query_vectors": ([], "SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id % 20 = 0"),
    "item_vectors": ([], "SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS q FROM embeddings"),
    "corpus_vectors": ([], """
        SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label AS collection FROM embeddings"""),
    "chunks": ([], f"""
        SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, n_chunks,
               array_to_string(list_slice(words, i * 96 + 1, i * 96 + 128), ' ') AS text
        FROM (SELECT doc_id, words, CAST(ceil(len(words) / 96.0) AS INTEGER) AS n_chunks
              FROM (SELECT doc_id, {WORDS} AS words FROM documents) WHERE len(words) > 0) d,
             LATERAL (SELECT unnest(range(0, n_chunks)) AS i)"""),
    "runs": ([], """
        SELECT 'model-' || CAST(user_id % 20 AS VARCHAR) AS model,
               CASE WHEN event_id % 2 = 0 THEN 'blue' ELSE 'green' END AS slot, event_id - event_id % 2 AS input_id,
               ts, value * 4 AS latency_ms,
               0.65e0 + (user_id % 7) * 0.03e0 + (event_id % 10) / 100.0e0 + (event_id % 2) * 0.03e0 AS quality,
               event_id % 10 <> 0 AS consistent, (event_id * 31 + user_id) % 40 = 0 AS failed
        FROM events"""),
    "metrics": (["runs"], """
        SELECT model, slot, count(*) AS runs, avg(quality) AS quality_score,
               avg(CASE WHEN consistent THEN 1.0e0 ELSE 0.0e0 END) AS consistency_score,
               avg(CASE WHEN failed THEN 1.0e0 ELSE 0.0e0 END) AS error_rate,
               quantile_cont(latency_ms, 0.5) AS latency_p50_ms, quantile_cont(latency_ms, 0.99) AS latency_p99_ms
        FROM runs GROUP BY ALL"""),
}
