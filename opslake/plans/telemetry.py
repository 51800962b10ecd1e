"""Queries over telemetry, devices, alerts, features and quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from opslake import inputs as src
from opslake.inputs import AS_OF
from opslake.operators import alerting, features, marts, ordered, quality, scoring, telemetry as tel
from opslake.plans.catalog import AS_OF as NOW
from opslake.plans.catalog import SHOW, VIEWS, oracle, query

READING = ("event_id device_id device_type location {time}:t temperature:r vibration:r pressure:r humidity:r "
           "power_usage:r rpm:r error_code")
ALERT = ("alert_id device_id alert_type severity message metric_name metric_value:r threshold:r {time}:t "
         "resolved:i ingested_at:t")
DEVICE = ("device_id device_type manufacturer model install_date:d location zone maintenance_interval_days:i "
          "last_maintenance_date:d status updated_at:t days_since_maintenance:i")


def staged_devices(spark, sf):
    return tel.stage_devices(src.devices(spark, sf), AS_OF)


def dimension(spark, sf):
    return marts.device_dimension(staged_devices(spark, sf))


def staged_alerts(spark, sf):
    return tel.stage_alerts(src.alerts(spark, sf))


def hourly(spark, sf):
    return tel.hourly_stats(tel.stage_telemetry(src.telemetry(spark, sf)))


# Staging and look-ups

@query("stg_telemetry", oracle(
    READING.format(time="event_timestamp") + " reading_hour:t",
    "SELECT * EXCLUDE (event_time), event_time AS event_timestamp, date_trunc('hour', event_time) AS reading_hour "
    "FROM telemetry", "telemetry"))
def _(spark, sf):
    return tel.stage_telemetry(src.telemetry(spark, sf))


@query("stg_devices", oracle(DEVICE, "SELECT * FROM device_latest", "device_latest"))
def _(spark, sf):
    return staged_devices(spark, sf)


@query("stg_alerts", oracle(
    ALERT.format(time="alert_timestamp"), "SELECT *, timestamp AS alert_timestamp FROM alerts", "alerts"))
def _(spark, sf):
    return staged_alerts(spark, sf)


@query("recent_telemetry", oracle(
    READING.format(time="event_time"),
    f"SELECT * FROM telemetry WHERE event_time >= {NOW} - INTERVAL 48 HOUR AND event_time <= {NOW} "
    "ORDER BY event_time DESC, event_id LIMIT 500", "telemetry"))
def _(spark, sf):
    return tel.recent_telemetry(src.telemetry(spark, sf), AS_OF, hours=48, limit=500)


@query("alerts_query", oracle(
    ALERT.format(time="timestamp"),
    "SELECT * FROM alerts WHERE device_id = 'DEV-0007' AND severity = 'WARNING' "
    "ORDER BY timestamp DESC, alert_id LIMIT 100", "alerts"))
def _(spark, sf):
    return tel.find_alerts(src.alerts(spark, sf), device="DEV-0007", severity="WARNING")


@query("active_alerts", oracle(
    ALERT.format(time="timestamp"),
    "SELECT * FROM alerts WHERE resolved = 0 ORDER BY timestamp DESC, alert_id LIMIT 100", "alerts"))
def _(spark, sf):
    return tel.find_alerts(src.alerts(spark, sf), open_only=True)


@query("critical_recent", oracle(
    ALERT.format(time="timestamp"),
    f"SELECT * FROM alerts WHERE severity = 'CRITICAL' AND timestamp >= {NOW} - INTERVAL 12 HOUR "
    "ORDER BY timestamp DESC, alert_id LIMIT 100", "alerts"))
def _(spark, sf):
    return tel.critical_alerts(src.alerts(spark, sf), AS_OF, hours=12)


@query("device_list", oracle(
    "device_id device_type manufacturer model install_date:d location zone maintenance_interval_days:i "
    "last_maintenance_date:d status", "SELECT * FROM device_latest", "device_latest"))
def _(spark, sf):
    return tel.list_devices(src.devices(spark, sf))


@query("recent_incidents", oracle(
    "incident_id device_id title description resolution severity created_at:t",
    "SELECT * FROM incidents ORDER BY created_at DESC, incident_id LIMIT 1000", "incidents"))
def _(spark, sf):
    return ordered.newest(src.incidents(spark, sf), "created_at", "incident_id", 1000)


@query("page_offset", oracle(
    "conv_id turn role", "SELECT * FROM conversations ORDER BY conv_id, turn LIMIT 25 OFFSET 40"))
def _(spark, sf):
    rows = src.table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return ordered.page_by_offset(rows, [F.col("conv_id"), F.col("turn")], 25, 40)


@query("page_keyset", oracle(
    "doc_id name has_next_page:b end_cursor total_count", """
    SELECT doc_id, name, (SELECT count(*) FROM corpus WHERE doc_id > 57) > 20 AS has_next_page,
           max(doc_id) OVER () AS end_cursor, (SELECT count(*) FROM corpus) AS total_count
    FROM (SELECT * FROM corpus WHERE doc_id > 57 ORDER BY doc_id LIMIT 20)""", "corpus"))
def _(spark, sf):
    return ordered.page_by_cursor(src.corpus(spark, sf).select("doc_id", "name"), "doc_id", 20, 57)


# Scores and classes

@query("anomaly_score", oracle("event_id anomaly_score:i", "SELECT * FROM scored", "scored"))
def _(spark, sf):
    return src.telemetry(spark, sf).select("event_id", scoring.anomaly_score().alias("anomaly_score"))


@query("severity", oracle("event_id severity scored_at:t", "SELECT * FROM scored", "scored"))
def _(spark, sf):
    return src.scored(spark, sf).select("event_id", "severity", "scored_at")


@query("build_alerts", oracle(
    ALERT.format(time="timestamp"), "SELECT * REPLACE (0 AS resolved) FROM alerts", "alerts"))
def _(spark, sf):
    return scoring.build_alerts(src.scored(spark, sf), AS_OF)


@query("maintenance_due", oracle("device_id maintenance_due:i", "SELECT * FROM dim", "dim"))
def _(spark, sf):
    return dimension(spark, sf).select("device_id", "maintenance_due")


HEALTH = """
    SELECT dy.*, d.device_type, d.location, d.zone, d.status, d.maintenance_due,
           coalesce(l.alert_count, 0) AS alert_count, l.latest_alert_severity, dy.reading_date AS last_reading,
           greatest(0, least(100, 100
             - CASE WHEN dy.max_temperature > 85 THEN 20 WHEN dy.max_temperature > 70 THEN 10 ELSE 0 END
             - CASE WHEN dy.max_vibration > 10 THEN 25 WHEN dy.max_vibration > 5 THEN 10 ELSE 0 END
             - CASE WHEN CAST(dy.avg_pressure AS DECIMAL(30,9)) < 1 OR CAST(dy.avg_pressure AS DECIMAL(30,9)) > 5 THEN 15 ELSE 0 END
             - CASE WHEN CAST(dy.avg_power_usage AS DECIMAL(30,9)) > 50 THEN 10 ELSE 0 END
             - CASE WHEN d.maintenance_due = 1 THEN 15 ELSE 0 END
             - CASE upper(coalesce(l.latest_alert_severity, '')) WHEN 'CRITICAL' THEN 15 WHEN 'WARNING' THEN 5
                    ELSE 0 END)) AS health_score
    FROM daily dy JOIN dim d ON d.device_id = dy.device_id LEFT JOIN latest_alert l ON l.device_id = dy.device_id"""


def health(spark, sf):
    return marts.device_health(
        tel.daily_stats(hourly(spark, sf)), dimension(spark, sf), marts.latest_alert(staged_alerts(spark, sf)))


@query("health_daily", oracle("device_id reading_date:d health_score:i", HEALTH, "daily", "dim", "latest_alert"))
def _(spark, sf):
    return health(spark, sf).select("device_id", "reading_date", "health_score")


FEATURE_HEALTH = f"""
    SELECT device_id, {NOW} AS event_timestamp,
           CAST(greatest(0.0e0, 100.0e0 - 2 * days_since_maintenance - 10 * alert_count_24h) AS FLOAT) AS health_score,
           days_since_maintenance, alert_count_24h,
           CAST(CAST(alert_count_24h AS DOUBLE) / maintenance_interval_days AS FLOAT) AS anomaly_score FROM features"""


def feature_health(spark, sf):
    base = features.device_features(staged_devices(spark, sf), src.alerts(spark, sf), AS_OF)
    return features.health_features(base, AS_OF)


@query("health_feature", oracle(
    "device_id event_timestamp:t health_score:r days_since_maintenance:i alert_count_24h:i anomaly_score:r",
    FEATURE_HEALTH, "features"))
def _(spark, sf):
    return feature_health(spark, sf)


LIVE = f"""
    SELECT *, round(greatest(0.0e0, 100.0e0
        - CASE WHEN avg_temperature > 150 OR avg_temperature < -10 THEN 30 ELSE 0 END
        - CASE WHEN avg_vibration > 0.8 THEN 20 ELSE 0 END - least(alert_count * 5, 40)), 1) AS health_score
    FROM (SELECT t.device_id, round(CAST(avg(temperature) FILTER (WHERE recent) AS DECIMAL(30,9)), 2) AS avg_temperature,
                 round(CAST(avg(vibration) FILTER (WHERE recent) AS DECIMAL(30,9)), 4) AS avg_vibration,
                 round(CAST(avg(pressure) FILTER (WHERE recent) AS DECIMAL(30,9)), 2) AS avg_pressure,
                 max(event_time) FILTER (WHERE recent) AS last_reading, coalesce(max(n), 0) AS alert_count
          FROM (SELECT *, event_time >= {NOW} - INTERVAL 24 HOUR AS recent FROM telemetry) t
          LEFT JOIN (SELECT device_id, count(*) AS n FROM alerts WHERE resolved = 0 GROUP BY 1) a
            ON a.device_id = t.device_id GROUP BY 1)"""


@query("health_live", oracle("device_id health_score:r alert_count:i last_reading:t", LIVE, "telemetry", "alerts"))
def _(spark, sf):
    rows = tel.live_device_health(src.telemetry(spark, sf), src.alerts(spark, sf), AS_OF)
    return rows.select("device_id", "health_score", "alert_count", "last_reading")


@query("risk_level", oracle("device_id risk_level", f"""
    SELECT device_id, CASE WHEN health_score < 30 THEN 'CRITICAL' WHEN health_score < 50 THEN 'HIGH'
           WHEN health_score < 70 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level FROM ({FEATURE_HEALTH})""", "features"))
def _(spark, sf):
    return feature_health(spark, sf).select("device_id", scoring.risk_level(F.col("health_score")).alias("risk_level"))


@query("maintenance_tier", oracle(
    "device_id device_type days_since_maintenance:i maintenance_interval_days:i overdue:b priority recommendation "
    "health_score:r", f"""
    SELECT *, s > m AS overdue,
           CASE WHEN s > m THEN CASE WHEN s - m > m * 0.5e0 THEN 'critical' ELSE 'high' END
                WHEN s > m * 0.8e0 THEN 'medium' ELSE 'low' END AS priority,
           CASE WHEN s > m THEN concat('OVERDUE: Maintenance was due ', s - m, ' day(s) ago. Schedule immediately.')
                WHEN s > m * 0.8e0 THEN concat('Maintenance due soon (', m - s,
                     ' days remaining). Schedule within the next week.')
                ELSE concat('Device within normal maintenance window. Next maintenance in ~', m - s, ' days.')
                END AS recommendation
    FROM (SELECT d.*, days_since_maintenance AS s, maintenance_interval_days AS m, coalesce(h.health_score, 100.0e0) AS health_score
          FROM device_latest d LEFT JOIN ({LIVE}) h ON h.device_id = d.device_id)""",
    "device_latest", "telemetry", "alerts"))
def _(spark, sf):
    health = tel.live_device_health(src.telemetry(spark, sf), src.alerts(spark, sf), AS_OF)
    return scoring.maintenance_tier(staged_devices(spark, sf), health)


@query("maintenance_mart", oracle(
    "device_id device_type location zone status overdue:i health_score:r last_reading_date:d "
    "days_since_maintenance:i maintenance_interval_days:i recommendation priority", """
    SELECT *, maintenance_due AS overdue, CAST(NULL AS DOUBLE) AS health_score, DATE '2024-01-31' AS last_reading_date,
           'Maintenance overdue. Schedule maintenance within the next 48 hours.' AS recommendation, 'high' AS priority
    FROM dim WHERE maintenance_due = 1""", "dim"))
def _(spark, sf):
    return scoring.maintenance_mart(dimension(spark, sf), AS_OF)


@query("event_route", oracle("conv_id turn route", """
    SELECT conv_id, turn, CASE WHEN t LIKE '%status%' THEN 'get_system_status'
           WHEN t LIKE '%capabilities%' THEN 'list_capabilities'
           WHEN t LIKE '%domain%' OR t LIKE '%mode%' THEN 'get_domain_mode'
           WHEN t LIKE '%manual%' OR t LIKE '%search%' THEN 'search_manuals' END AS route
    FROM (SELECT *, lower(text) AS t FROM conversations)"""))
def _(spark, sf):
    return src.table(spark, sf, "conversations").select("conv_id", "turn", scoring.route(F.col("text")).alias("route"))


# Aggregates

MINUTES = """
    SELECT date_trunc('minute', event_time) AS window_start,
           date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end, device_id, count(*) AS event_count,
           avg(temperature) AS avg_temperature, max(vibration) AS max_vibration, avg(pressure) AS avg_pressure,
           avg(humidity) AS avg_humidity, avg(power_usage) AS avg_power_usage, avg(rpm) AS avg_rpm,
           strftime(date_trunc('minute', event_time), '%Y-%m-%d') AS dt
    FROM telemetry GROUP BY ALL"""
MINUTE = ("window_start:t window_end:t device_id event_count:i avg_temperature:r max_vibration:r avg_pressure:r "
          "avg_humidity:r avg_power_usage:r avg_rpm:r dt")


@query("minute_agg", oracle(MINUTE, MINUTES, "telemetry"))
def _(spark, sf):
    return tel.minute_aggregates(src.telemetry(spark, sf))


@query("hourly_stats", oracle(
    "device_id reading_hour:t avg_temperature:r max_temperature:r avg_vibration:r max_vibration:r avg_pressure:r "
    "avg_power_usage:r reading_count:i", "SELECT * FROM hourly", "hourly"))
def _(spark, sf):
    return hourly(spark, sf)


@query("daily_stats", oracle(
    "device_id reading_date:d avg_temperature:r max_temperature:r avg_vibration:r max_vibration:r avg_pressure:r "
    "avg_power_usage:r reading_count:i", "SELECT * FROM daily", "daily"))
def _(spark, sf):
    return tel.daily_stats(hourly(spark, sf))


@query("daily_stats_weighted", oracle("device_id reading_date:d avg_temperature:r reading_count:i", """
    SELECT device_id, CAST(event_time AS DATE) AS reading_date, avg(temperature) AS avg_temperature,
           count(*) AS reading_count FROM telemetry GROUP BY ALL""", "telemetry"))
def _(spark, sf):
    return tel.daily_stats(hourly(spark, sf), weighted=True).select(
        "device_id", "reading_date", "avg_temperature", "reading_count")


@query("alert_summary", oracle("device_id alert_type severity alert_date:d alert_count:i", """
    SELECT device_id, alert_type, severity, CAST(timestamp AS DATE) AS alert_date, count(*) AS alert_count
    FROM alerts GROUP BY ALL""", "alerts"))
def _(spark, sf):
    return marts.alert_summary(staged_alerts(spark, sf))


@query("telemetry_stats", oracle(
    "device_id reading_count:i avg_temperature:r min_temperature:r max_temperature:r avg_vibration:r max_vibration:r "
    "avg_pressure:r avg_humidity:r avg_power_usage:r avg_rpm:r last_reading:t", f"""
    SELECT device_id, count(*) AS reading_count, round(CAST(avg(temperature) AS DECIMAL(30,9)), 2) AS avg_temperature,
           round(CAST(min(temperature) AS DECIMAL(30,9)), 2) AS min_temperature, round(CAST(max(temperature) AS DECIMAL(30,9)), 2) AS max_temperature,
           round(CAST(avg(vibration) AS DECIMAL(30,9)), 4) AS avg_vibration, round(CAST(max(vibration) AS DECIMAL(30,9)), 4) AS max_vibration,
           round(CAST(avg(pressure) AS DECIMAL(30,9)), 2) AS avg_pressure, round(CAST(avg(humidity) AS DECIMAL(30,9)), 2) AS avg_humidity,
           round(CAST(avg(power_usage) AS DECIMAL(30,9)), 2) AS avg_power_usage, round(CAST(avg(rpm) AS DECIMAL(30,9)), 2) AS avg_rpm,
           max(event_time) AS last_reading
    FROM telemetry WHERE event_time >= {NOW} - INTERVAL 240 HOUR GROUP BY device_id""", "telemetry"))
def _(spark, sf):
    return tel.telemetry_stats(src.telemetry(spark, sf), AS_OF, hours=240)


@query("latest_alert", oracle("device_id latest_alert_severity alert_count:i", "SELECT * FROM latest_alert",
                              "latest_alert"))
def _(spark, sf):
    return marts.latest_alert(staged_alerts(spark, sf))


@query("alerts_24h", oracle("device_id alert_count_24h:i", f"""
    SELECT device_id, count(*) FILTER (WHERE timestamp >= {NOW} - INTERVAL 24 HOUR AND timestamp <= {NOW})
        AS alert_count_24h FROM alerts GROUP BY device_id""", "alerts"))
def _(spark, sf):
    return features.alerts_last_day(src.alerts(spark, sf), AS_OF)


@query("severity_counts", oracle("critical:i warning:i normal:i total:i anomaly_rate:r", """
    SELECT count(*) FILTER (WHERE severity = 'CRITICAL') AS critical,
           count(*) FILTER (WHERE severity = 'WARNING') AS warning,
           count(*) FILTER (WHERE severity = 'NORMAL') AS normal, count(*) AS total,
           round(count(*) FILTER (WHERE severity <> 'NORMAL') / greatest(count(*), 1), 4) AS anomaly_rate
    FROM scored""", "scored"))
def _(spark, sf):
    return tel.severity_counts(src.scored(spark, sf))


@query("hourly_features", oracle(
    "device_id event_timestamp:t avg_temperature:r avg_vibration:r avg_pressure:r avg_power_usage:r max_temperature:r "
    "max_vibration:r reading_count:i", f"""
    SELECT device_id, date_trunc('hour', event_time) AS event_timestamp, CAST(avg(temperature) AS FLOAT)
           AS avg_temperature, CAST(avg(vibration) AS FLOAT) AS avg_vibration, CAST(avg(pressure) AS FLOAT)
           AS avg_pressure, CAST(avg(power_usage) AS FLOAT) AS avg_power_usage,
           CAST(max(temperature) AS FLOAT) AS max_temperature, CAST(max(vibration) AS FLOAT) AS max_vibration,
           count(*) AS reading_count
    FROM telemetry WHERE event_time >= {NOW} - INTERVAL 168 HOUR GROUP BY ALL""", "telemetry"))
def _(spark, sf):
    return features.hourly_features(src.telemetry(spark, sf), AS_OF)


@query("request_counters", oracle("method endpoint status requests:i errors:i tokens_in:i tokens_out:i", """
    SELECT method, endpoint, status, count(*) AS requests, count(*) FILTER (WHERE failed) AS errors,
           sum(tokens_in) AS tokens_in, sum(tokens_out) AS tokens_out FROM requests GROUP BY ALL""", "requests"))
def _(spark, sf):
    return alerting.request_counters(src.requests(spark, sf))


@query("latency_histogram", oracle("method endpoint le count:i", """
    SELECT method, endpoint, le, count(*) FILTER (WHERE latency_ms / 1000.0e0 <= bound) AS count
    FROM requests, (VALUES ('0.005', 0.005e0), ('0.01', 0.01e0), ('0.025', 0.025e0), ('0.05', 0.05e0), ('0.1', 0.1e0),
        ('0.25', 0.25e0), ('0.5', 0.5e0), ('1.0', 1e0), ('2.5', 2.5e0), ('5.0', 5e0), ('10.0', 1e1), ('+Inf', 1e300))
        AS b(le, bound) GROUP BY ALL""", "requests"))
def _(spark, sf):
    return alerting.latency_histogram(src.requests(spark, sf))


# Joins, marts and features

@query("fct_alerts", oracle(
    "alert_id device_id alert_type severity message metric_name metric_value:r threshold:r alert_timestamp:t "
    "resolved:i ingested_at:t device_type manufacturer model location zone device_status maintenance_due:i", """
    SELECT a.*, a.timestamp AS alert_timestamp, d.device_type, d.manufacturer, d.model, d.location, d.zone,
           d.status AS device_status, d.maintenance_due
    FROM alerts a LEFT JOIN dim d ON d.device_id = a.device_id""", "alerts", "dim"))
def _(spark, sf):
    return marts.alert_facts(staged_alerts(spark, sf), dimension(spark, sf))


@query("fct_device_health", oracle(
    "device_id reading_date:d device_type location zone status maintenance_due:i avg_temperature:r max_temperature:r "
    "avg_vibration:r max_vibration:r avg_pressure:r avg_power_usage:r reading_count:i alert_count:i "
    "latest_alert_severity last_reading:d health_score:i", HEALTH, "daily", "dim", "latest_alert"))
def _(spark, sf):
    return health(spark, sf)


@query("device_features", oracle(
    "device_id days_since_maintenance:i maintenance_interval_days:i alert_count_24h:i", "SELECT * FROM features",
    "features"))
def _(spark, sf):
    return features.device_features(staged_devices(spark, sf), src.alerts(spark, sf), AS_OF)


@query("feature_lookup", oracle(
    "device_id stats__avg_temperature:r stats__reading_count:i health__health_score:r health__alert_count_24h:i", f"""
    SELECT d.device_id, CAST(s.avg_temperature AS FLOAT) AS stats__avg_temperature, s.reading_count AS stats__reading_count,
           h.health_score AS health__health_score, h.alert_count_24h AS health__alert_count_24h
    FROM device_latest d LEFT JOIN (SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY reading_hour DESC) AS rn FROM hourly
            WHERE reading_hour >= {NOW} - INTERVAL 24 HOUR AND reading_hour <= {NOW}) WHERE rn = 1) s
        ON s.device_id = d.device_id
    LEFT JOIN ({FEATURE_HEALTH}) h ON h.device_id = d.device_id""", "device_latest", "hourly", "features"))
def _(spark, sf):
    views = {
        "stats": (features.hourly_features(src.telemetry(spark, sf), AS_OF), 86_400),
        "health": (feature_health(spark, sf), 86_400),
    }
    wide = features.lookup_features(staged_devices(spark, sf).select("device_id"), views, AS_OF)
    return wide.select("device_id", "stats__avg_temperature", "stats__reading_count", "health__health_score",
                       "health__alert_count_24h")


@query("asof_features", oracle("incident_id device_id created_at:t feature_time:t temperature:r rpm:r", """
    SELECT l.incident_id, l.device_id, l.created_at,
           CASE WHEN ok THEN v_time END AS feature_time, CASE WHEN ok THEN temperature END AS temperature,
           CASE WHEN ok THEN rpm END AS rpm
    FROM (SELECT i.*, v.event_time AS v_time, v.temperature, v.rpm,
                 i.created_at - v.event_time <= INTERVAL 24 HOUR AS ok
          FROM incidents i ASOF LEFT JOIN (SELECT * FROM telemetry WHERE error_code IS NULL) v
            ON v.device_id = i.device_id AND i.created_at >= v.event_time) l""", "incidents", "telemetry"))
def _(spark, sf):
    labels = src.incidents(spark, sf).select("incident_id", "device_id", "created_at")
    view = src.telemetry(spark, sf).where("error_code IS NULL").select("device_id", "event_time", "temperature", "rpm")
    return features.point_in_time(labels, view, ["device_id"], "created_at", "event_time", 86_400)


@query("incident_summary", oracle("device_id severity incident_date:d incident_count:i resolved_count:i", """
    SELECT device_id, severity, CAST(created_at AS DATE) AS incident_date, count(*) AS incident_count,
           count(resolution) AS resolved_count FROM incidents GROUP BY ALL""", "incidents"))
def _(spark, sf):
    return marts.incident_summary(src.incidents(spark, sf))


# Latest-wins and windows

@query("latest_by_key", oracle("device_id status updated_at:t", "SELECT * FROM device_latest", "device_latest"))
def _(spark, sf):
    return ordered.latest_by_key(src.devices(spark, sf), ["device_id"], ["updated_at"]).select(
        "device_id", "status", "updated_at")


@query("resolve_alerts", oracle("alert_id resolved:i known:b", """
    SELECT alert_id, CASE WHEN event_id % 5 = 0 THEN 1 ELSE resolved END AS resolved, TRUE AS known FROM alerts
    UNION ALL SELECT sha256(CAST(event_id AS VARCHAR) || '|ANOMALY_SCORE'), NULL, FALSE FROM scored
    WHERE event_id % 5 = 0 AND anomaly_score < 30""", "alerts"))
def _(spark, sf):
    closed = src.table(spark, sf, "events").where("event_id % 5 = 0").select(
        scoring.alert_id(F.col("event_id")).alias("alert_id"), F.col("ts").alias("resolved_at"))
    merged, unknown = tel.resolve_alerts(src.alerts(spark, sf), closed)
    return merged.select("alert_id", "resolved", F.lit(True).alias("known")).unionByName(
        unknown.select("alert_id", F.lit(None).cast("int").alias("resolved"), F.lit(False).alias("known")))


@query("alert_for_duration", oracle("slot breach_start:t fires_at:t breach_end:t steps:i", """
    SELECT slot, to_timestamp(start_step)::TIMESTAMP AS breach_start,
           to_timestamp(start_step + 7200)::TIMESTAMP AS fires_at, to_timestamp(end_step)::TIMESTAMP AS breach_end, steps
    FROM (SELECT slot, island, min(step) AS start_step, max(step) AS end_step, count(*) AS steps
          FROM (SELECT slot, step, step - 3600 * row_number() OVER (PARTITION BY slot ORDER BY step) AS island
                FROM (SELECT slot, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS step,
                             count(*) FILTER (WHERE failed) AS amount FROM requests GROUP BY ALL) WHERE amount >= 1)
          GROUP BY slot, island) WHERE end_step - start_step >= 7200""", "requests"))
def _(spark, sf):
    steps = alerting.per_step(src.requests(spark, sf), ["slot"], "ts", 3600, F.col("failed").cast("int"))
    return alerting.held_for(steps.withColumn("breached", F.col("amount") >= 1), ["slot"], 3600, 7200)


@query("rate_5m", oracle("slot sampled_at:t rate:r", """
    SELECT slot, to_timestamp(step + 15)::TIMESTAMP AS sampled_at, sum(amount) OVER (
        PARTITION BY slot ORDER BY step RANGE BETWEEN 285 PRECEDING AND CURRENT ROW) / 300.0e0 AS rate
    FROM (SELECT slot, CAST(floor(epoch(ts) / 15) AS BIGINT) * 15 AS step, count(*) FILTER (WHERE failed) AS amount
          FROM requests GROUP BY ALL)""", "requests"))
def _(spark, sf):
    return alerting.rate(src.requests(spark, sf), ["slot"], "ts", F.col("failed").cast("int"))


@query("p99_5m", oracle("slot window_start:t p99:r", """
    SELECT slot, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, quantile_cont(latency_ms, 0.99) AS p99
    FROM requests GROUP BY ALL""", "requests"))
def _(spark, sf):
    return alerting.window_p99(src.requests(spark, sf), ["slot"], "ts", "latency_ms")


# Requests of the month brought into three hours, so that steps of 15 seconds and the rules' own limits mean something.
COMPRESSED = 240
DENSE = f"""
    dense AS (SELECT slot, failed, latency_ms / 500.0e0 AS seconds, CAST(floor((epoch_us(TIMESTAMP '2024-01-01')
                  + (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // {COMPRESSED}) / 15e6) AS BIGINT) * 15 AS step FROM requests),
    reached AS (SELECT slot, failed, seconds, step + ahead AS step FROM dense, range(0, 300, 15) AS g(ahead))"""
BUCKETS = ", ".join(f"({i}, {high}e0, {low}e0)" for i, (low, high) in enumerate(
    zip([0.0, *alerting.LATENCY_BOUNDS], alerting.LATENCY_BOUNDS)))
#: The 99 % quantile from bucket counts: of the first bucket whose cumulative count reaches the rank.
BUCKET_P99 = f"""
    counts AS (SELECT slot, step, i, low, high, count(*) FILTER (seconds <= high) AS upto, count(seconds) AS n
               FROM reached, (VALUES {BUCKETS}) AS v(i, high, low) GROUP BY ALL),
    ranked AS (SELECT *, coalesce(lag(upto) OVER (PARTITION BY slot, step ORDER BY i), 0) AS before FROM counts),
    p99s AS (SELECT slot, step, coalesce(min_by(low + (high - low) * (0.99e0 * n - before) / (upto - before), i)
                 FILTER (upto >= 0.99e0 * n), 10.0e0) AS value FROM ranked GROUP BY ALL HAVING max(n) > 0)"""


def dense_requests(spark, sf):
    start = F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    passed = F.floor((F.unix_micros("ts") - start) / COMPRESSED)
    return src.requests(spark, sf).select("slot", "failed", (F.col("latency_ms") / 500.0).alias("seconds"),
                                          F.timestamp_micros(start + passed).alias("ts"))


@query("bucket_p99", f"WITH requests AS ({VIEWS['requests'][1]}), {DENSE}, {BUCKET_P99} "
       f"SELECT slot, step, {SHOW['r'].format(c='value')} AS value FROM p99s")
def _(spark, sf):
    return alerting.bucket_p99(dense_requests(spark, sf), ["slot"], "ts", F.col("seconds"))


@query("alert_rules", f"""WITH requests AS ({VIEWS['requests'][1]}), {DENSE}, {BUCKET_P99},
    rates AS (SELECT slot, step, count(*) FILTER (failed) / 300.0e0 AS value FROM reached GROUP BY ALL),
    breached AS (SELECT 'HighErrorRate' AS rule, 120 AS hold, slot, step FROM rates WHERE value > 0.1
                 UNION ALL SELECT 'HighLatency', 300, slot, step FROM p99s WHERE value > 5),
    islands AS (SELECT rule, slot, hold, min(step) AS first, max(step) AS last FROM (
                    SELECT *, step - 15 * row_number() OVER (PARTITION BY rule, slot ORDER BY step) AS island FROM breached)
                GROUP BY rule, slot, hold, island HAVING max(step) - min(step) >= hold),
    firings AS (SELECT rule, slot, moment FROM islands, LATERAL (SELECT unnest(range(first + hold, last + 1, 15)) AS moment)),
    episodes AS (SELECT *, sum(opens) OVER (PARTITION BY rule, slot ORDER BY moment) AS episode FROM (
                     SELECT *, CASE WHEN moment - lag(moment) OVER (PARTITION BY rule, slot ORDER BY moment) <= 300 THEN 0 ELSE 1 END AS opens
                     FROM firings)),
    opened AS (SELECT *, min(moment) OVER (PARTITION BY rule, slot, episode) AS start FROM episodes)
    SELECT rule, slot, strftime(to_timestamp(start)::TIMESTAMP, '%Y-%m-%d %H:%M:%S.%f') AS episode_start,
           CAST((moment - start) // 10800 AS BIGINT) AS repeat_no,
           strftime(to_timestamp(min(moment))::TIMESTAMP, '%Y-%m-%d %H:%M:%S.%f') AS notify_at, count(*) AS firings
    FROM opened GROUP BY rule, slot, start, (moment - start) // 10800""")
def _(spark, sf):
    return alerting.rule_notifications(dense_requests(spark, sf), ["slot"], "ts", F.col("failed"), F.col("seconds"))


@query("alert_suppress", oracle("severity episode_start:t repeat_no:i notify_at:t firings:i", """
    SELECT severity, episode_start, CAST(floor(epoch(timestamp - episode_start) / 10800) AS BIGINT) AS repeat_no,
           min(timestamp) AS notify_at, count(*) AS firings
    FROM (SELECT severity, timestamp, min(timestamp) OVER (PARTITION BY severity, episode) AS episode_start
          FROM (SELECT severity, timestamp, sum(opens) OVER (PARTITION BY severity ORDER BY timestamp) AS episode
                FROM (SELECT severity, timestamp, CASE WHEN timestamp - lag(timestamp) OVER (
                          PARTITION BY severity ORDER BY timestamp) <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS opens
                      FROM alerts))) GROUP BY ALL""", "alerts"))
def _(spark, sf):
    return alerting.suppress(src.alerts(spark, sf), ["severity"], resolve_seconds=3600)


@query("moving_average", oracle("event_id device_id event_time:t temperature:r moving_avg:r", """
    SELECT *, avg(temperature) OVER (PARTITION BY device_id ORDER BY event_time
        RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW) AS moving_avg FROM telemetry""", "telemetry"))
def _(spark, sf):
    return tel.moving_average(src.telemetry(spark, sf), seconds=21_600, slice_seconds=86_400)


# Stream twins on batches

@query("sliding_anomaly_counts", oracle("window_start:t window_end:t device_id anomaly_count:i", """
    SELECT w AS window_start, w + INTERVAL 5 MINUTE AS window_end, device_id, count(*) AS anomaly_count
    FROM (SELECT device_id, date_trunc('minute', event_time) - to_minutes(k) AS w
          FROM scored, range(0, 5) AS g(k) WHERE severity <> 'NORMAL') GROUP BY ALL""", "scored"))
def _(spark, sf):
    return tel.sliding_anomaly_counts(src.scored(spark, sf))


@query("consecutive_breach", oracle("event_id device_id event_time:t temperature:r run_length:i", """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY device_id, run ORDER BY event_time, event_id) - 1
            + CASE WHEN run = 0 THEN 1 ELSE 0 END AS run_length
        FROM (SELECT *, sum(CASE WHEN temperature > 80 THEN 0 ELSE 1 END) OVER (
                  PARTITION BY device_id ORDER BY event_time, event_id) AS run FROM telemetry))
    WHERE temperature > 80 AND run_length >= 3""", "telemetry"))
def _(spark, sf):
    return tel.consecutive_breaches(src.telemetry(spark, sf), limit=80.0)


def redelivered(spark, sf):
    """Telemetry in which every fourth event arrives twice, the second time a minute later."""
    rows = src.telemetry(spark, sf)
    late = rows.where("event_id % 4 = 0").withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 1 MINUTE"))
    return rows.unionByName(late)


@query("dedup_events", oracle("event_id event_time:t", "SELECT * FROM telemetry", "telemetry"))
def _(spark, sf):
    return tel.dedup_events(redelivered(spark, sf)).select("event_id", "event_time")


@query("merge_batch_speed", oracle("event_id event_time:t temperature:r", "SELECT * FROM telemetry", "telemetry"))
def _(spark, sf):
    rows = src.telemetry(spark, sf)
    merged = tel.merge_batch_and_speed(rows, rows, "2024-01-20 00:00:00")
    return merged.select("event_id", "event_time", "temperature")


# Data quality

def dirty(spark, sf):
    """Telemetry with faults: blank devices, impossible readings, an unknown device type."""
    event = F.col("event_id")
    return src.telemetry(spark, sf).withColumns({
        "device_id": F.when(event % 97 == 0, "").otherwise(F.col("device_id")),
        "temperature": F.when(event % 89 == 0, 400.0).otherwise(F.col("temperature")),
        "vibration": F.when(event % 83 == 0, -1.0).otherwise(F.col("vibration")),
        "device_type": F.when(event % 79 == 0, "Toaster").otherwise(F.col("device_type")),
    })


DIRTY = """SELECT * REPLACE (CASE WHEN event_id % 97 = 0 THEN '' ELSE device_id END AS device_id,
    CASE WHEN event_id % 89 = 0 THEN 400.0e0 ELSE temperature END AS temperature,
    CASE WHEN event_id % 83 = 0 THEN -1.0e0 ELSE vibration END AS vibration,
    CASE WHEN event_id % 79 = 0 THEN 'Toaster' ELSE device_type END AS device_type) FROM telemetry"""
RULES = [
    ("device_id_not_null", "device_id IS NULL OR device_id = ''"), ("timestamp_not_null", "event_time IS NULL"),
    ("temperature_in_range", "temperature < -40 OR temperature > 300"), ("vibration_non_negative", "vibration < 0"),
    ("pressure_in_range", "pressure < 0 OR pressure > 1000"), ("humidity_in_range", "humidity < 0 OR humidity > 100"),
    ("power_usage_non_negative", "power_usage < 0"), ("rpm_non_negative", "rpm < 0"),
    ("known_device_types",
     "device_type NOT IN ('CNC_Mill', 'Hydraulic_Press', 'Conveyor', 'Compressor', 'Welding_Robot')"),
]
RULE_ROWS = " UNION ALL ".join(
    [f"SELECT '{n}' AS rule, count(*) AS violations FROM ({DIRTY}) WHERE {c}" for n, c in RULES] + [
        f"SELECT 'data_freshness', CASE WHEN max(event_time) > {NOW} - INTERVAL 1 HOUR THEN 0 ELSE 1 END "
        "FROM telemetry"])


@query("expectation_report", oracle("rule violations:i result score_pct:r", f"""
    SELECT rule, violations, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS result,
           round(100.0 * sum(CASE WHEN violations = 0 THEN 1 ELSE 0 END) OVER () / 10, 1) AS score_pct
    FROM ({RULE_ROWS})""", "telemetry"))
def _(spark, sf):
    return quality.expectation_report(dirty(spark, sf), AS_OF)


@query("ingest_checks", oracle('"check" value:i ok:b', """
    SELECT 'devices_present' AS "check", count(*) AS value, count(*) > 0 AS ok FROM device_versions
    UNION ALL SELECT 'device_id_filled', count(*) FILTER (WHERE trim(device_id) = ''), TRUE FROM device_versions
    UNION ALL SELECT 'telemetry_rows', count(*), TRUE FROM telemetry""", "device_versions", "telemetry"))
def _(spark, sf):
    return quality.ingest_checks(src.devices(spark, sf), src.telemetry(spark, sf))


@query("unique", oracle("text_hash occurrences:i", """
    SELECT md5(text) AS text_hash, count(*) AS occurrences FROM documents GROUP BY ALL HAVING count(*) > 1"""))
def _(spark, sf):
    hashed = src.table(spark, sf, "documents").select(F.md5("text").alias("text_hash"))
    return quality.duplicated_values(hashed, "text_hash")


@query("not_null", oracle('"column" nulls:i', """
    SELECT 'error_code' AS "column", count(*) FILTER (WHERE error_code IS NULL) AS nulls FROM telemetry
    UNION ALL SELECT 'device_id', count(*) FILTER (WHERE device_id IS NULL) FROM telemetry""", "telemetry"))
def _(spark, sf):
    return quality.null_counts(src.telemetry(spark, sf), ["error_code", "device_id"])


@query("row_assertion", oracle("device_id reading_date:d health_score:i",
                               f"SELECT * FROM ({HEALTH}) WHERE NOT (health_score BETWEEN 60 AND 100)",
                               "daily", "dim", "latest_alert"))
def _(spark, sf):
    # The range asserted is narrower than 0 to 100 so that there are rows to compare.
    rows = quality.violations(health(spark, sf), F.col("health_score").between(60, 100))
    return rows.select("device_id", "reading_date", "health_score")


@query("quarantine", oracle("event_id failed_rules:a", f"""
    SELECT event_id, list_filter([{', '.join(f"CASE WHEN {c} THEN '{n}' END" for n, c in RULES)}],
                                 lambda x: x IS NOT NULL) AS failed_rules
    FROM ({DIRTY}) WHERE {' OR '.join(f'({c})' for _, c in RULES)}""", "telemetry"))
def _(spark, sf):
    return quality.quarantine(dirty(spark, sf))[1].select("event_id", "failed_rules")
