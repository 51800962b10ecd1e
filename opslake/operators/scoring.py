"""Anomaly scores, severities, alerts, health scores and maintenance tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.functions.numbers import settled

# Score limits and points, severity limits, health penalties, tier limits.
SCORE_LIMITS = {
    "temperature_max": 95.0, "vibration_max": 3.0, "pressure_max": 250.0, "pressure_min": 50.0, "power_max": 90.0,
}
SCORE_POINTS = {"temperature": 30, "vibration": 25, "pressure": 20, "power": 15, "error": 10}
CRITICAL_SCORE = 50
WARNING_SCORE = 30
ALERT_TYPE = "ANOMALY_SCORE"
MAINTENANCE_TEXT = "Maintenance overdue. Schedule maintenance within the next 48 hours."


def points(condition: Column, value: int) -> Column:
    return F.when(condition, value).otherwise(0)


def anomaly_score(limits: dict | None = None, weights: dict | None = None) -> Column:
    """Sum of the points of all limits a reading breaks; a missing reading breaks none."""
    lim, pts = {**SCORE_LIMITS, **(limits or {})}, {**SCORE_POINTS, **(weights or {})}
    return (
        points(F.col("temperature") > lim["temperature_max"], pts["temperature"])
        + points(F.col("vibration") > lim["vibration_max"], pts["vibration"])
        + points((F.col("pressure") > lim["pressure_max"]) | (F.col("pressure") < lim["pressure_min"]), pts["pressure"])
        + points(F.col("power_usage") > lim["power_max"], pts["power"])
        + points(F.col("error_code").isNotNull(), pts["error"])
    )


def severity(score: Column) -> Column:
    return F.when(score >= CRITICAL_SCORE, "CRITICAL").when(score >= WARNING_SCORE, "WARNING").otherwise("NORMAL")


def score_telemetry(telemetry: DataFrame, as_of: str) -> DataFrame:
    return (
        telemetry.withColumn("anomaly_score", anomaly_score())
        .withColumn("severity", severity(F.col("anomaly_score")))
        .withColumn("scored_at", F.lit(as_of).cast("timestamp"))
    )


def alert_id(event: Column, kind: str = ALERT_TYPE) -> Column:
    """The same event always gets the same id, so a repeated run adds nothing new."""
    return F.sha2(F.concat(event.cast("string"), F.lit("|" + kind)), 256)


def build_alerts(scored: DataFrame, as_of: str, keep: list[str] | None = None) -> DataFrame:
    message = F.concat(
        F.lit("Anomaly detected on device "), F.col("device_id"),
        F.lit(" (score="), F.col("anomaly_score").cast("string"),
        F.lit(", severity="), F.col("severity"), F.lit(")"))
    return scored.where(F.col("anomaly_score") >= WARNING_SCORE).select(
        *(keep or []),
        alert_id(F.col("event_id")).alias("alert_id"),
        "device_id",
        F.lit(ALERT_TYPE).alias("alert_type"),
        "severity",
        message.alias("message"),
        F.lit("anomaly_score").alias("metric_name"),
        F.col("anomaly_score").cast("double").alias("metric_value"),
        F.lit(float(WARNING_SCORE)).alias("threshold"),
        F.col("event_time").alias("timestamp"),
        F.lit(0).alias("resolved"),
        F.lit(as_of).cast("timestamp").alias("ingested_at"),
    )


def maintenance_due() -> Column:
    return F.when(F.col("days_since_maintenance") > F.col("maintenance_interval_days"), 1).otherwise(0)


def daily_health() -> Column:
    """100 minus the penalties of one device day, kept within 0 and 100."""
    pressure = settled(F.col("avg_pressure"))
    latest = F.upper(F.coalesce(F.col("latest_alert_severity"), F.lit("")))
    penalty = (
        F.when(F.col("max_temperature") > 85, 20).when(F.col("max_temperature") > 70, 10).otherwise(0)
        + F.when(F.col("max_vibration") > 10, 25).when(F.col("max_vibration") > 5, 10).otherwise(0)
        + points((pressure < 1) | (pressure > 5), 15)
        + points(settled(F.col("avg_power_usage")) > 50, 10)
        + points(F.col("maintenance_due") == 1, 15)
        + F.when(latest == "CRITICAL", 15).when(latest == "WARNING", 5).otherwise(0)
    )
    return F.greatest(F.lit(0), F.least(F.lit(100), F.lit(100) - penalty))


def feature_health() -> Column:
    return F.greatest(
        F.lit(0.0),
        F.lit(100.0) - F.col("days_since_maintenance") * 2.0 - F.col("alert_count_24h") * 10.0)


def live_health() -> Column:
    temp, vibration = F.col("avg_temperature"), F.col("avg_vibration")
    score = (
        F.lit(100.0)
        - points((temp > 150) | (temp < -10), 30)
        - points(vibration > 0.8, 20)
        - F.least(F.col("alert_count") * 5, F.lit(40))
    )
    return F.round(F.greatest(score, F.lit(0.0)), 1)


def risk_level(score: Column) -> Column:
    """Missing and NaN scores rank LOW."""
    return (
        F.when(score.isNull() | F.isnan(score), "LOW")
        .when(score < 30, "CRITICAL").when(score < 50, "HIGH").when(score < 70, "MEDIUM").otherwise("LOW")
    )


def maintenance_tier(devices: DataFrame, health: DataFrame | None = None) -> DataFrame:
    """Overdue flag, priority and advice for every device, with its live ``health_score`` where ``health`` is given.

    A device without readings has full health.
    """
    since, interval = F.col("days_since_maintenance"), F.col("maintenance_interval_days")
    left = (interval - since).cast("string")
    late = since - interval
    priority = (
        F.when(since > interval, F.when(late > interval * 0.5, "critical").otherwise("high"))
        .when(since > interval * 0.8, "medium").otherwise("low")
    )
    # The sentences of the advice.
    advice = (
        F.when(since > interval, F.concat(
            F.lit("OVERDUE: Maintenance was due "), late.cast("string"),
            F.lit(" day(s) ago. Schedule immediately.")))
        .when(since > interval * 0.8, F.concat(
            F.lit("Maintenance due soon ("), left, F.lit(" days remaining). Schedule within the next week.")))
        .otherwise(F.concat(
            F.lit("Device within normal maintenance window. Next maintenance in ~"), left, F.lit(" days.")))
    )
    tiers = devices.select(
        "device_id", "device_type", "days_since_maintenance", "maintenance_interval_days",
        (since > interval).alias("overdue"), priority.alias("priority"), advice.alias("recommendation"))
    if health is None:
        return tiers
    return tiers.join(health.select("device_id", "health_score"), "device_id", "left").withColumn(
        "health_score", F.coalesce("health_score", F.lit(100.0)))


def maintenance_mart(dim: DataFrame, as_of: str) -> DataFrame:
    return dim.where("maintenance_due = 1").select(
        "device_id", "device_type", "location", "zone", "status",
        F.col("maintenance_due").alias("overdue"),
        F.lit(None).cast("double").alias("health_score"),
        F.to_date(F.lit(as_of)).alias("last_reading_date"),
        "days_since_maintenance", "maintenance_interval_days",
        F.lit(MAINTENANCE_TEXT).alias("recommendation"),
        F.lit("high").alias("priority"))


# First matching rule wins.
ROUTES = [
    (["status"], "get_system_status"),
    (["capabilities"], "list_capabilities"),
    (["domain", "mode"], "get_domain_mode"),
    (["manual", "search"], "search_manuals"),
]


def route(text: Column, rules: list[tuple[list[str], str]] | None = None) -> Column:
    """Target of the first rule with a keyword in the text, else null."""
    lowered = F.lower(text)
    chosen = F.lit(None).cast("string")
    for words, target in reversed(rules or ROUTES):
        hit = F.lit(False)
        for word in words:
            hit = hit | lowered.contains(word)
        chosen = F.when(hit, F.lit(target)).otherwise(chosen)
    return chosen
