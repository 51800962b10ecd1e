"""Device dimension, alert facts, daily device health and incident summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.operators import scoring


def device_dimension(staged_devices: DataFrame) -> DataFrame:
    return staged_devices.select(
        "device_id", "device_type", "manufacturer", "model", "install_date", "location", "zone",
        "maintenance_interval_days", "last_maintenance_date", "days_since_maintenance", "status",
        scoring.maintenance_due().alias("maintenance_due"), "updated_at")


def alert_summary(staged_alerts: DataFrame) -> DataFrame:
    return staged_alerts.groupBy(
        "device_id", "alert_type", "severity", F.to_date("alert_timestamp").alias("alert_date")
    ).agg(F.count(F.lit(1)).alias("alert_count"))


def latest_alert(staged_alerts: DataFrame) -> DataFrame:
    """Severity of the newest alert and the number of alerts of all time, per device."""
    return staged_alerts.groupBy("device_id").agg(
        F.max_by("severity", F.struct("alert_timestamp", "alert_id")).alias("latest_alert_severity"),
        F.count(F.lit(1)).alias("alert_count"))


def alert_facts(staged_alerts: DataFrame, dim: DataFrame) -> DataFrame:
    """Alerts with their device. Spark sizes the dimension and picks the join."""
    wide = dim.select("device_id", "device_type", "manufacturer", "model", "location", "zone",
                      F.col("status").alias("device_status"), "maintenance_due")
    return staged_alerts.select(
        "alert_id", "device_id", "alert_type", "severity", "message", "metric_name", "metric_value", "threshold",
        "alert_timestamp", "resolved", "ingested_at").join(wide, "device_id", "left")


def device_health(daily: DataFrame, dim: DataFrame, latest: DataFrame) -> DataFrame:
    device = dim.select("device_id", "device_type", "location", "zone", "status", "maintenance_due")
    joined = daily.join(device, "device_id").join(latest, "device_id", "left").withColumn(
        "alert_count", F.coalesce("alert_count", F.lit(0)))
    return joined.withColumn("last_reading", F.col("reading_date")).withColumn("health_score", scoring.daily_health())


def incident_summary(incidents: DataFrame) -> DataFrame:
    return incidents.groupBy("device_id", "severity", F.to_date("created_at").alias("incident_date")).agg(
        F.count(F.lit(1)).alias("incident_count"), F.count("resolution").alias("resolved_count"))


def enrich(telemetry: DataFrame, dim: DataFrame) -> DataFrame:
    """Readings with their device's reference data; a batch or a stream on the left side."""
    reference = dim.select("device_id", "manufacturer", "model", "zone", "status", "maintenance_due")
    return telemetry.join(reference, "device_id", "left")
