"""Staging, look-ups and windowed statistics of telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslake.functions.numbers import settled_round
from opslake.operators import scoring
from opslake.operators.ordered import latest_by_key, newest, running, time_slice


def moment(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp")


def since(as_of: str, hours: int) -> Column:
    return moment(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS")


def stage_telemetry(telemetry: DataFrame) -> DataFrame:
    return telemetry.withColumnRenamed("event_time", "event_timestamp").withColumn(
        "reading_hour", F.date_trunc("hour", "event_timestamp"))


def stage_devices(devices: DataFrame, as_of: str) -> DataFrame:
    """Latest version of every device and the days since its last maintenance."""
    return latest_by_key(devices, ["device_id"], ["updated_at"]).withColumn(
        "days_since_maintenance", F.date_diff(F.to_date(F.lit(as_of)), "last_maintenance_date"))


def stage_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.withColumnRenamed("timestamp", "alert_timestamp")


def recent_telemetry(telemetry: DataFrame, as_of: str, hours: int = 1, device: str | None = None,
                     limit: int = 100) -> DataFrame:
    if not 1 <= limit <= 10_000:
        raise ValueError("limit must lie between 1 and 10000")
    rows = telemetry.where((F.col("event_time") >= since(as_of, hours)) & (F.col("event_time") <= moment(as_of)))
    if device is not None:
        rows = rows.where(F.col("device_id") == device)
    return newest(rows, "event_time", "event_id", limit)


def find_alerts(alerts: DataFrame, device: str | None = None, severity: str | None = None,
                open_only: bool = False, limit: int = 100) -> DataFrame:
    if device is not None:
        alerts = alerts.where(F.col("device_id") == device)
    if severity is not None:
        alerts = alerts.where(F.col("severity") == severity)
    if open_only:
        alerts = alerts.where("resolved = 0")
    return newest(alerts, "timestamp", "alert_id", limit)


def critical_alerts(alerts: DataFrame, as_of: str, hours: int = 2, limit: int = 100) -> DataFrame:
    window = (F.col("timestamp") >= since(as_of, hours)) & (F.col("severity") == "CRITICAL")
    return newest(alerts.where(window), "timestamp", "alert_id", limit)


def list_devices(devices: DataFrame) -> DataFrame:
    return latest_by_key(devices, ["device_id"], ["updated_at"]).select(
        "device_id", "device_type", "manufacturer", "model",
        F.date_format("install_date", "yyyy-MM-dd").alias("install_date"),
        "location", "zone", "maintenance_interval_days",
        F.date_format("last_maintenance_date", "yyyy-MM-dd").alias("last_maintenance_date"),
        "status").orderBy("device_id")


def resolve_alerts(alerts: DataFrame, resolutions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Alerts with resolutions (alert_id, resolved_at) applied, and the ids nobody knows.

    Resolutions arrive as newer versions of the alert and the latest version wins.
    """
    closed = resolutions.groupBy("alert_id").agg(F.max("resolved_at").alias("_resolved_at"))
    merged = alerts.join(closed, "alert_id", "left").withColumn(
        "resolved", F.when(F.col("_resolved_at").isNotNull(), 1).otherwise(F.col("resolved"))
    ).select(*alerts.columns)
    unknown = closed.join(alerts.select("alert_id"), "alert_id", "left_anti").select("alert_id")
    return merged, unknown


def metric_aggregates() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("event_count"),
        F.avg("temperature").alias("avg_temperature"),
        F.max("vibration").alias("max_vibration"),
        F.avg("pressure").alias("avg_pressure"),
        F.avg("humidity").alias("avg_humidity"),
        F.avg("power_usage").alias("avg_power_usage"),
        F.avg("rpm").alias("avg_rpm"),
    ]


def minute_aggregates(telemetry: DataFrame) -> DataFrame:
    """Tumbling one-minute statistics per device; works on a batch and on a watermarked stream."""
    return telemetry.groupBy(F.window("event_time", "1 minute").alias("w"), "device_id").agg(
        *metric_aggregates()
    ).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "device_id", "event_count",
        "avg_temperature", "max_vibration", "avg_pressure", "avg_humidity", "avg_power_usage", "avg_rpm",
        F.date_format("w.start", "yyyy-MM-dd").alias("dt"))


def hourly_stats(staged: DataFrame) -> DataFrame:
    return staged.groupBy("device_id", "reading_hour").agg(
        F.avg("temperature").alias("avg_temperature"), F.max("temperature").alias("max_temperature"),
        F.avg("vibration").alias("avg_vibration"), F.max("vibration").alias("max_vibration"),
        F.avg("pressure").alias("avg_pressure"), F.avg("power_usage").alias("avg_power_usage"),
        F.count(F.lit(1)).alias("reading_count"))


def daily_stats(hourly: DataFrame, weighted: bool = False) -> DataFrame:
    """Days from hours: mean of the hourly means, or weighted by readings on request."""
    def mean(name: str) -> Column:
        if weighted:
            return (F.sum(F.col(name) * F.col("reading_count")) / F.sum("reading_count")).alias(name)
        return F.avg(name).alias(name)

    return hourly.groupBy("device_id", F.to_date("reading_hour").alias("reading_date")).agg(
        mean("avg_temperature"), F.max("max_temperature").alias("max_temperature"),
        mean("avg_vibration"), F.max("max_vibration").alias("max_vibration"),
        mean("avg_pressure"), mean("avg_power_usage"), F.sum("reading_count").alias("reading_count"))


def telemetry_stats(telemetry: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    def mean(name: str, digits: int = 2) -> Column:
        return settled_round(F.avg(name), digits).alias(f"avg_{name}")

    return telemetry.where(F.col("event_time") >= since(as_of, hours)).groupBy("device_id").agg(
        F.count(F.lit(1)).alias("reading_count"),
        mean("temperature"),
        settled_round(F.min("temperature"), 2).alias("min_temperature"),
        settled_round(F.max("temperature"), 2).alias("max_temperature"),
        mean("vibration", 4), settled_round(F.max("vibration"), 4).alias("max_vibration"),
        mean("pressure"), mean("humidity"), mean("power_usage"), mean("rpm"),
        F.max("event_time").alias("last_reading")).orderBy("device_id")


def severity_counts(scored: DataFrame) -> DataFrame:
    """One row of run metrics: rows per severity, total, share of anomalies."""
    def rows(level: str) -> Column:
        return F.count_if(F.col("severity") == level)

    return scored.agg(
        rows("CRITICAL").alias("critical"), rows("WARNING").alias("warning"), rows("NORMAL").alias("normal"),
        F.count(F.lit(1)).alias("total"),
    ).withColumn("anomaly_rate", F.round(
        (F.col("critical") + F.col("warning")) / F.greatest(F.col("total"), F.lit(1)), 4))


def live_device_health(telemetry: DataFrame, alerts: DataFrame, as_of: str) -> DataFrame:
    """Health of every device seen in the telemetry, from its last day and its open alerts."""
    seen = telemetry.groupBy("device_id").agg(
        settled_round(F.avg(_if_recent("temperature", as_of)), 2).alias("avg_temperature"),
        settled_round(F.avg(_if_recent("vibration", as_of)), 4).alias("avg_vibration"),
        settled_round(F.avg(_if_recent("pressure", as_of)), 2).alias("avg_pressure"),
        F.max(_if_recent("event_time", as_of)).alias("last_reading"))
    open_alerts = alerts.where("resolved = 0").groupBy("device_id").agg(F.count(F.lit(1)).alias("alert_count"))
    return seen.join(open_alerts, "device_id", "left").withColumn(
        "alert_count", F.coalesce("alert_count", F.lit(0))
    ).withColumn("health_score", F.coalesce(scoring.live_health(), F.lit(100.0)))


def _if_recent(name: str, as_of: str) -> Column:
    return F.when(F.col("event_time") >= since(as_of, 24), F.col(name))


def moving_average(telemetry: DataFrame, metric: str = "temperature", seconds: int = 300,
                   slice_seconds: int = 3600) -> DataFrame:
    """Mean of a metric over the preceding ``seconds`` up to each reading, per device.

    Readings near the end of a slice are also given to the next slice, so every
    (device, slice) is complete by itself and no device is sorted as a whole.
    """
    if slice_seconds < seconds:
        raise ValueError("a slice must be at least as long as the frame")
    at = F.unix_micros("event_time")
    own = time_slice(F.col("event_time"), slice_seconds)
    next_start = (own + 1) * (slice_seconds * 1_000_000)
    slices = F.when(next_start - at <= seconds * 1_000_000, F.array(own, own + 1)).otherwise(F.array(own))
    rows = telemetry.select("event_id", "device_id", "event_time", metric).withColumn(
        "_own", own).withColumn("_slice", F.explode(slices))
    frame = Window.partitionBy("device_id", "_slice").orderBy(at).rangeBetween(-seconds * 1_000_000, 0)
    return rows.withColumn("moving_avg", F.avg(metric).over(frame)).where("_slice = _own").select(
        "event_id", "device_id", "event_time", metric, "moving_avg")


def sliding_anomaly_counts(scored: DataFrame, size: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """Anomalies per device and sliding window; works on a batch and on a watermarked stream."""
    anomalies = scored.where(F.col("severity") != "NORMAL")
    return anomalies.groupBy(F.window("event_time", size, slide).alias("w"), "device_id").agg(
        F.count(F.lit(1)).alias("anomaly_count")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "device_id", "anomaly_count")


def consecutive_breaches(telemetry: DataFrame, metric: str = "temperature", limit: float = 95.0, k: int = 3,
                         slice_seconds: int = 900) -> DataFrame:
    """Readings that complete a run of at least ``k`` consecutive breaches on their device.

    The length of the current run is the reading's number minus the number of the last reading
    within the limit; both are running values carried from slice to slice.
    """
    order = ["event_time", "event_id"]
    rows = telemetry.select("event_id", "device_id", "event_time", metric).withColumn(
        "_at", time_slice(F.col("event_time"), slice_seconds))
    calm = F.coalesce(F.col(metric) <= limit, F.lit(True))
    numbered = running(rows, ["device_id"], order, "_at", {"_n": ("count", None)})
    lengths = running(numbered, ["device_id"], order, "_at", {"_calm": ("max", F.when(calm, F.col("_n")))})
    return lengths.withColumn("run_length", F.col("_n") - F.coalesce("_calm", F.lit(0))).where(
        F.col("run_length") >= k).select("event_id", "device_id", "event_time", metric, "run_length")


def dedup_events(telemetry: DataFrame) -> DataFrame:
    """First delivery of every event."""
    rest = [c for c in telemetry.columns if c != "event_id"]
    order = F.struct("event_time", *[c for c in rest if c != "event_time"])
    return telemetry.groupBy("event_id").agg(F.min_by(F.struct(*rest), order).alias("_row")).select(
        "event_id", "_row.*").select(*telemetry.columns)


def merge_batch_and_speed(batch: DataFrame, speed: DataFrame, cutoff: str) -> DataFrame:
    """Batch history before the cutoff and speed-layer rows from it on, each event once."""
    before = batch.where(F.col("event_time") < moment(cutoff))
    after = speed.where(F.col("event_time") >= moment(cutoff))
    return dedup_events(before.unionByName(after))
