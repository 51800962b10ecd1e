"""Feature tables, snapshot look-up and point-in-time joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opslake.operators import scoring
from opslake.operators.ordered import latest_by_key
from opslake.operators.telemetry import moment, since


def alerts_last_day(alerts: DataFrame, as_of: str, time: str = "timestamp") -> DataFrame:
    recent = (F.col(time) >= since(as_of, 24)) & (F.col(time) <= moment(as_of))
    return alerts.groupBy("device_id").agg(F.count_if(recent).alias("alert_count_24h"))


def hourly_features(telemetry: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Hourly device statistics of the last days, in the narrow types of a feature table."""
    recent = telemetry.where(F.col("event_time") >= since(as_of, days * 24))
    names = ["temperature", "vibration", "pressure", "power_usage"]
    means = [F.avg(n).cast("float").alias(f"avg_{n}") for n in names]
    tops = [F.max(n).cast("float").alias(f"max_{n}") for n in names[:2]]
    return recent.groupBy("device_id", F.date_trunc("hour", "event_time").alias("event_timestamp")).agg(
        *means, *tops, F.count(F.lit(1)).alias("reading_count"))


def device_features(staged_devices: DataFrame, alerts: DataFrame, as_of: str) -> DataFrame:
    counts = alerts_last_day(alerts, as_of)
    return staged_devices.select("device_id", "days_since_maintenance", "maintenance_interval_days").join(
        counts, "device_id", "left").withColumn("alert_count_24h", F.coalesce("alert_count_24h", F.lit(0)))


def health_features(features: DataFrame, as_of: str) -> DataFrame:
    return features.select(
        "device_id", moment(as_of).alias("event_timestamp"),
        scoring.feature_health().cast("float").alias("health_score"),
        F.col("days_since_maintenance").cast("long").alias("days_since_maintenance"),
        F.col("alert_count_24h").cast("long").alias("alert_count_24h"),
        (F.col("alert_count_24h").cast("double") / F.col("maintenance_interval_days")).cast("float")
        .alias("anomaly_score"))


def lookup_features(entities: DataFrame, views: dict[str, tuple[DataFrame, int]], as_of: str) -> DataFrame:
    """Newest row of every view for every entity; null when there is none or it is past its TTL.

    ``views`` maps a name to (frame keyed by device_id and event_timestamp, TTL in seconds). The
    TTL filter runs before the aggregate, so rows that could never be served are not shuffled.
    """
    wide = entities
    for name, (view, ttl) in views.items():
        at = F.unix_micros("event_timestamp")
        now = F.unix_micros(moment(as_of))
        live = view.where((at <= now) & (at >= now - ttl * 1_000_000))
        newest = latest_by_key(live, ["device_id"], ["event_timestamp"]).drop("event_timestamp")
        renamed = [F.col(c).alias(f"{name}__{c}") for c in newest.columns if c != "device_id"]
        wide = wide.join(newest.select("device_id", *renamed), "device_id", "left")
    return wide


def point_in_time(labels: DataFrame, view: DataFrame, keys: list[str], label_time: str, view_time: str,
                  ttl_seconds: int) -> DataFrame:
    """For every label row the newest view row at or before its time and within the TTL.

    Time is cut into slices one TTL long. A view row can serve its own slice and the next one, so
    it is placed in both, and the search runs inside (keys, slice): linear in the rows, and a hot
    key spreads over all its slices.
    """
    values = [c for c in view.columns if c not in keys and c != view_time]
    width = ttl_seconds * 1_000_000
    own_label = F.floor(F.unix_micros(label_time) / width)
    own_view = F.floor(F.unix_micros(view_time) / width)
    asked = labels.select(
        *[F.col(k) for k in keys], F.col(label_time).alias("_at"), F.lit(1).alias("_kind"),
        own_label.alias("_slice"), F.struct(*labels.columns).alias("_label"),
        F.lit(None).cast(view.select(F.struct(view_time, *values).alias("v")).schema["v"].dataType).alias("_value"))
    known = view.select(
        *[F.col(k) for k in keys], F.col(view_time).alias("_at"), F.lit(0).alias("_kind"),
        F.explode(F.array(own_view, own_view + 1)).alias("_slice"),
        F.lit(None).cast(labels.select(F.struct(*labels.columns).alias("l")).schema["l"].dataType).alias("_label"),
        F.struct(view_time, *values).alias("_value"))
    seen = Window.partitionBy(*keys, "_slice").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    matched = asked.unionByName(known).withColumn("_value", F.last("_value", ignorenulls=True).over(seen)).where(
        "_kind = 1")
    fresh = F.unix_micros("_at") - F.unix_micros(F.col(f"_value.{view_time}")) <= width
    return matched.select("_label.*", *[
        F.when(fresh, F.col(f"_value.{c}")).alias("feature_time" if c == view_time else c)
        for c in [view_time, *values]])
