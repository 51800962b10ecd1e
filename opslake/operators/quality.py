"""Data-quality rules, constraint checks and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.operators.telemetry import since

# Device types a reading may carry.
DEVICE_TYPES = ["CNC_Mill", "Hydraulic_Press", "Conveyor", "Compressor", "Welding_Robot"]


def row_rules() -> dict[str, Column]:
    """Rule name to the condition of a row that breaks it."""
    def outside(name: str, low: float, high: float) -> Column:
        return (F.col(name) < low) | (F.col(name) > high)

    device = F.col("device_id")
    return {
        "device_id_not_null": device.isNull() | (device == ""),
        "timestamp_not_null": F.col("event_time").isNull(),
        "temperature_in_range": outside("temperature", -40, 300),
        "vibration_non_negative": F.col("vibration") < 0,
        "pressure_in_range": outside("pressure", 0, 1000),
        "humidity_in_range": outside("humidity", 0, 100),
        "power_usage_non_negative": F.col("power_usage") < 0,
        "rpm_non_negative": F.col("rpm") < 0,
        "known_device_types": ~F.col("device_type").isin(DEVICE_TYPES),
    }


def expectation_report(telemetry: DataFrame, as_of: str, max_age_hours: int = 1) -> DataFrame:
    """Violations and PASS or FAIL per rule, with the share of rules passed. One pass over the rows."""
    counts = [F.count_if(bad).alias(name) for name, bad in row_rules().items()]
    fresh = F.max("event_time") > since(as_of, max_age_hours)
    stale = F.when(F.coalesce(fresh, F.lit(False)), 0).otherwise(1).cast("long").alias("data_freshness")
    totals = telemetry.agg(*counts, stale)
    names = [*row_rules(), "data_freshness"]
    passed = sum((F.when(F.col(n) == 0, 1).otherwise(0) for n in names), F.lit(0))
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in names])
    return totals.select(F.round(passed * 100.0 / len(names), 1).alias("score_pct"), F.inline(rows)).select(
        "rule", "violations", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL").alias("result"), "score_pct")


def ingest_checks(devices: DataFrame, telemetry: DataFrame) -> DataFrame:
    blank = F.col("device_id").isNull() | (F.trim("device_id") == "")
    device_facts = devices.agg(F.count(F.lit(1)).alias("n"), F.count_if(blank).alias("blank")).select(F.inline(F.array(
        F.struct(F.lit("devices_present").alias("check"), F.col("n").alias("value"), (F.col("n") > 0).alias("ok")),
        F.struct(F.lit("device_id_filled").alias("check"), F.col("blank").alias("value"),
                 (F.col("blank") == 0).alias("ok")))))
    telemetry_facts = telemetry.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("telemetry_rows").alias("check"), "value", F.lit(True).alias("ok"))
    return device_facts.unionByName(telemetry_facts)


def duplicated_values(df: DataFrame, column: str) -> DataFrame:
    """Values of a column that must be unique and are not."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns])
    return counts.select(F.inline(rows))


def violations(df: DataFrame, must_hold: Column) -> DataFrame:
    """Rows for which an assertion fails or cannot be decided."""
    return df.where(~F.coalesce(must_hold, F.lit(False)))


def with_failed_rules(telemetry: DataFrame) -> DataFrame:
    failed = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in row_rules().items()]))
    return telemetry.withColumn("failed_rules", failed)


def quarantine(telemetry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with the names of the rules they break."""
    checked = with_failed_rules(telemetry)
    return checked.where(F.size("failed_rules") == 0).drop("failed_rules"), checked.where(F.size("failed_rules") > 0)
