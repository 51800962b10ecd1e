"""Rule boundaries of scores, tiers, quality rules and release gates."""

import pytest
from pyspark.sql import functions as F

from opslake.operators import quality, releases, scoring, telemetry as tel


def reading(spark, **given):
    base = {"temperature": 70.0, "vibration": 0.5, "pressure": 150.0, "power_usage": 50.0, "error_code": None}
    kind = "temperature double, vibration double, pressure double, power_usage double, error_code string"
    row = {**base, **given}
    return spark.createDataFrame([tuple(row[c.split()[0]] for c in kind.split(", "))], kind)


@pytest.mark.parametrize("given, score, level", [
    ({}, 0, "NORMAL"),
    ({"temperature": 95.0}, 0, "NORMAL"), ({"temperature": 95.01}, 30, "WARNING"),
    ({"vibration": 3.0}, 0, "NORMAL"), ({"vibration": 3.01}, 25, "NORMAL"),
    ({"pressure": 50.0}, 0, "NORMAL"), ({"pressure": 250.0}, 0, "NORMAL"), ({"pressure": 49.9}, 20, "NORMAL"),
    ({"power_usage": 90.0}, 0, "NORMAL"), ({"power_usage": 90.1}, 15, "NORMAL"),
    ({"temperature": 96.0, "pressure": 260.0}, 50, "CRITICAL"),
    ({"temperature": 96.0, "vibration": 4.0, "pressure": 10.0, "power_usage": 99.0, "error_code": "E"}, 100, "CRITICAL"),
    ({"temperature": None, "vibration": None, "pressure": None, "power_usage": None}, 0, "NORMAL"),
])
def test_score_edges(spark, given, score, level):
    row = reading(spark, **given).select(
        scoring.anomaly_score().alias("s"), scoring.severity(scoring.anomaly_score()).alias("l")).first()
    assert (row.s, row.l) == (score, level)


@pytest.mark.parametrize("since, interval, priority", [
    (24, 30, "low"), (25, 30, "medium"), (30, 30, "medium"), (31, 30, "high"), (45, 30, "high"), (46, 30, "critical")])
def test_maintenance_tiers(spark, since, interval, priority):
    rows = spark.createDataFrame([("d", "t", since, interval)],
                                 "device_id string, device_type string, days_since_maintenance int, maintenance_interval_days int")
    assert scoring.maintenance_tier(rows).first().priority == priority


@pytest.mark.parametrize("score, level", [
    (29.9, "CRITICAL"), (30.0, "HIGH"), (49.9, "HIGH"), (50.0, "MEDIUM"), (70.0, "LOW"), (None, "LOW"), (float("nan"), "LOW")])
def test_risk_levels(spark, score, level):
    row = spark.createDataFrame([(score,)], "s double").select(scoring.risk_level(F.col("s")).alias("l")).first()
    assert row.l == level


GOOD = {"error_rate": 0.01, "quality_score": 0.80, "latency_p99_ms": 400.0}


@pytest.mark.parametrize("green, drift, criteria, decision", [
    ({"quality_score": 0.85}, 0.05, None, "switch_to_green"),
    ({"quality_score": 0.81}, 0.0, None, "stay_on_blue"),
    ({"error_rate": 0.10, "quality_score": 0.85}, 0.0, None, "rollback_to_blue"),
    ({"quality_score": 0.60}, 0.0, None, "rollback_to_blue"),
    ({"quality_score": 0.85, "latency_p99_ms": 1500.0}, 0.0, None, "hold_for_review"),
    ({"quality_score": 0.85}, 0.30, None, "hold_for_review"),
    ({"error_rate": 0.02, "quality_score": 0.85}, 0.0, None, "hold_for_review"),
    ({"quality_score": 0.81}, 0.0, releases.Criteria(min_quality_improvement=0.005), "switch_to_green"),
])
def test_release_gates(spark, green, drift, criteria, decision):
    sides = {f"blue_{k}": v for k, v in GOOD.items()} | {f"green_{k}": v for k, v in {**GOOD, **green}.items()}
    row = releases.decide(spark.createDataFrame([{**sides, "drift_score": drift}]), criteria).first()
    assert row.decision == decision and row.rationale


def test_missing_metrics_count_as_zero(spark):
    kind = ", ".join(f"{s}_{m} double" for s in ("blue", "green") for m in GOOD) + ", drift_score double"
    assert releases.decide(spark.createDataFrame([(None,) * 7], kind)).first().decision == "rollback_to_blue"


def test_clean_rows_break_no_rule(spark):
    kind = ("event_id long, device_id string, device_type string, event_time timestamp, temperature double, "
            "vibration double, pressure double, humidity double, power_usage double, rpm double")
    rows = spark.createDataFrame([(1, "d", "Conveyor", None, 70.0, 0.5, 150.0, 40.0, 50.0, 900.0)], kind).withColumn(
        "event_time", F.lit("2024-01-30 23:30:00").cast("timestamp"))
    report = quality.expectation_report(rows, "2024-01-31 00:00:00").collect()
    assert len(report) == 10 and all(r.result == "PASS" for r in report)
    assert quality.quarantine(rows)[1].isEmpty()


def test_recent_limit_is_checked(spark):
    with pytest.raises(ValueError):
        tel.recent_telemetry(spark.range(1), "2024-01-31 00:00:00", limit=0)
