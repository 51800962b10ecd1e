"""Release metrics, replay comparison, drift and release gates.

The meaning of release metrics, replay and drift is this library's own: error ratio, latency
quantiles and means over runs; comparison on inputs both releases ran; population stability
index over reference-quantile bins.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.functions.quantiles import exact_quantiles


@dataclass(frozen=True)
class Criteria:
    """Limits of the release gates (fixed values)."""

    max_error_rate: float = 0.05
    min_quality_score: float = 0.70
    max_latency_p99_ms: float = 1000.0
    max_drift_score: float = 0.25
    min_quality_improvement: float = 0.02
    error_factor: float = 1.5
    latency_factor: float = 1.3


def release_metrics(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Latency quantiles, quality, consistency and error rate per release."""
    basics = runs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("runs"),
        F.avg("quality").alias("quality_score"),
        F.avg(F.when(F.col("consistent"), 1.0).otherwise(0.0)).alias("consistency_score"),
        F.avg(F.when(F.col("failed"), 1.0).otherwise(0.0)).alias("error_rate"))
    quantiles = exact_quantiles(runs, keys, F.col("latency_ms"), {"latency_p50_ms": 0.5, "latency_p99_ms": 0.99})
    return basics.join(quantiles, keys, "left")


def replay_compare(runs: DataFrame) -> DataFrame:
    """Blue against green on the inputs both have run; one row with both sides and the advice."""
    def of(slot: str, value: Column) -> Column:
        return F.max(F.when(F.col("slot") == slot, value))

    error = F.when(F.col("failed"), 1.0).otherwise(0.0)
    paired = runs.groupBy("input_id").agg(
        of("blue", F.col("quality")).alias("bq"), of("green", F.col("quality")).alias("gq"),
        of("blue", error).alias("be"), of("green", error).alias("ge")
    ).where("bq IS NOT NULL AND gq IS NOT NULL")
    sides = paired.agg(
        F.count(F.lit(1)).alias("inputs"),
        F.avg("bq").alias("blue_quality"), F.avg("gq").alias("green_quality"),
        F.avg("be").alias("blue_error"), F.avg("ge").alias("green_error"))
    better = (F.col("green_quality") > F.col("blue_quality")) & (F.col("green_error") <= F.col("blue_error"))
    return sides.withColumn("recommendation", F.when(better, "switch_to_green").otherwise("stay_on_blue"))


def drift(reference: DataFrame, current: DataFrame, columns: list[str], bins: int = 10,
          flag_limit: float = 0.20) -> DataFrame:
    """Population stability index per column, and whether it passes the limit.

    Both sides are unpivoted to (column, value) once. Bin edges are the reference's exact quantiles,
    one row per column, so the table joined back has as many rows as ``columns`` has entries.
    """
    probs = {f"e{i}": i / bins for i in range(1, bins)}
    both = reference.select(F.lit(1).alias("ref"), *[F.col(c).cast("double").alias(c) for c in columns]).unionByName(
        current.select(F.lit(0).alias("ref"), *[F.col(c).cast("double").alias(c) for c in columns]))
    values = both.unpivot(["ref"], columns, "column", "x").where(F.col("x").isNotNull())
    edges = exact_quantiles(values.where("ref = 1"), ["column"], F.col("x"), probs)
    number = reduce(lambda a, b: a + b, [F.when(F.col("x") > F.col(e), 1).otherwise(0) for e in probs])
    everything = values.join(F.broadcast(edges), "column").groupBy("column", number.alias("bin")).agg(
        F.sum("ref").alias("r"), F.sum(1 - F.col("ref")).alias("c"))
    totals = everything.groupBy("column").agg(F.sum("r").alias("rt"), F.sum("c").alias("ct"))
    share = everything.join(totals, "column")
    floor = 1e-6
    p = F.greatest(F.col("r") / F.col("rt"), F.lit(floor))
    q = F.greatest(F.col("c") / F.col("ct"), F.lit(floor))
    return share.groupBy("column").agg(F.sum((q - p) * F.log(q / p)).alias("psi")).withColumn(
        "drifted", F.col("psi") > flag_limit)


def drift_score(per_column: DataFrame, inputs: list[str], outputs: list[str], flag_limit: float = 0.20,
                alert_limit: float = 0.25) -> DataFrame:
    """Input shift, output shift, share of drifted columns and the largest of the three."""
    parts = per_column.agg(
        F.coalesce(F.max(F.when(F.col("column").isin(inputs), F.col("psi"))), F.lit(0.0)).alias("input_shift"),
        F.coalesce(F.max(F.when(F.col("column").isin(outputs), F.col("psi"))), F.lit(0.0)).alias("output_shift"),
        F.avg(F.when(F.col("drifted"), 1.0).otherwise(0.0)).alias("feature_drift_pct"))
    score = F.greatest("input_shift", "output_shift", "feature_drift_pct")
    return parts.withColumn("drift_score", score).withColumn(
        "drift_detected", score > flag_limit).withColumn("drift_alert", score > alert_limit)


def decide(pairs: DataFrame, criteria: Criteria | None = None) -> DataFrame:
    """Decision and rationale for every (blue, green) row; a missing metric counts as 0.

    Columns read: ``{blue,green}_{error_rate,quality_score,latency_p99_ms}`` and ``drift_score``.
    The first gate that closes decides.
    """
    c = criteria or Criteria()

    def metric(name: str) -> Column:
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0))

    be, bq, bl = (metric(f"blue_{m}") for m in ("error_rate", "quality_score", "latency_p99_ms"))
    ge, gq, gl = (metric(f"green_{m}") for m in ("error_rate", "quality_score", "latency_p99_ms"))
    moved, gain = metric("drift_score"), gq - bq
    marginal = (ge <= be) & (gl <= bl)
    # The sentences of the rationale.
    gates = [
        (ge > c.max_error_rate, "rollback_to_blue",
         F.format_string(f"Green error rate %.3f exceeds max {c.max_error_rate}", ge)),
        (gq < c.min_quality_score, "rollback_to_blue",
         F.format_string(f"Green quality %.3f below min {c.min_quality_score}", gq)),
        (gl > c.max_latency_p99_ms, "hold_for_review",
         F.format_string(f"Green p99 latency %.1fms exceeds max {c.max_latency_p99_ms}ms", gl)),
        (moved > c.max_drift_score, "hold_for_review",
         F.format_string(f"Drift score %.3f exceeds threshold {c.max_drift_score}", moved)),
        (gain < c.min_quality_improvement, "stay_on_blue", F.concat(
            F.format_string(f"Green quality improvement %.3f below min {c.min_quality_improvement} "
                            "(blue=%.3f, green=%.3f)", gain, bq, gq),
            F.when(marginal, "; Green is not worse on error/latency, but quality gain is marginal").otherwise(""))),
        (ge > be * c.error_factor, "hold_for_review",
         F.format_string(f"Green error rate %.3f is >{c.error_factor}x blue (%.3f)", ge, be)),
        (gl > bl * c.latency_factor, "hold_for_review",
         F.format_string(f"Green latency %.1fms is >{c.latency_factor}x blue (%.1fms)", gl, bl)),
    ]
    decision, why = F.lit("switch_to_green"), F.format_string(
        "Green passes all gates: quality=%.3f (+%.3f), error_rate=%.3f, p99=%.1fms, drift=%.3f", gq, gain, ge, gl, moved)
    for closed, outcome, text in reversed(gates):
        decision = F.when(closed, outcome).otherwise(decision)
        why = F.when(closed, text).otherwise(why)
    return pairs.withColumn("decision", decision).withColumn("rationale", why)


def apply_decisions(releases: DataFrame, decisions: DataFrame) -> DataFrame:
    """Release table after the decisions (model, decision): a new version of every row."""
    joined = releases.join(decisions.select("model", "decision"), "model", "left")
    blue, green = F.col("slot") == "blue", F.col("slot") == "green"
    switch, back = F.col("decision") == "switch_to_green", F.col("decision") == "rollback_to_blue"
    status = (
        F.when(switch & blue, "archived").when(switch & green, "active_green")
        .when(back & green, "rolled_back").when(back & blue, "active_blue").otherwise(F.col("status")))
    return joined.withColumn("status", status).select(*releases.columns, "decision")


def latest_releases(releases: DataFrame, created: str = "created_at", tie: str = "release_id") -> DataFrame:
    return releases.orderBy(F.col(created).desc(), F.col(tie))
