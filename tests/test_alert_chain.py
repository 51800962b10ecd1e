"""Stretches, bucket quantiles and the rules as one chain against plain versions, with hot keys and without session settings."""

import random

import pytest
from pyspark.sql import functions as F

from opslake.operators import alerting


def plain_stretches(places, gap):
    out = []
    for at in sorted(places):
        if out and at - out[-1][1] <= gap:
            out[-1][1:] = [at, out[-1][2] + 1]
        else:
            out.append([at, at, 1])
    return sorted(map(tuple, out))


@pytest.mark.parametrize("width", [1, 7, 50, 10_000])
@pytest.mark.parametrize("gap", [1, 5, 40])
def test_stretches_whatever_the_slices(spark, width, gap):
    draw = random.Random(width * gap)
    rows = [("hot", draw.randrange(3_000)) for _ in range(600)] + [(k, draw.randrange(300)) for k in ("a", None) for _ in range(30)]
    frame = spark.createDataFrame(rows, "k string, at bigint").repartition(5)
    got = alerting.stretches(frame, ["k"], F.col("at"), gap, width).collect()
    for key in ("hot", "a", None):
        assert sorted((r.start, r.end, r.n) for r in got if r.k == key) == plain_stretches([a for k, a in rows if k == key], gap)


def test_held_for_over_many_slices(spark):
    series = spark.range(5_000).select(F.lit("k").alias("k"), (F.col("id") * 15).alias("step"), (F.col("id") % 2_500 != 2_000).alias("breached"))
    got = [(r.steps, r.breach_start.minute) for r in alerting.held_for(series, ["k"], 15, 600, slice_steps=40).orderBy("breach_start").collect()]
    assert [n for n, _ in got] == [2_000, 2_499, 499]


def plain_quantile(values, q, bounds):
    counts = [sum(v <= b for v in values) for b in bounds]
    rank, low, before = q * len(values), 0.0, 0
    for bound, upto in zip(bounds, counts):
        if upto >= rank:
            return low + (bound - low) * (rank - before) / (upto - before)
        low, before = bound, upto
    return bounds[-1]


def test_bucket_quantile_over_sliding_windows(spark):
    draw = random.Random(5)
    rows = [(draw.choice(["x", "y"]), draw.randrange(1_200), draw.choice([0.003, 0.2, 3.0, 7.0, 20.0]) * draw.random()) for _ in range(500)]
    frame = spark.createDataFrame(rows, "k string, at bigint, seconds double").withColumn("ts", F.timestamp_seconds("at"))
    got = {(r.k, r.step): r.value for r in alerting.bucket_p99(frame, ["k"], "ts", F.col("seconds"), 300, 15, 0.9).collect()}
    want = {}
    for key in "xy":
        for step in range(0, 1_500, 15):
            inside = [v for k, at, v in rows if k == key and step - 300 < at // 15 * 15 <= step]
            if inside:
                want[key, step] = plain_quantile(inside, 0.9, alerting.LATENCY_BOUNDS)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_rules_fire_with_the_given_limits_only_when_they_hold(spark):
    """Ten minutes with an error every two seconds and slow answers in half of them, in a session of default settings."""
    spark.conf.unset("spark.sql.sessionWindow.merge.sessions.in.local.partition")
    try:
        rows = [("a", s, s % 2 == 0 and 600 <= s < 1_200, 8.0 if 600 <= s < 1_200 else 0.1) for s in range(0, 2_400)]
        rows += [("b", s, False, 0.1) for s in range(0, 2_400, 10)]
        frame = spark.createDataFrame(rows, "k string, at bigint, failed boolean, seconds double").withColumn("ts", F.timestamp_seconds("at"))
        got = {r.rule: r for r in alerting.rule_notifications(frame, ["k"], "ts", F.col("failed"), F.col("seconds")).collect()}
    finally:
        spark.conf.set("spark.sql.sessionWindow.merge.sessions.in.local.partition", "true")
    assert set(got) == {"HighErrorRate", "HighLatency"} and all(r.k == "a" and r.repeat_no == 0 for r in got.values())
    # Above 0.1 errors a second from 60 s of errors on, two minutes later it fires.
    assert got["HighErrorRate"].notify_at.timestamp() == 600 + 45 + 15 + 120 and got["HighErrorRate"].firings > 40
    assert got["HighLatency"].notify_at.timestamp() >= 600 + 300
