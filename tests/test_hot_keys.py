"""One key holding most rows: sliced operators against plain pandas, in several partitionings."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from opslake.functions.quantiles import exact_quantiles
from opslake.operators import alerting, features, ordered, sessions, telemetry as tel

START = pd.Timestamp("2024-01-01")


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(1)
    n = 3000
    at = START + pd.to_timedelta(np.sort(rng.integers(0, 3 * 86_400, n)), unit="s")
    return pd.DataFrame({
        "event_id": np.arange(n), "event_time": at,
        "device_id": np.where(rng.random(n) < 0.6, "hot", rng.choice(list("abcdefgh"), n)),
        "temperature": rng.integers(50, 110, n).astype(float)})


@pytest.fixture(scope="module", params=[1, 4, 16])
def rows(spark, frame, request):
    return spark.createDataFrame(frame.sample(frac=1, random_state=request.param)).repartition(request.param)


def test_running_values(rows, frame):
    sliced = rows.withColumn("at", ordered.time_slice(F.col("event_time"), 3600))
    got = ordered.running(sliced, ["device_id"], ["event_time", "event_id"], "at", {
        "n": ("count", None), "total": ("sum", F.col("temperature")), "top": ("max", F.col("temperature")),
        "low": ("min", F.col("temperature")), "hot": ("last", F.when(F.col("temperature") > 100, F.col("event_id")))})
    got = got.toPandas().sort_values("event_id").reset_index(drop=True)
    want = frame.sort_values(["event_time", "event_id"])
    by = want.groupby("device_id")["temperature"]
    want = want.assign(n=by.cumcount() + 1, total=by.cumsum(), top=by.cummax(), low=by.cummin(),
                       hot=want["event_id"].where(want["temperature"] > 100).groupby(want["device_id"]).ffill())
    want = want.sort_values("event_id").reset_index(drop=True)
    for name in ("n", "total", "top", "low", "hot"):
        assert np.allclose(got[name].astype(float), want[name].astype(float), equal_nan=True), name


def test_moving_average(rows, frame):
    got = tel.moving_average(rows, seconds=300, slice_seconds=600).toPandas().set_index("event_id")["moving_avg"]
    for _, part in frame.groupby("device_id"):
        at = part["event_time"].to_numpy()
        for event, t in zip(part["event_id"], at):
            inside = part["temperature"][(at >= t - np.timedelta64(300, "s")) & (at <= t)]
            assert abs(got[event] - inside.mean()) < 1e-9


def test_consecutive_breaches(rows, frame):
    got = {(r.event_id, r.run_length) for r in tel.consecutive_breaches(rows, limit=70.0, slice_seconds=3600).collect()}
    want = set()
    for _, part in frame.groupby("device_id"):
        run = 0
        for r in part.sort_values(["event_time", "event_id"]).itertuples():
            run = run + 1 if r.temperature > 70 else 0
            if run >= 3:
                want.add((r.event_id, run))
    assert got == want


def test_point_in_time(rows, frame):
    labels = rows.where("event_id % 3 = 0").select("event_id", "device_id", F.col("event_time").alias("asked_at"))
    view = rows.where("event_id % 3 = 1").select("device_id", "event_time", "temperature")
    got = features.point_in_time(labels, view, ["device_id"], "asked_at", "event_time", 3600).toPandas()
    left = frame[frame.event_id % 3 == 0].rename(columns={"event_time": "asked_at"})[["event_id", "device_id", "asked_at"]]
    right = frame[frame.event_id % 3 == 1][["device_id", "event_time", "temperature"]]
    want = pd.merge_asof(left, right, left_on="asked_at", right_on="event_time", by="device_id", tolerance=pd.Timedelta("1h"))
    got, want = got.set_index("event_id").sort_index(), want.set_index("event_id").sort_index()
    assert (got["feature_time"].isna() == want["event_time"].isna()).all()
    assert (got["feature_time"].dropna() == want["event_time"].dropna()).all()


def test_exact_quantiles(rows, frame):
    probs = {"p0": 0.0, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    value = F.col("temperature") * F.col("event_id") - 90_000
    got = exact_quantiles(rows, ["device_id"], value, probs).toPandas().set_index("device_id")
    for device, part in frame.groupby("device_id"):
        want = np.quantile(part["temperature"] * part["event_id"] - 90_000, list(probs.values()))
        assert np.allclose(got.loc[device, list(probs)].astype(float), want)


def test_quota(rows, frame):
    asked = rows.select(F.col("event_id").alias("request_id"), F.col("device_id").alias("user"), F.col("event_time").alias("ts"))
    got = sessions.daily_quota(asked).toPandas()
    local = frame.assign(day=(frame["event_time"] + pd.Timedelta("4h")).dt.date)
    number = local.sort_values(["event_time", "event_id"]).groupby(["device_id", "day"]).cumcount() + 1
    want = dict(zip(frame.loc[number.index, "event_id"], number))
    assert all(r.admitted == (want[r.request_id] <= 10) and r.remaining == max(0, 10 - want[r.request_id])
               for r in got.itertuples())


def test_suppression(rows, frame):
    got = {(r.device_id, r.notify_at) for r in alerting.suppress(
        rows, ["device_id"], "event_time", 900, 3600, slice_seconds=1800).collect()}
    want = set()
    for device, part in frame.groupby("device_id"):
        begin = last = None
        sent = set()
        for t in part["event_time"]:
            if last is None or (t - last).total_seconds() > 900:
                begin, sent = t, set()
            step = int((t - begin).total_seconds() // 3600)
            if step not in sent:
                want.add((device, t.to_pydatetime()))
                sent.add(step)
            last = t
    assert got == want


def test_latest_wins_and_dedup(rows, frame):
    latest = {r.device_id: r.event_id for r in ordered.latest_by_key(rows, ["device_id"], ["event_time", "event_id"]).collect()}
    assert latest == frame.sort_values(["event_time", "event_id"]).groupby("device_id")["event_id"].last().to_dict()
    assert tel.dedup_events(rows.unionByName(rows)).count() == len(frame)


def test_held_condition(spark):
    series = spark.createDataFrame([("s", t * 60, t not in (3, 9)) for t in range(12)], "k string, step long, breached boolean")
    got = [(r.steps, r.breach_start.minute) for r in alerting.held_for(series, ["k"], 60, 240).collect()]
    assert got == [(5, 4)]


def test_cursor_pages(spark):
    rows = spark.createDataFrame([(i,) for i in range(1, 8)], "id long")
    page = ordered.page_by_cursor(rows, "id", 3, 2).orderBy("id").collect()
    assert [r.id for r in page] == [3, 4, 5] and page[0].has_next_page and page[0].end_cursor == 5 and page[0].total_count == 7
    assert [r.id for r in ordered.page_by_cursor(rows, "id", 3, 99).orderBy("id").collect()] == [1, 2, 3]
    last = ordered.page_by_cursor(rows, "id", 3, 4).collect()
    assert len(last) == 3 and not last[0].has_next_page
