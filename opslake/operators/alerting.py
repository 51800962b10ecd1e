"""Rates, latency series, held conditions and notification suppression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslake.functions.quantiles import exact_quantiles

# Latency bucket bounds in seconds.
LATENCY_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]


def per_step(events: DataFrame, keys: list[str], time: str, step_seconds: int, value: Column) -> DataFrame:
    """One row per series and step. Everything downstream works on steps, never on raw events."""
    step = (F.floor(F.unix_micros(time) / (step_seconds * 1_000_000)) * step_seconds).cast("long")
    return events.groupBy(*keys, step.alias("step")).agg(F.sum(value).alias("amount"))


def sliding_sums(steps: DataFrame, keys: list[str], amounts: list[str], window_seconds: int = 300, step_seconds: int = 15
                 ) -> DataFrame:
    """Sums over the window that ends with each step, and whether the step itself has a row (``present``).

    A step is there as long as its window has a row. Each row is added to the steps it reaches, so no series is ordered and
    the map tasks add up most of a hot one.
    """
    ahead = F.explode(F.sequence(F.lit(0), F.lit(window_seconds - step_seconds), F.lit(step_seconds))).alias("_ahead")
    spread = steps.select(*keys, *amounts, "step", ahead)
    return spread.groupBy(*keys, (F.col("step") + F.col("_ahead")).alias("step")).agg(
        *[F.sum(c).alias(c) for c in amounts], (F.min("_ahead") == 0).alias("present"))


def rate(events: DataFrame, keys: list[str], time: str, value: Column, window_seconds: int = 300,
         step_seconds: int = 15, every_step: bool = False) -> DataFrame:
    """Per-second increase over the window that ends with each step having events, or on request with every step."""
    sums = sliding_sums(per_step(events, keys, time, step_seconds, value), keys, ["amount"], window_seconds, step_seconds)
    return sums.where(F.lit(every_step) | F.col("present")).select(
        *keys, F.timestamp_seconds(F.col("step") + step_seconds).alias("sampled_at"),
        (F.col("amount") / float(window_seconds)).alias("rate"))


def bucket_counts(events: DataFrame, keys: list[str], time: str, seconds: Column, step_seconds: int,
                  bounds: list[float] | None = None) -> DataFrame:
    """keys, step, b0, b1, ..., all: how many values are at most each bound, in one pass over the events."""
    limits = bounds or LATENCY_BOUNDS
    step = (F.floor(F.unix_micros(time) / (step_seconds * 1_000_000)) * step_seconds).cast("long").alias("step")
    return events.groupBy(*keys, step).agg(
        *[F.count_if(seconds <= b).alias(f"b{i}") for i, b in enumerate(limits)], F.count(seconds).alias("all"))


def bucket_quantile(q: float, bounds: list[float] | None = None) -> Column:
    """Quantile of cumulative bucket counts ``b0``, ``b1``, ..., ``all``, linear inside its bucket.

    Buckets begin at 0. A rank beyond the last bound gives that bound; without values the quantile is null.
    """
    limits = bounds or LATENCY_BOUNDS
    wanted = F.col("all") * F.lit(q)
    found = F.when(F.col("all") == 0, None)
    low, before = 0.0, F.lit(0)
    for i, high in enumerate(limits):
        upto = F.col(f"b{i}")
        found = found.when(upto >= wanted, F.lit(low) + F.lit(high - low) * (wanted - before) / (upto - before))
        low, before = high, upto
    return found.otherwise(F.lit(float(limits[-1])))


def bucket_p99(events: DataFrame, keys: list[str], time: str, seconds: Column, window_seconds: int = 300,
               step_seconds: int = 15, q: float = 0.99, bounds: list[float] | None = None) -> DataFrame:
    """keys, step, value: the quantile of the buckets of the window that ends with each step."""
    counts = bucket_counts(events, keys, time, seconds, step_seconds, bounds)
    amounts = [c for c in counts.columns if c not in (*keys, "step")]
    return sliding_sums(counts, keys, amounts, window_seconds, step_seconds).select(
        *keys, "step", bucket_quantile(q, bounds).alias("value"))


def window_p99(events: DataFrame, keys: list[str], time: str, value: str, window: str = "5 minutes") -> DataFrame:
    stamped = events.withColumn("window_start", F.window(time, window).start)
    return exact_quantiles(stamped, [*keys, "window_start"], F.col(value), {"p99": 0.99})


def stretches(rows: DataFrame, keys: list[str], at: Column, gap: int, slice_width: int) -> DataFrame:
    """start, end, n of the maximal stretches of rows in which neighbours are at most ``gap`` apart.

    Rows are ordered by (keys, slice) only. Of each slice just the first and the last stretch can go on in another one;
    those are joined in a second step, two rows a slice.
    """
    cut = rows.select(*keys, at.cast("long").alias("_at")).withColumn("_slice", F.floor(F.col("_at") / slice_width))
    inside = Window.partitionBy(*keys, "_slice").orderBy("_at")
    opens = F.coalesce((F.col("_at") - F.lag("_at").over(inside) > gap).cast("int"), F.lit(0))
    parts = cut.withColumn("_opens", opens).withColumn("_no", F.sum("_opens").over(inside)).groupBy(*keys, "_slice", "_no").agg(
        F.min("_at").alias("start"), F.max("_at").alias("end"), F.count(F.lit(1)).alias("n"))
    told = parts.withColumn("_last", F.max("_no").over(Window.partitionBy(*keys, "_slice")))
    edge = (F.col("_no") == 0) | (F.col("_no") == F.col("_last"))
    across = Window.partitionBy(*keys).orderBy("start")
    new = F.coalesce((F.col("start") - F.lag("end").over(across) > gap).cast("int"), F.lit(0))
    joined = told.where(edge).withColumn("_new", new).withColumn("_group", F.sum("_new").over(across)).groupBy(
        *keys, "_group").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n"))
    columns = [*keys, "start", "end", "n"]
    return told.where(~edge).select(*columns).unionByName(joined.select(*columns))


def held_for(series: DataFrame, keys: list[str], step_seconds: int, duration_seconds: int, slice_steps: int = 1_000
             ) -> DataFrame:
    """Stretches where ``breached`` held at every step for at least the duration.

    ``series`` has one row per key and ``step`` (epoch seconds). A missing step ends a stretch.
    """
    found = stretches(series.where("breached"), keys, F.col("step"), step_seconds, slice_steps * step_seconds)
    return found.where(F.col("end") - F.col("start") >= duration_seconds).select(
        *keys, F.timestamp_seconds("start").alias("breach_start"),
        F.timestamp_seconds(F.col("start") + duration_seconds).alias("fires_at"),
        F.timestamp_seconds("end").alias("breach_end"), F.col("n").alias("steps"))


def suppress(firings: DataFrame, keys: list[str], time: str = "timestamp", resolve_seconds: int = 300,
             repeat_seconds: int = 10_800, slice_seconds: int = 3_600) -> DataFrame:
    """Notifications left after repeats are held back.

    A firing more than ``resolve_seconds`` after the one before opens a new episode. Inside an
    episode one notification goes out per ``repeat_seconds``. Firings find their episode through a
    join on (keys, slice), so a hot key is spread over its slices.
    """
    found = stretches(firings, keys, F.unix_micros(time), resolve_seconds * 1_000_000, slice_seconds * 1_000_000)
    first_slice = F.floor(F.col("start") / (slice_seconds * 1_000_000))
    last_slice = F.floor(F.col("end") / (slice_seconds * 1_000_000))
    episodes = found.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.timestamp_micros("start").alias("episode_start"),
        F.timestamp_micros("end").alias("_last"), F.explode(F.sequence(first_slice, last_slice)).alias("_s"))
    sliced = firings.withColumn("_slice", F.floor(F.unix_micros(time) / (slice_seconds * 1_000_000)))
    condition = (F.col("_slice") == F.col("_s")) & F.col(time).between(F.col("episode_start"), F.col("_last"))
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    step = F.floor((F.unix_micros(time) - F.unix_micros("episode_start")) / (repeat_seconds * 1_000_000))
    return sliced.join(episodes, condition).groupBy(*keys, "episode_start", step.alias("repeat_no")).agg(
        F.min(time).alias("notify_at"), F.count(F.lit(1)).alias("firings"))


# Limits and durations of the alert rules.
ERROR_RATE, ERROR_SECONDS = 0.1, 120
LATENCY_P99, LATENCY_SECONDS = 5.0, 300


def firing_steps(series: DataFrame, keys: list[str], step_seconds: int, duration_seconds: int) -> DataFrame:
    """keys, timestamp: the steps at which a breach has held for the duration."""
    held = held_for(series, keys, step_seconds, duration_seconds)
    return held.select(*keys, F.explode(F.sequence(
        F.col("fires_at"), F.col("breach_end"), F.expr(f"INTERVAL {step_seconds} SECONDS"))).alias("timestamp"))


def rule_notifications(requests: DataFrame, keys: list[str], time: str, failed: Column, seconds: Column,
                       step_seconds: int = 15) -> DataFrame:
    """rule, keys, episode_start, repeat_no, notify_at, firings of the error-rate and the latency rule.

    Each rule is evaluated at every step over the last five minutes; a breach must hold for the rule's duration, then fires at
    every step, and its repeats are held back.
    """
    errors = rate(requests, keys, time, failed.cast("int"), step_seconds=step_seconds, every_step=True).select(
        *keys, (F.unix_seconds("sampled_at") - step_seconds).alias("step"), (F.col("rate") > ERROR_RATE).alias("breached"))
    slow = bucket_p99(requests, keys, time, seconds, step_seconds=step_seconds).withColumn(
        "breached", F.col("value") > LATENCY_P99)
    firings = [firing_steps(series, keys, step_seconds, hold).withColumn("rule", F.lit(rule)) for rule, series, hold in (
        ("HighErrorRate", errors, ERROR_SECONDS), ("HighLatency", slow, LATENCY_SECONDS))]
    return suppress(firings[0].unionByName(firings[1]), ["rule", *keys])


def request_counters(requests: DataFrame) -> DataFrame:
    """Requests per method, endpoint and status with errors and tokens."""
    return requests.groupBy("method", "endpoint", "status").agg(
        F.count(F.lit(1)).alias("requests"), F.count_if("failed").alias("errors"),
        F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"))


def latency_histogram(requests: DataFrame, bounds: list[float] | None = None) -> DataFrame:
    """Cumulative bucket counts per method and endpoint; ``le`` is the upper bound in seconds."""
    limits = bounds or LATENCY_BOUNDS
    seconds = F.col("latency_ms") / 1000.0
    counts = requests.groupBy("method", "endpoint").agg(
        *[F.count_if(seconds <= b).alias(f"b{i}") for i, b in enumerate(limits)], F.count("latency_ms").alias("all"))
    rows = [F.struct(F.lit(str(b)).alias("le"), F.col(f"b{i}").alias("count")) for i, b in enumerate(limits)]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("all").alias("count")))
    return counts.select("method", "endpoint", F.inline(F.array(*rows)))
