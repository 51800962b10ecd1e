"""Exact quantiles of hot groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def band(value: Column) -> Column:
    """A slice number that grows with the value; bands are about one percent wide.

    Infinities have bands of their own, and NaN, which Spark takes for larger than any number, has the last.
    """
    edge = F.lit(1 << 61)
    return (F.when(F.isnan(value), F.lit(1 << 62)).when(value == float("inf"), edge).when(value == float("-inf"), -edge)
            .otherwise((F.signum(value) * F.floor(F.log2(F.abs(value) + 1) * 64)).cast("long")))


def exact_quantiles(df: DataFrame, keys: list[str], value: Column, probs: dict[str, float]) -> DataFrame:
    """Linearly interpolated quantiles per group, one column per entry of ``probs``.

    The built-in exact percentile keeps every distinct value of a group in one task. Here values
    are counted first, the counts per band locate the ranks wanted, and only the bands that hold
    one are ordered. The largest unit of work is one band of one group. NaN counts as larger than
    any number; a quantile that reaches into the NaN values is NaN.
    """
    counted = df.where(value.isNotNull()).groupBy(*keys, value.cast("double").alias("_v")).agg(
        F.count(F.lit(1)).alias("_n")).withColumn("_band", band(F.col("_v")))
    group = Window.partitionBy(*keys)
    before = group.orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    bands = counted.groupBy(*keys, "_band").agg(F.sum("_n").alias("_rows")).select(
        *keys, "_band", "_rows",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        F.sum("_rows").over(group).alias("_total"))

    def rank(p: float, up: bool) -> Column:
        place = (F.col("_total") - 1) * F.lit(p)
        return (F.ceil(place) if up else F.floor(place)).cast("long")

    def holds(p: float, up: bool, start: Column, rows: Column) -> Column:
        return (rank(p, up) >= start) & (rank(p, up) < start + rows)

    ends = [(p, up) for p in probs.values() for up in (False, True)]
    wanted = bands.where(reduce(lambda a, b: a | b, [holds(p, up, F.col("_start"), F.col("_rows")) for p, up in ends]))
    same = reduce(lambda a, b: a & b, [
        F.col(f"_r_{c}").eqNullSafe(F.col(c)) for c in [*keys, "_band"]])
    right = wanted.select(*[F.col(c).alias(f"_r_{c}") for c in [*keys, "_band"]], "_start", "_total")
    inside = Window.partitionBy(*keys, "_band").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.join(right, same).withColumn(
        "_first", F.col("_start") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))

    def at(p: float, up: bool) -> Column:
        return F.max(F.when(holds(p, up, F.col("_first"), F.col("_n")), F.col("_v")))

    picked = []
    for name, p in probs.items():
        picked += [at(p, False).alias(f"_lo_{name}"), at(p, True).alias(f"_hi_{name}"),
                   F.max((F.col("_total") - 1) * F.lit(p) - rank(p, False)).alias(f"_w_{name}")]
    grouped = placed.groupBy(*keys).agg(*picked)
    return grouped.select(*keys, *[
        F.when(F.col(f"_lo_{n}") == F.col(f"_hi_{n}"), F.col(f"_lo_{n}")).otherwise(
            F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_w_{n}")).alias(n) for n in probs])
