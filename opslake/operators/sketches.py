"""Approximate distinct counts from sketches that are stored per day and united over days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of a sketch's buckets: 4,096 of them, a few kilobytes a sketch and a standard error of about 1.6 percent.
LG_BUCKETS = 12
STANDARD_ERROR = 1.04 / (1 << LG_BUCKETS) ** 0.5


def daily_sketches(rows: DataFrame, day: str, columns: list[str]) -> DataFrame:
    """day, name, sketch: one mergeable sketch of each column's values for each day. Nulls are not counted.

    The columns are sketched side by side in one pass; the sketches' size does not depend on the rows.
    """
    made = rows.groupBy(day).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), LG_BUCKETS).alias(c) for c in columns])
    return made.select(day, F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("sketch")) for c in columns])))


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """name, estimate: the distinct values of each column over all days given, from their sketches alone."""
    return sketches.groupBy("name").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
