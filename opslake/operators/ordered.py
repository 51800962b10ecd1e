"""Latest-wins, top-n, distinct-on, paging and running values that survive hot keys.

A plain window over a key sorts all rows of that key in one task. The operators here avoid
that: latest-wins is an aggregate, top-n filters before the shuffle, and running values are
computed per (key, slice) and carried from slice to slice through a small table of totals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The row with the greatest version per key.

    ``version`` lists the version column first and its tie-breakers after it. The aggregate
    keeps one row per key and map task, so a hot key ships few rows.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*version)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str | None = None) -> DataFrame:
    """First ``n`` rows per key; the limit is applied in every map task before the shuffle."""
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.where(F.col(name) <= n)
    return kept if rank else kept.drop(name)


def distinct_on(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in the given total order."""
    return top_per_key(df, keys, order, 1)


def newest(df: DataFrame, time: str, tie: str, limit: int) -> DataFrame:
    """The ``limit`` newest rows, ties settled by the smallest id."""
    return df.orderBy(F.col(time).desc(), F.col(tie)).limit(limit)


def page_by_offset(df: DataFrame, order: list[Column], limit: int, offset: int) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def page_by_cursor(df: DataFrame, key: str, first: int, after=None) -> DataFrame:
    """One page after a cursor, with ``has_next_page``, ``end_cursor`` and ``total_count``.

    An unknown cursor starts over. Only ``first + 1`` rows leave the sort.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    if after is None:
        rest = df
    else:
        # Null where nobody holds the cursor; the comparison is then null too and the page starts over.
        known = df.where(F.col(key) == F.lit(after)).agg(F.max(key)).scalar()
        rest = df.where(F.coalesce(F.col(key) > known, F.lit(True)))
    head = rest.orderBy(key).limit(first + 1)
    shown = head.orderBy(key).limit(first)
    return shown.select(
        *df.columns,
        (head.agg(F.count(F.lit(1))).scalar() > first).alias("has_next_page"),
        shown.agg(F.max(key)).scalar().alias("end_cursor"),
        total.alias("total_count"))


def time_slice(time: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(time) / (seconds * 1_000_000)).cast("long")


def running(df: DataFrame, keys: list[str], order: list[str], slice_by: str,
            measures: dict[str, tuple[str, Column | None]]) -> DataFrame:
    """Running values per key from its first row to the current one.

    ``measures`` maps an output column to (kind, column), kind being ``count``, ``sum``,
    ``max``, ``min`` or ``last`` (last non-null). ``slice_by`` names a column that never falls while ``order`` rises. Each
    (key, slice) is one unit of work, so a hot key spreads over as many tasks as it has slices.
    """
    sliced, inputs = df, {}
    for name, (kind, column) in measures.items():
        inputs[name] = f"_in_{name}"
        sliced = sliced.withColumn(inputs[name], F.lit(1) if kind == "count" else column)

    def total(name, kind):
        col = F.col(inputs[name])
        if kind == "last":
            stamp = F.when(col.isNotNull(), F.struct(*order))
            return F.max_by(col, stamp)
        return {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}[kind](col)

    totals = sliced.groupBy(*keys, slice_by).agg(*[total(n, k).alias(n) for n, (k, _) in measures.items()])
    earlier = Window.partitionBy(*keys).orderBy(slice_by).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(slice_by).alias("_s"),
        *[_over(kind, F.col(n), earlier).alias(f"_before_{n}") for n, (kind, _) in measures.items()])
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col(slice_by).eqNullSafe(F.col("_s"))]
    joined = sliced.join(carried, reduce(lambda a, b: a & b, same))
    here = Window.partitionBy(*keys, slice_by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    result = joined
    for name, (kind, _) in measures.items():
        inside, before = _over(kind, F.col(inputs[name]), here), F.col(f"_before_{name}")
        if kind in ("count", "sum"):
            value = F.coalesce(before, F.lit(0)) + F.coalesce(inside, F.lit(0))
        elif kind == "last":
            value = F.coalesce(inside, before)
        else:
            value = (F.greatest if kind == "max" else F.least)(inside, before)
        result = result.withColumn(name, value)
    return result.select(*df.columns, *measures)


def _over(kind: str, col: Column, window) -> Column:
    if kind == "last":
        return F.last(col, ignorenulls=True).over(window)
    return {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}[kind](col).over(window)
