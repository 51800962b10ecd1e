"""Joins in which one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys with more than this share of the rows are looked up without a shuffle; there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 1e-4


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], held: str = "held", share: float = HOT_SHARE) -> DataFrame:
    """Rows whose keys are in ``table``, with its other columns.

    ``table`` is stored, has each key once and counts in ``held`` the rows that have it. Frequent keys are told from all
    others by that count, so their number is bounded whatever the data, and all tasks may share them. Their rows go through
    the second join under salts that meet nothing, so ``rows`` is read once and no key fills a task.
    """
    total = table.agg(F.sum(held)).head()[0] or 0
    hot = F.col(held) > total * share
    values = F.struct(*[c for c in table.columns if c not in (*keys, held)])
    told = rows.join(F.broadcast(table.where(hot).select(*keys, values.alias("_hot"))), keys, "left").withColumn(
        "_salt", F.when(F.col("_hot").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 20)).cast("int")))
    rare = table.where(~hot).select(*keys, F.lit(0).alias("_salt"), values.alias("_rare"))
    found = told.join(rare, [*keys, "_salt"], "left").withColumn("_found", F.coalesce("_hot", "_rare"))
    return found.where(F.col("_found").isNotNull()).select(*rows.columns, "_found.*")


def pairs_by_key(rows: DataFrame, sizes: DataFrame, key: str, apart: Column, most: int = 2_000) -> DataFrame:
    """Pairs of rows with one key, as structs ``l`` and ``r``, for which ``apart`` holds.

    ``sizes`` gives ``held`` rows for each key. A key's left rows are dealt into parts of about ``most`` rows and its right
    rows sent to each part, so that no task takes the square of a frequent key.
    """
    named = lookup(rows, sizes.withColumn("_parts", F.ceil(F.col("held") / most).cast("int")), [key])
    row = F.struct(*rows.columns)
    left = named.select(key, F.pmod(F.xxhash64(*rows.columns), F.col("_parts")).cast("int").alias("_part"), row.alias("l"))
    right = named.select(key, F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"), row.alias("r"))
    return left.join(right, [key, "_part"]).where(apart).select("l", "r")
