"""Writers: append, partition replacement, daily layout, serving and dimension loads."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def append(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Append to a lake table. With a table catalog, pass its name to :func:`append_table` instead."""
    df.write.format(fmt).mode("append").partitionBy(*(partition_by or [])).save(path)


def append_table(df: DataFrame, table: str) -> None:
    df.writeTo(table).append()


def replace_partitions(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet") -> None:
    """Replace only the partitions present in ``df``."""
    df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *partition_by).save(path)


def write_daily(df: DataFrame, path: str, time: str, cluster_by: list[str], files_per_day: int = 8,
                max_rows_per_file: int = 20_000_000, mode: str = "append") -> None:
    """Partition by day of event time, rows sorted within files by ``cluster_by``.

    A day is spread over several files by a hash of the sort key and the time, so neither a busy
    day nor a busy device ends in one task.
    """
    spread = F.pmod(F.xxhash64(*cluster_by, time), F.lit(files_per_day))
    daily = df.withColumn("dt", F.to_date(time)).withColumn("_f", spread)
    laid = daily.repartition("dt", "_f").sortWithinPartitions("dt", *cluster_by, time).drop("_f")
    laid.write.mode(mode).option("partitionOverwriteMode", "dynamic").option(
        "maxRecordsPerFile", max_rows_per_file).partitionBy("dt").parquet(path)


def interleaved(keys: list[Column], bits: int = 16) -> Column:
    """Place on a space-filling curve: the bits of the keys in turn, the first key's bit before the second's.

    Keys are whole numbers from 0 to 2**bits - 1. Rows that are near on the curve are near in every key.
    """
    place = F.lit(0).cast("bigint")
    for bit in range(bits - 1, -1, -1):
        for key in keys:
            place = place * 2 + F.shiftright(key, bit).bitwiseAND(F.lit(1))
    return place


def write_clustered(df: DataFrame, path: str, time: str, key: str, rows_per_file: int = 5_000_000, mode: str = "append") -> None:
    """Partition by day; within a day files follow a curve over ``key`` and the time of day, so that a filter on either
    skips files by their statistics.

    Ranges of (day, curve) are sampled by Spark, so a day takes files by its rows, and a busy key is cut by time. A key's
    place is that among up to 127 sampled keys, in the key's own order, as file statistics are minima and maxima.
    """
    files = max(1, -(-df.count() // rows_per_file))
    sample = df.select(F.col(key).alias("k")).where("k IS NOT NULL").distinct().orderBy(F.xxhash64("k")).limit(127)
    borders = F.array(*[F.lit(r.k) for r in sample.orderBy("k").collect()])
    rank = F.coalesce(F.size(F.filter(borders, lambda b: b < F.col(key))), F.lit(0))
    part_of_day = F.floor((F.unix_seconds(time) % 86_400) * 128 / 86_400)
    curve = interleaved([rank.cast("bigint"), part_of_day.cast("bigint")], 7)
    laid = df.withColumn("dt", F.to_date(time)).withColumn("_z", curve).repartitionByRange(
        files, "dt", "_z").sortWithinPartitions("dt", "_z", key, time).drop("_z")
    laid.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path)


def write_json_daily(df: DataFrame, path: str, time: str, mode: str = "append") -> None:
    df.withColumn("dt", F.date_format(time, "yyyy-MM-dd")).write.mode(mode).partitionBy("dt").json(path)


def load_serving(df: DataFrame, target: str, table: str | None = None, properties: dict | None = None) -> None:
    """Load into the serving store from the executors: JDBC for a ``jdbc:`` target, else Parquet."""
    if target.startswith("jdbc:"):
        df.write.jdbc(target, table, mode="append", properties=properties or {})
    else:
        df.write.mode("append").parquet(target)


def truncate_and_load(df: DataFrame, target: str, table: str | None = None, properties: dict | None = None) -> None:
    """Replace a whole dimension, keeping the target table's definition."""
    if target.startswith("jdbc:"):
        df.write.option("truncate", True).jdbc(target, table, mode="overwrite", properties=properties or {})
    else:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target)


def write_session_archive(documents: DataFrame, path: str, shares: int = 16) -> None:
    """One JSON line per session, spread over folders by a hash of the session."""
    share = F.pmod(F.xxhash64("session_id"), F.lit(shares))
    documents.withColumn("share", share).select("document", "share").write.mode("overwrite").partitionBy(
        "share").text(path)


def rebuild_days(source: DataFrame, changed_days: DataFrame, build, path: str, time: str) -> None:
    """Recompute the mart partitions of changed days only.

    ``changed_days`` has one column ``dt``, a short list of days; they become a filter on ``time`` that reaches the source's
    files. ``build`` turns source rows into mart rows with ``dt``. A changed day without rows loses its partition.
    """
    days = sorted(r.dt for r in changed_days.select(F.to_date("dt").alias("dt")).where("dt IS NOT NULL").distinct().collect())
    if not days:
        return
    day = F.col(time).cast("date")
    first, after = F.lit(days[0]).cast("timestamp"), F.lit(days[-1] + timedelta(days=1)).cast("timestamp")
    touched = source.where((F.col(time) >= first) & (F.col(time) < after) & day.isin(days))
    built = build(touched)
    replace_partitions(built, path, ["dt"])
    filled = {str(r.dt) for r in built.select("dt").distinct().collect()}
    spark = source.sparkSession
    for gone in (d for d in days if str(d) not in filled):
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/dt={gone}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
