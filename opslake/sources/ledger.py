"""A mart fed by new source files only: a ledger of processed files and partial aggregates that add up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "path string, size bigint, modified timestamp, run bigint"


def source_files(spark: SparkSession, root: str) -> DataFrame:
    """path, size, modified of the files below a folder; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def has_files(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


class Ledger:
    """Which files of a folder have been taken into account, and by which run.

    A run writes its partial aggregates under its number first and its files into the ledger last, both as partitions that a
    repeat overwrites. A run that fails in between is repeated with the same number, so nothing counts twice.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.files, self.parts = spark, f"{root}/files", f"{root}/parts"

    def known(self) -> DataFrame:
        if has_files(self.spark, self.files):
            return self.spark.read.schema(LEDGER).parquet(self.files)
        return self.spark.createDataFrame([], LEDGER)

    def take(self, source: str, read: Callable[[list[str]], DataFrame], build: Callable[[DataFrame], DataFrame]) -> list[str]:
        """Aggregate the files that are new or changed in size since the last run; gives their paths.

        ``build`` makes partial aggregates, which :meth:`total` adds up later.
        """
        known = self.known()
        new = source_files(self.spark, source).join(known.select("path", "size"), ["path", "size"], "left_anti")
        rows = new.orderBy("path").collect()
        if not rows:
            return []
        run = (known.agg(F.max("run")).head()[0] or 0) + 1
        paths = [r.path for r in rows]
        build(read(paths)).withColumn("run", F.lit(run)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("run").parquet(self.parts)
        self.spark.createDataFrame([(*r, run) for r in rows], LEDGER).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("run").parquet(self.files)
        return paths

    def total(self, schema: str, keys: list[str], sums: dict[str, Column]) -> DataFrame:
        """The mart: the partial aggregates of all finished runs, added up by key."""
        parts = self.spark.read.schema(f"{schema}, run bigint").parquet(self.parts)
        # A run that wrote its parts and failed before its ledger entry does not count.
        done = self.known().select("run").distinct()
        return parts.join(done, "run", "left_semi").groupBy(*keys).agg(*[value.alias(name) for name, value in sums.items()])
