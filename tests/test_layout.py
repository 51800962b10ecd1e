"""Clustered files, the file ledger and stored sketches."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from opslake.operators import sketches
from opslake.sources import tables
from opslake.sources.ledger import Ledger


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(40_000).select(
        F.col("id"), F.concat(F.lit("DEV-"), F.lpad((F.xxhash64("id") % 500 + 500).cast("string"), 4, "0")).alias("device_id"),
        F.timestamp_seconds(1_704_067_200 + F.col("id") * 4).alias("event_time")).cache()


def test_a_filter_on_device_or_hour_skips_files(spark, rows, tmp_path):
    path = str(tmp_path / "clustered")
    tables.write_clustered(rows, path, "event_time", "device_id", rows_per_file=1_000)
    assert spark.read.parquet(path).count() == rows.count()
    stats = []
    for name in glob.glob(f"{path}/dt=2024-01-01/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        index = {meta.row_group(0).column(c).path_in_schema: c for c in range(meta.num_columns)}
        groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
        device = [g.column(index["device_id"]).statistics for g in groups]
        number = [g.column(index["id"]).statistics for g in groups]
        stats.append((min(s.min for s in device), max(s.max for s in device), min(s.min for s in number), max(s.max for s in number)))
    assert len(stats) > 10
    # Ids rise with the time: hours 6 and 7 of the first day are ids 5,400 to 7,200.
    assert sum(low <= "DEV-0300" <= high for low, high, _, _ in stats) <= len(stats) / 2
    assert sum(low < 7_200 and high >= 5_400 for _, _, low, high in stats) <= len(stats) / 2


def test_days_take_files_by_their_rows(spark, rows, tmp_path):
    path = str(tmp_path / "uneven")
    uneven = rows.where("id < 21600 OR id % 20 = 0")
    tables.write_clustered(uneven, path, "event_time", "device_id", rows_per_file=2_000)
    first, second = (len(glob.glob(f"{path}/dt=2024-01-0{d}/*.parquet")) for d in (1, 2))
    assert first >= 8 and second <= 3


def test_ledger_reads_new_files_once_and_survives_a_failed_run(spark, rows, tmp_path):
    source, ledger, read_paths = str(tmp_path / "source"), Ledger(spark, str(tmp_path / "mart")), []

    def read(paths):
        read_paths.append(paths)
        return spark.read.schema("id bigint, device_id string, event_time timestamp").parquet(*paths)

    def build(new):
        return new.groupBy("device_id").agg(F.count(F.lit(1)).alias("n"))

    def total():
        return {r.device_id: r.n for r in ledger.total("device_id string, n bigint", ["device_id"], {"n": F.sum("n")}).collect()}

    def exact(condition):
        return {r.device_id: r.n for r in build(rows.where(condition)).collect()}

    tables.append(rows.where("id % 4 = 0"), source)
    assert ledger.take(source, read, build) and total() == exact("id % 4 = 0")
    assert ledger.take(source, read, build) == []
    tables.append(rows.where("id % 4 = 1"), source)

    class Broken(Exception):
        pass

    written = ledger.files
    ledger.files = "/dev/null/nowhere"  # the run writes its parts and cannot write its ledger entry
    with pytest.raises(Exception):
        ledger.known = lambda: spark.read.schema("path string, size bigint, modified timestamp, run bigint").parquet(written)
        ledger.take(source, read, build)
    del ledger.known
    ledger.files = written
    assert total() == exact("id % 4 = 0")
    taken = ledger.take(source, read, build)
    assert total() == exact("id % 4 < 2") and set(read_paths[-1]) == set(taken)
    assert not set(taken) & set(read_paths[0])


def test_united_sketches_equal_one_sketch(spark, rows):
    daily = sketches.daily_sketches(rows.withColumn("dt", F.to_date("event_time")), "dt", ["device_id", "id"])
    got = {r.name: r.estimate for r in sketches.distinct_estimates(daily).collect()}
    exact = rows.agg(F.count_distinct("device_id"), F.count_distinct("id")).first()
    for name, n in zip(("device_id", "id"), exact):
        assert abs(got[name] - n) <= 3 * sketches.STANDARD_ERROR * n + 1
    assert daily.count() == 2 * rows.select(F.to_date("event_time")).distinct().count()
