"""Readers of files and tables, each with a declared schema."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake import schemas

# Columns of the listing response that are not kept.
API_DROPPED = ["rowNum", "citation", "effectDate", "registerCode", "registerDate", "htmlPath", "fields", "relation",
               "classCodes"]


def parse_telemetry(lines: DataFrame, as_of: str | None = None) -> DataFrame:
    """Telemetry rows from a ``value`` column with JSON messages; a batch or a stream.

    A message that is no valid JSON object, or lacks its key or a readable time, is flagged in
    ``malformed`` and keeps its raw text.
    """
    message = F.from_json(F.col("value").cast("string"), schemas.TELEMETRY_MESSAGE).alias("m")
    parsed = lines.select(F.col("value").cast("string").alias("raw"), message)
    at = F.try_to_timestamp("m.timestamp")
    columns = [at.alias("event_time") if c == "event_time" else F.col(f"m.{c}") for c in schemas.TELEMETRY_COLUMNS]
    stamp = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    return parsed.select(*columns, stamp.alias("ingested_at"), "raw").withColumn(
        "malformed", F.col("event_id").isNull() | F.col("event_time").isNull())


def tolerant_parse(lines: DataFrame, as_of: str | None = None) -> DataFrame:
    return parse_telemetry(lines, as_of).where(~F.col("malformed")).drop("raw", "malformed")


def telemetry_json(telemetry: DataFrame) -> DataFrame:
    """One JSON message per reading, the shape in which telemetry travels."""
    time = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp")
    fields = [time if c == "event_time" else F.col(c) for c in schemas.TELEMETRY_COLUMNS]
    return telemetry.select(F.to_json(F.struct(*fields)).alias("value"))


def read_devices_csv(spark: SparkSession, path: str, updated_at: str) -> DataFrame:
    declared = schemas.DEVICES.replace(", updated_at timestamp", "")
    return spark.read.schema(declared).option("header", True).csv(path).withColumn(
        "updated_at", F.lit(updated_at).cast("timestamp"))


def read_history(spark: SparkSession, path: str, as_of: str) -> DataFrame | None:
    """Historical telemetry with string times; None where the path does not exist."""
    stored = schemas.TELEMETRY_MESSAGE
    try:
        rows = spark.read.schema(stored).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return rows.select(*[
        F.try_to_timestamp("timestamp").alias("event_time") if c == "event_time" else F.col(c)
        for c in schemas.TELEMETRY_COLUMNS], F.lit(as_of).cast("timestamp").alias("ingested_at"))


def read_manuals(spark: SparkSession, path: str) -> DataFrame:
    """Manuals from JSON arrays. Content falls back to text; a missing id becomes a hash of the manual."""
    raw = spark.read.schema(schemas.MANUALS).option("multiLine", True).json(path)
    made = F.left(F.sha2(F.concat_ws("|", "title", "content", "text"), 256), F.lit(32))
    return raw.select(
        F.coalesce("id", made).alias("id"), F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("content", "text", F.lit("")).alias("content"), "device_id", "severity")


def read_table_jdbc(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int,
                    partitions: int) -> DataFrame:
    """A relational table read by ranges of one column. Needs the database's driver on the class path."""
    return spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=column, lowerBound=lower, upperBound=upper,
        numPartitions=partitions).load()


def compact(spark: SparkSession, parts: list[tuple[str, str]], schema: str, target: str, files: int) -> DataFrame:
    """Many small files of several formats as one table of ``files`` files, in numeric file order.

    ``parts`` lists (format, path or pattern). The number in a file's name gives its place.
    """
    def load(kind: str, path: str) -> DataFrame:
        reader = spark.read.schema(schema).format(kind)
        return (reader.option("header", True) if kind == "csv" else reader).load(path).withColumn(
            "file_no", file_number(F.col("_metadata.file_name")))

    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [load(k, p) for k, p in parts])
    stacked.repartitionByRange(files, "file_no").sortWithinPartitions("file_no").write.mode("overwrite").parquet(target)
    return spark.read.schema(f"{schema}, file_no bigint").parquet(target)


def file_number(name: Column) -> Column:
    return F.regexp_extract(name, r"(\d+)", 1).try_cast("bigint")


def read_text_tree(spark: SparkSession, root: str, pattern: str = "*.{md,txt}") -> DataFrame:
    """(source, text) of every text file below a folder, the source relative to it."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    base = system.makeQualified(place).toUri().getPath().rstrip("/")
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    inside = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return files.select(F.substr(inside, F.lit(len(base) + 2)).alias("source"), F.col("value").alias("text"))


def flatten_api(responses: DataFrame) -> DataFrame:
    """Rows of the ``data`` list of search-API responses in column ``body``."""
    items = F.from_json("body", schemas.API_RESPONSE)["data"]
    rows = responses.select(F.inline(items))
    return rows.drop(*API_DROPPED)


def skip_done(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose id has no stored result yet."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def prune_empty(documents: DataFrame, rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Documents that yielded rows, and those that yielded none."""
    filled = rows.select(key).distinct()
    return documents.join(filled, key, "left_semi"), documents.join(filled, key, "left_anti")


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Name, size and extension of the files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", pattern).load(root)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name.alias("name"), F.col("length").alias("size"),
                        F.lower(F.element_at(F.split(name, r"\."), -1)).alias("extension"))


def expected_files(found: DataFrame, names: list[str]) -> DataFrame:
    """Whether each expected file is there. Missing files are reported, not raised."""
    spark = found.sparkSession
    wanted = spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("name"))
    there = found.select("name").distinct().withColumn("present", F.lit(True))
    return wanted.join(there, "name", "left").withColumn("present", F.coalesce("present", F.lit(False)))
