"""Telemetry, device, alert and corpus views over the given tables.

Every view is a lazy projection of a Parquet scan, so filters and column selections of the
operators above reach the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake import schemas
from opslake.operators import scoring

AS_OF = "2024-01-31 00:00:00"


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read with its declared schema."""
    return spark.read.schema(schemas.TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, event = F.col("user_id"), F.col("event_id")
    types = ["CNC_Mill", "Hydraulic_Press", "Conveyor", "Compressor", "Welding_Robot"]
    zones = ["Zone_A", "Zone_B", "Zone_C", "Zone_D"]
    return table(spark, sf_dir, "events").select(
        event,
        device_id(user).alias("device_id"),
        pick(types, user).alias("device_type"),
        pick(zones, user).alias("location"),
        F.col("ts").alias("event_time"),
        (F.lit(60) + F.col("value") * 0.3).alias("temperature"),
        ((event * 7919 % 1000) / 250.0).alias("vibration"),
        (F.lit(40) + (event * 104729 % 2300) / 10.0).alias("pressure"),
        (F.lit(30.0) + event % 21).alias("humidity"),
        (F.lit(10) + (event * 15485863 % 900) / 10.0).alias("power_usage"),
        (F.lit(500.0) + event % 2500).alias("rpm"),
        F.when(F.col("event_type") == "error", "ERR_OVERHEAT").alias("error_code"),
    )


def device_id(user: Column) -> Column:
    text = user.cast("string")
    return F.concat(F.lit("DEV-"), F.when(F.length(text) < 4, F.lpad(text, 4, "0")).otherwise(text))


def pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of every device, so that latest-wins has something to decide."""
    user = F.col("user_id")
    return (
        table(spark, sf_dir, "events").select("user_id").distinct()
        .withColumn("version", F.explode(F.array(F.lit(1), F.lit(2))))
        .select(
            device_id(user).alias("device_id"),
            pick(["CNC_Mill", "Hydraulic_Press", "Conveyor", "Compressor", "Welding_Robot"], user).alias("device_type"),
            pick(["Maker_A", "Maker_B", "Maker_C"], user).alias("manufacturer"),
            F.concat(F.lit("M-"), (user % 7).cast("string")).alias("model"),
            F.date_add(F.lit("2020-01-01").cast("date"), (user % 365).cast("int")).alias("install_date"),
            pick(["Zone_A", "Zone_B", "Zone_C", "Zone_D"], user).alias("location"),
            F.concat(F.lit("Z"), (user % 4).cast("string")).alias("zone"),
            F.element_at(F.array(*[F.lit(v) for v in (30, 60, 90, 180)]), (user % 4 + 1).cast("int"))
            .alias("maintenance_interval_days"),
            F.date_sub(F.lit("2024-01-31").cast("date"), (user * 13 % 200).cast("int")).alias("last_maintenance_date"),
            F.when(F.col("version") == 1, "active")
            .when(user % 6 == 4, "maintenance").when(user % 6 == 5, "decommissioned").otherwise("active").alias("status"),
            F.when(F.col("version") == 1, moment("2024-01-01 00:00:00"))
            .otherwise(moment("2024-01-15 00:00:00")).alias("updated_at"),
        )
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_telemetry(telemetry(spark, sf_dir), AS_OF)


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of the scored telemetry; every third one has been resolved."""
    built = scoring.build_alerts(scored(spark, sf_dir), AS_OF, keep=["event_id"])
    return built.withColumn("resolved", F.when(F.col("event_id") % 3 == 0, 1).otherwise(0)).drop("event_id")


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    return table(spark, sf_dir, "events").where("event_type = 'error'").select(
        event.alias("incident_id"),
        device_id(F.col("user_id")).alias("device_id"),
        F.concat(F.lit("Incident "), event.cast("string")).alias("title"),
        F.col("props").alias("description"),
        F.when(event % 2 == 1, "Replaced part").alias("resolution"),
        pick(["low", "medium", "high", "critical"], event).alias("severity"),
        F.col("ts").alias("created_at"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One service request per event, for latency, quota and release operators."""
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        event.alias("request_id"),
        F.col("ts"),
        F.col("user_id").cast("string").alias("user"),
        F.element_at(F.array(F.lit("blue"), F.lit("green")), (F.col("user_id") % 2 + 1).cast("int")).alias("slot"),
        (event - event % 2).alias("prompt_id"),
        F.when(event % 2 == 0, "a").otherwise("b").alias("backend"),
        (F.col("value") * 10).alias("latency_ms"),
        (F.col("event_type") == "error").alias("failed"),
        F.when(F.col("event_type").isin("view", "click"), "GET").otherwise("POST").alias("method"),
        F.concat(F.lit("/api/"), F.col("event_type")).alias("endpoint"),
        F.when(F.col("event_type") == "error", "500").otherwise("200").alias("status"),
        (event % 50 + 1).alias("tokens_in"),
        (event % 20 + 1).alias("tokens_out"),
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url"),
        F.col("lang").alias("type"),
        F.col("source").alias("name"),
        "text",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    seconds = F.col("conv_id") * 3600 + F.col("turn") * 60
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("session_id"),
        "conv_id", "turn", "role", F.col("text").alias("content"),
        F.timestamp_seconds(F.unix_seconds(start) + seconds).alias("created_at"),
    )


def search_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search strings: the whole text of every benchmark item."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twentieth vector is a query; all vectors are searched."""
    return table(spark, sf_dir, "embeddings").where("vec_id % 20 = 0").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vector for every benchmark item: the one with the item's number."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


def corpus_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("label").alias("collection"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation runs of twenty models, each with a blue and a green release."""
    event, user = F.col("event_id"), F.col("user_id")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("model-"), (user % 20).cast("string")).alias("model"),
        F.when(event % 2 == 0, "blue").otherwise("green").alias("slot"),
        (event - event % 2).alias("input_id"), "ts",
        (F.col("value") * 4).alias("latency_ms"),
        (F.lit(0.65) + (user % 7) * 0.03 + (event % 10) / 100.0 + (event % 2) * 0.03).alias("quality"),
        (event % 10 != 0).alias("consistent"),
        ((event * 31 + user) % 40 == 0).alias("failed"),
    )
