"""Streams of text lines with their arrival order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Topic of the change log and pattern of the GPS topics.
CHANGE_TOPIC = "veche"
GPS_TOPICS = "(.*)gps_topic"
# Type of the arrival order: a record's millisecond (13 digits), partition (5) and offset (19). Two records never
# share one, and within a partition and millisecond the offset decides. Topics should keep the broker's time
# (``message.timestamp.type=LogAppendTime``); with the producer's, its clock orders the records.
ARRIVAL = "decimal(38,0)"


def read_topics(
    spark: SparkSession,
    pattern: str,
    servers: str,
    starting: str = "latest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Lines of all Kafka topics whose name matches: topic, seq, value.

    Offsets are kept in the checkpoint of the query; ``starting`` only counts for its first run.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", pattern)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", "true")
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return from_kafka(reader.load())


def from_kafka(records: DataFrame) -> DataFrame:
    """Kafka's columns as topic, seq, value."""
    digits = F.concat(
        F.unix_millis("timestamp").cast("string"),
        F.lpad(F.col("partition").cast("string"), 5, "0"),
        F.lpad(F.col("offset").cast("string"), 19, "0"),
    )
    return records.select(
        "topic",
        digits.cast(ARRIVAL).alias("seq"),
        F.col("value").cast("string").alias("value"),
    )


def read_files(
    spark: SparkSession, path: str, schema: str, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Files that arrive in a folder, as a stream."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
