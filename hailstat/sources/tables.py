"""Declared tables: reading with a fixed schema, typing text columns, upserts and result tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hailstat.functions import keys

# The declared tables, as the typed columns that the reports read.
SCHEMAS = {
    "order": (
        "id string, create_time timestamp, pay_all double, open_lng double, open_lat double, "
        "begin_address_code string, charge_mileage double, city_name string, vehicle_license string, "
        "driver_id string, driver_name string, cancel int, close_gps_time timestamp"
    ),
    "renter": (
        "id string, create_time timestamp, last_login_city string, last_logon_time timestamp, city_name string"
    ),
    "driver": (
        "id string, create_time timestamp, register_city string, driver_name string, mobile string, "
        "driver_type string, cancel_count int, driver_management_id string"
    ),
    "opt_alliance_business": (
        "id_ string, alliance_name string, organization_code string, alliance_role string, linkman string, "
        "contact_number string, create_user string, create_time timestamp, update_user string, "
        "update_time timestamp, state int, del_state int"
    ),
}


def column_types(ddl: str) -> dict[str, str]:
    """Column name to type of a DDL list of simple types."""
    return dict(part.split() for part in ddl.split(","))


def finite(text: Column) -> Column:
    """A text as a number; malformed, not finite and too large become null."""
    number = text.try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def to_type(text: Column, type_: str) -> Column:
    """A text column as the declared type; blank or malformed text becomes null, never an error."""
    if type_ == "double":
        return finite(text)
    if type_ == "string":
        return F.nullif(text, F.lit(""))
    if type_ == "timestamp":
        return F.try_to_timestamp(text)
    return text.try_cast(type_)


def typed(df: DataFrame, ddl: str) -> DataFrame:
    """All-text columns as the declared types."""
    return df.select(*[to_type(F.col(c), t).alias(c) for c, t in column_types(ddl).items()])


def read_table(
    spark: SparkSession, path: str, ddl: str, columns: Sequence[str] | None = None, fmt: str = "parquet"
) -> DataFrame:
    """A stored table with its declared schema, nothing inferred.

    Reads in parallel per file split; only the columns and row groups that a query needs are read.
    """
    df = spark.read.schema(ddl).format(fmt).load(path)
    return df.select(*columns) if columns else df


def latest_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key.

    An aggregate, not a window: rows of one key are folded before the shuffle, so a key that was
    written very often costs no more than any other.
    """
    newest = F.max_by(F.struct(*[F.col(c) for c in rows.columns]), F.struct(*[F.col(c) for c in order]))
    return rows.groupBy(*[F.col(k).alias(f"__{k}") for k in key]).agg(newest.alias("__row")).select("__row.*")


def merge_rows(current: DataFrame, changes: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``current`` with ``changes``, the newest row per key: one union and one fold, each side read once."""
    return latest_per_key(current.select(*changes.columns).unionByName(changes), key, order)


def upsert(
    spark: SparkSession,
    changes: DataFrame,
    path: str,
    key: Sequence[str],
    order: Sequence[str],
    partition: str,
) -> None:
    """Write rows at their key; a second write to a key replaces the first.

    The table is made if absent. It is partitioned by a column that is a function of the key, and
    only the partitions named in ``changes`` are read and replaced. A replay of the same changes
    leaves the table as it is.
    """
    if not table_exists(spark, path):
        write_partitioned(latest_per_key(changes, key, order), path, partition, "dynamic")
        return
    # Read twice below, for the touched partitions and for the rows.
    newest = latest_per_key(changes, key, order).persist()
    try:
        current = read_partitioned(spark, path, newest)
        touched = newest.select(partition).distinct()
        in_touched = current.join(touched, partition, "left_semi").select(*newest.columns)
        write_partitioned(latest_per_key(in_touched.unionByName(newest), key, order), path, partition, "dynamic")
    finally:
        newest.unpersist()


def append_changes(changes: DataFrame, path: str, key: Sequence[str], order: Sequence[str], partition: str, buckets: int = 8) -> None:
    """Adds the newest row per key of ``changes`` to a table that ``read_newest`` folds; nothing stored is touched.

    Files lie by ``partition``, a function of the key, and by a bucket of the key. A write that is killed
    leaves the table as it was or with some of its rows, and repeating it adds what folds to the same.
    """
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
    rows = latest_per_key(changes, key, order).withColumn("bucket", bucket)
    rows.hint("rebalance", F.col(partition), F.col("bucket")).write.mode("append").partitionBy(partition, "bucket").parquet(path)


def read_newest(spark: SparkSession, paths: Sequence[str], like: StructType, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key of tables written by ``append_changes``, with the columns of ``like``."""
    rows = [spark.read.schema(like).parquet(path).select(*like.fieldNames()) for path in paths]
    return latest_per_key(reduce(DataFrame.unionByName, rows), key, order)


def compact_changes(
    spark: SparkSession, paths: Sequence[str], target: str, like: StructType, key: Sequence[str], order: Sequence[str], partition: str
) -> None:
    """Folds tables into a new one; readers move to it when it is finished, and the old ones can go then."""
    append_changes(read_newest(spark, paths, like, key, order), target, key, order, partition)


def write_partitioned(df: DataFrame, path: str, partition: str, overwrite: str) -> None:
    """Replace all partitions (``static``) or only those of ``df`` (``dynamic``).

    Rows are rebalanced by the partition column first: one or a few files per partition in place of
    one per task, and a very large partition is split over several tasks.
    """
    balanced = df.hint("rebalance", F.col(partition))
    writer = balanced.write.mode("overwrite").option("partitionOverwriteMode", overwrite)
    writer.partitionBy(partition).parquet(path)


def read_partitioned(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A table written by ``upsert``, with the column types of ``like``."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def save_result(df: DataFrame, path: str, row_key: str, fields: Sequence[str]) -> None:
    """Replace a result table by the named fields, one row per row key, all as text."""
    chosen = df.select(*[F.col(c).cast("string").alias(c) for c in fields])
    chosen.dropDuplicates([row_key]).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).parquet(path)


def save_stations(stations: DataFrame, path: str) -> None:
    """Stations with their trip count and district, one per order id, partitioned by city."""
    columns = ["order_id", "city_id", "starting_lng", "starting_lat", "trip_count", "district_name"]
    one = latest_per_key(stations.select(*columns), ["order_id"], ["district_name"])
    write_partitioned(one, path, "city_id", "static")


def filter_and_save(table: DataFrame, condition: Column, path: str, row_key: str) -> None:
    """Rows of a table that meet a condition, as a result table."""
    save_result(table.where(condition), path, row_key, table.columns)


def presplit(df: DataFrame, key: Column, regions: int = keys.REGIONS, splits: int = 1) -> DataFrame:
    """Rows placed by the region of their key: region ``r`` is task ``r``, and no task has rows of two.

    One task per region cannot hold a large table, so each region may be cut into ``splits`` tasks, from
    ``r * splits`` on, by what the region leaves of the hash.
    """
    def task(text: Column, number: Column) -> Column:
        rest = F.floor(number.bitwiseAND(F.lit(0x7FFFFFFF)) / regions) % splits
        return (keys.region_of(number, regions) * splits + rest).cast("int").alias("__task")

    placed = keys.with_hash(df, key, lambda text, number: keys.region_of(number, regions).alias("region"), task)
    return placed.repartitionById(regions * splits, F.col("__task")).drop("__task")


def placement(placed: DataFrame) -> DataFrame:
    """Rows per task and region, as they lie."""
    return placed.groupBy(F.spark_partition_id().alias("task"), "region").agg(F.count("*").alias("num_rows"))


def region_load(df: DataFrame, key: Column, regions: int = keys.REGIONS) -> DataFrame:
    """Rows and distinct keys per region, to see how evenly the split keys spread a table."""
    per_key = df.groupBy(key.alias("key")).agg(F.count("*").alias("n"))
    placed = keys.with_hash(per_key, F.col("key"), lambda text, number: keys.region_of(number, regions).alias("region"))
    return placed.groupBy("region").agg(
        F.sum("n").alias("num_rows"), F.count("*").alias("num_keys")
    )
