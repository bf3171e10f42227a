"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hailstat.session import shared_folder


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Writes ``df`` below ``spark.checkpoint.dir`` and reads it again; cuts lineage for good."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Bytes of a batch of rows that Spark hands to Python, which both sides hold at once for every running task.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a folder; batches for Python are bounded for the session as they are nowhere else."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame, *more: str) -> DataFrame:
    """Identity and text only, so that other columns, whatever their names, are never read."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def placed(df: DataFrame, *more: str) -> DataFrame:
    """``documents`` with ``place``, a hash of the text: rows with the same doc_id or none are told apart by it."""
    return documents(df, *more).withColumn("place", F.xxhash64("text"))


def join_rows(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joins tables of ``placed`` rows that mean the same text under the same doc_id, or under none."""
    other = right.withColumnsRenamed({"doc_id": "__doc_id", "place": "__place"})
    met = (F.col("place") == F.col("__place")) & F.col("doc_id").eqNullSafe(F.col("__doc_id"))
    return left.join(other, met, how).drop("__doc_id", "__place")


SOME = 128


def running_sums(name: str) -> Column:
    """The sums of the first, the first two, ... numbers of an array column, in time well below its square.

    An array that grows by one element at a time is copied each time, so it is made of blocks. It must be a
    column and no expression, which would be evaluated anew for every block.
    """
    values, zero = F.col(name), F.lit(0).cast("bigint")
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / SOME).cast("int")), lambda b: F.slice(values, b * SOME + 1, F.lit(SOME))
    )

    def grown(start: Column, numbers: Column) -> Column:
        return F.aggregate(numbers, F.array(start), lambda out, v: F.concat(out, F.array(F.element_at(out, -1) + v)))

    before = grown(zero, F.transform(blocks, lambda x: F.aggregate(x, zero, lambda a, b: a + b)))
    sums = F.zip_with(blocks, before, lambda x, start: F.slice(grown(start, x), F.lit(2), F.size(x)))
    return F.when(F.size(values) > 0, F.flatten(F.filter(sums, lambda x: x.isNotNull()))).otherwise(F.array().cast("array<bigint>"))


def once(name: str, value: Column) -> Column:
    """A generator of one row with ``value`` as a column, which no later step repeats or moves."""
    return F.inline(F.array(F.struct(value.alias(name))))
