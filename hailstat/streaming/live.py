"""Live state of orders as a stateful stream: spans, running orders and hour counts, bounded by a horizon.

The state store is that of Spark's streaming aggregation: one row per order and span of one horizon (event time of
the points), the fold of its points. Points are folded before they are shuffled, so that an order with very many of
them costs a row per task. A batch gives out the folds that it changed; a span leaves the store once the watermark,
the newest point less the horizon, has passed its end. An end mark has no time, needs no state and is given out as it is.

What is given out goes to folders of one generation, a folder per batch. The first batch of a generation folds the
one before: its open orders begin the new generation, its closed ones go to a history of their own, and their hours
are added to the counts so far. So a reader of what runs now opens the folders of one generation, however long the
stream has run. Which batches are finished is read from the checkpoint of the stream: readers never see half of one,
and a batch that is repeated after a failure writes the same folders again.

An order is closed if its last point is older than the newest point of all by more than the horizon. The order that
has the newest point is open, so each generation holds it. An order with end marks alone is heard of when the newest
point of its batch is.

States fold by minimum and maximum, so the order of files does not matter within the horizon. Points older than
the horizon are late once their span has left the state store: they are left out, and the point store still has them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hailstat.operators import tracks
from hailstat.sources import lines as parse
from hailstat.streaming.jobs import STATE_SCHEMA, start

# Behind the last arrival of an order stands when it was heard of, where only end marks tell of it.
LIVE_SCHEMA = f"{STATE_SCHEMA[:-1]}, heard: bigint>, closed boolean"
PARTS = ("start", "finish", "first_seen", "last_seen")


def _last_seen(lng: Column, lat: Column) -> Column:
    return F.struct("seq", "is_end", lng.alias("lng"), lat.alias("lat"), F.lit(None).cast("bigint").alias("heard"))


def live_states(events: DataFrame, horizon: str) -> DataFrame:
    """A stream of the states that changed, per order and span of one horizon, and of the end marks."""
    events = events.withColumn("seq", F.col("seq").cast("decimal(38,0)"))
    position = (F.col("lng"), F.col("lat"))
    points = events.where(~F.col("is_end")).withColumn("seen", F.timestamp_seconds("ts")).withWatermark("seen", horizon)
    folded = points.groupBy("order_id", F.window("seen", horizon)).agg(
        F.min(F.struct("ts", "seq", *position)).alias("start"),
        F.max(F.struct("ts", (-F.col("seq")).alias("back"), *position)).alias("finish"),
        F.min(F.struct("seq", "ts")).alias("first_seen"),
        F.max(_last_seen(*position)).alias("last_seen"),
    )
    nothing = F.lit(None).cast("double")
    ends = events.where("is_end").select("order_id", _last_seen(nothing, nothing).alias("last_seen"))
    return folded.select("order_id", *PARTS).unionByName(ends, allowMissingColumns=True)


@dataclass(frozen=True)
class LiveOrders:
    """The stream's tables below ``root``; readers and writer must agree on ``every``, the batches of a generation."""

    root: str
    checkpoint: str
    horizon: str = "1 day"
    every: int = 64

    def start(self, lines: DataFrame, once: bool = False) -> StreamingQuery:
        """GPS lines (seq, value) into live states."""
        return start(live_states(parse.parse_gps_events(lines), self.horizon), self._write, self.checkpoint, once, "live", "update")

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        generation = batch_id // self.every
        batch = batch.persist()
        try:
            newest = batch.agg(F.max("finish.ts")).first()[0]
            rows = batch.withColumn("last_seen", _heard(F.lit(newest))).withColumn("closed", F.lit(False))
            if batch_id % self.every or not generation:
                self._put(rows, f"live/generation={generation}/batch={batch_id}")
                return
            earlier = self._rows(batch.sparkSession, f"live/generation={generation - 1}").drop("batch")
            whole = self._folded(earlier.unionByName(rows)).persist()
            try:
                closed = whole.where("closed")
                self._put(closed, f"closed/generation={generation}")
                counts = tracks.hour_counts_of(closed)
                if generation > 1:
                    before = batch.sparkSession.read.parquet(f"{self.root}/hours/generation={generation - 1}")
                    counts = _summed(before.unionByName(counts))
                self._put(counts.coalesce(1), f"hours/generation={generation}")
                self._put(whole.where("not closed"), f"live/generation={generation}/batch={batch_id}")
            finally:
                whole.unpersist()
        finally:
            batch.unpersist()

    def _put(self, rows: DataFrame, folder: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.root}/{folder}")

    def _rows(self, spark: SparkSession, folder: str) -> DataFrame:
        schema = f"{LIVE_SCHEMA}, batch long"
        return spark.read.schema(schema).option("basePath", f"{self.root}/{folder}").parquet(f"{self.root}/{folder}")

    def _folded(self, rows: DataFrame) -> DataFrame:
        """One state per order of a generation; closed if the newest point is a horizon and more ahead of it."""
        newest = F.lit(rows.agg(F.max("finish.ts")).first()[0]).cast("bigint")
        merged = tracks.merge_states(rows).withColumn("last_seen", _heard(newest))
        seen = F.greatest("finish.ts", "last_seen.heard")
        silent = F.timestamp_seconds(seen) < F.timestamp_seconds(newest) - F.expr(f"INTERVAL '{self.horizon}'")
        return merged.withColumn("closed", F.coalesce(silent, F.lit(False)))

    def last_batch(self, spark: SparkSession) -> int | None:
        """The last finished batch, as the stream's checkpoint has it."""
        names = spark.read.text(f"{self.checkpoint}/commits").select(F.col("_metadata.file_name").alias("name"))
        return names.agg(F.max(F.col("name").try_cast("long"))).first()[0]

    def states(self, spark: SparkSession) -> DataFrame:
        """The states of the open orders; reads the folders of the current generation alone."""
        last = self.last_batch(spark)
        if last is None:
            return spark.createDataFrame([], STATE_SCHEMA)
        rows = self._rows(spark, f"live/generation={last // self.every}").where(F.col("batch") <= last)
        return self._folded(rows.drop("batch")).where("not closed").drop("closed")

    def _all_of_generation(self, spark: SparkSession, last: int) -> DataFrame:
        rows = self._rows(spark, f"live/generation={last // self.every}").where(F.col("batch") <= last)
        return self._folded(rows.drop("batch")).drop("closed")

    def live(self, spark: SparkSession) -> DataFrame:
        """Running orders: heard of within the horizon, and their last arrival is a point."""
        return tracks.live_of(self.states(spark))

    def spans(self, spark: SparkSession) -> DataFrame:
        """First and last time and position of every order, open or closed."""
        last = self.last_batch(spark)
        if last is None:
            return tracks.span_of(spark.createDataFrame([], STATE_SCHEMA))
        states = self._all_of_generation(spark, last).select("order_id", *PARTS)
        generation = last // self.every
        if generation:
            closed = spark.read.schema(f"{LIVE_SCHEMA}, generation long").parquet(f"{self.root}/closed")
            states = tracks.merge_states(states.unionByName(closed.where(F.col("generation") <= generation).select("order_id", *PARTS)))
        return tracks.span_of(states)

    def hours(self, spark: SparkSession) -> DataFrame:
        """Orders per day and hour: the counts of closed ones so far and those of the current generation."""
        last = self.last_batch(spark)
        if last is None:
            return tracks.hour_counts_of(spark.createDataFrame([], STATE_SCHEMA))
        counts = tracks.hour_counts_of(self._all_of_generation(spark, last))
        generation = last // self.every
        if not generation:
            return counts
        return _summed(counts.unionByName(spark.read.parquet(f"{self.root}/hours/generation={generation}")))


def _heard(newest: Column) -> Column:
    """The last arrival, with ``newest`` as the time it was heard of if it is an end mark that has none yet."""
    last = F.col("last_seen")
    return F.when(last["is_end"], last.withField("heard", F.coalesce(last["heard"], newest))).otherwise(last)


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("day", "hour").agg(F.sum("order_count").alias("order_count"))
