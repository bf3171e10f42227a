"""Monitoring snapshots from Spark's own event log: stages, batches and memory at regular times.

A sweep line over what starts and ends: every event of the log becomes a change of a counter at a time, and a
snapshot is the sum of all changes up to its time. Changes are added up per step of the grid first, so that only
one row per step and application is left to be summed in order. The lines of the log are parsed in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hailstat.session import shared_folder

# The events that are read and the parts that are kept.
KINDS = (
    "SparkListenerJobStart", "SparkListenerJobEnd", "SparkListenerStageSubmitted", "SparkListenerStageCompleted",
    "SparkListenerBlockManagerAdded", "SparkListenerBlockManagerRemoved", "QueryProgressEvent",
)
EVENT = (
    "Event string, `Job ID` bigint, `Submission Time` bigint, `Completion Time` bigint, `Stage IDs` array<bigint>, "
    "`Stage Info` struct<`Stage ID`: bigint, `Submission Time`: bigint, `Completion Time`: bigint, `Failure Reason`: string>, "
    "`Block Manager ID` struct<`Executor ID`: string, Host: string, Port: bigint>, `Maximum Memory` bigint, Timestamp bigint, "
    "progress struct<timestamp: string, durationMs: struct<triggerExecution: bigint>>"
)
COUNTERS = (
    "failedStages", "runningStages", "waitingStages", "runningBatches", "waitingBatches", "totalCompletedBatches", "maxMem",
)
STEP_MS = 10_000
MEGABYTE = 1 << 20


def log_events(lines: DataFrame) -> DataFrame:
    """The kept events of log lines (``value``, and ``app`` if there are several applications)."""
    wanted = None
    for kind in KINDS:
        found = F.col("value").contains(kind)
        wanted = found if wanted is None else wanted | found
    app = F.col("app") if "app" in lines.columns else F.lit("")
    return lines.where(wanted).select(app.alias("app"), F.from_json("value", EVENT).alias("e")).select("app", "e.*")


def stored_events(lines: DataFrame) -> DataFrame:
    """The same, written once as columns: a log is far longer as text, and is read once for all counters."""
    events, folder = log_events(lines), shared_folder(lines.sparkSession, "log-events")
    events.write.option("compression", "zstd").parquet(folder)
    return lines.sparkSession.read.schema(events.schema).parquet(folder)


def _is(kind: str) -> Column:
    return F.col("Event").endswith(kind)


def _changes(rows: DataFrame, *changes: tuple[str, Column, Column | int]) -> DataFrame:
    """``app, counter, time, by`` of each row's changes; those without a time are left out."""
    structs = [
        F.struct(F.lit(counter).alias("counter"), time.cast("bigint").alias("time"), F.lit(by).cast("bigint").alias("by"))
        for counter, time, by in changes
    ]
    return rows.select("app", F.inline(F.array(*structs))).where("time IS NOT NULL AND by IS NOT NULL")


def stage_changes(events: DataFrame) -> DataFrame:
    """Running from submission to completion; failed from then on; waiting from the start of the first job that needs a
    stage to its first submission, or, if it is skipped, to the end of its jobs."""
    info = F.col("Stage Info")
    begun = events.where(_is("StageSubmitted")).select("app", info["Stage ID"].alias("stage"), info["Submission Time"].alias("at"))
    ended = events.where(_is("StageCompleted"))
    failed = F.when(info["Failure Reason"].isNotNull(), info["Completion Time"])
    jobs = events.where(_is("JobStart")).select("app", "Job ID", F.col("Submission Time").alias("from"), F.explode("Stage IDs").alias("stage"))
    ends = events.where(_is("JobEnd")).select("app", "Job ID", F.col("Completion Time").alias("to"))
    needed = jobs.join(ends, ["app", "Job ID"], "left").groupBy("app", "stage").agg(
        F.min("from").alias("from"), F.when(F.count("*") == F.count("to"), F.max("to")).alias("to")
    )
    first = begun.groupBy("app", "stage").agg(F.min("at").alias("at"))
    waiting = needed.join(first, ["app", "stage"], "left").withColumn("until", F.coalesce("at", "to"))
    return (
        _changes(begun, ("runningStages", F.col("at"), 1))
        .unionByName(_changes(ended, ("runningStages", info["Completion Time"], -1), ("failedStages", failed, 1)))
        .unionByName(_changes(waiting, ("waitingStages", F.col("from"), 1), ("waitingStages", F.when(F.col("until").isNotNull(), F.greatest("from", "until")), -1)))
    )


def batch_changes(events: DataFrame, interval_ms: int) -> DataFrame:
    """Running from a batch's trigger to its end, completed from then on; a trigger that falls due meanwhile waits."""
    batches = events.where(_is("QueryProgressEvent")).select(
        "app", F.unix_millis(F.try_to_timestamp("progress.timestamp")).alias("from"),
        F.col("progress.durationMs.triggerExecution").alias("took"),
    )
    end, due = F.col("from") + F.col("took"), F.floor(F.col("took") / interval_ms)
    missed = batches.where(due > 0).select("app", end.alias("to"), F.explode(F.sequence(F.lit(1).cast("bigint"), due)).alias("k"), "from")
    return _changes(
        batches, ("runningBatches", F.col("from"), 1), ("runningBatches", end, -1), ("totalCompletedBatches", end, 1)
    ).unionByName(
        _changes(missed, ("waitingBatches", F.col("from") + F.col("k") * interval_ms, 1), ("waitingBatches", F.col("to"), -1))
    )


def memory_changes(events: DataFrame) -> DataFrame:
    """The memory of a block manager from when it was added to when it was removed."""
    manager = F.to_json("Block Manager ID").alias("manager")
    added = events.where(_is("BlockManagerAdded")).select("app", manager, F.col("Timestamp").alias("from"), F.col("Maximum Memory").alias("size"))
    removed = events.where(_is("BlockManagerRemoved")).select("app", manager, F.col("Timestamp").alias("to"))
    both = added.join(removed, ["app", "manager"], "left").where("to IS NULL OR to >= from")
    lives = both.groupBy("app", "manager", "from", "size").agg(F.min("to").alias("to"))
    return _changes(lives, ("maxMem", F.col("from"), F.col("size")), ("maxMem", F.col("to"), -F.col("size")))


def snapshots(lines: DataFrame, step_ms: int = STEP_MS, interval_ms: int = 1000) -> DataFrame:
    """Per application and step, the counters of ``monitor.health_ratios`` at the step's time.

    A snapshot counts what happened up to its time, the end of its step; the first is that of the first event, the
    last that of the last one. The log does not tell how much memory is used: these columns are null.
    """
    events = stored_events(lines)
    changes = stage_changes(events).unionByName(batch_changes(events, interval_ms)).unionByName(memory_changes(events))
    step = F.ceil(F.col("time") / step_ms).cast("bigint")
    counted = changes.groupBy("app", step.alias("step")).agg(
        *(F.sum(F.when(F.col("counter") == c, F.col("by")).otherwise(0)).alias(c) for c in COUNTERS)
    )
    span = counted.groupBy("app").agg(F.sequence(F.min("step"), F.max("step")).alias("steps"))
    grid = span.select("app", F.explode("steps").alias("step"))
    up_to_here = Window.partitionBy("app").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    summed = grid.join(counted, ["app", "step"], "left").select(
        "app", "step", *(F.sum(F.coalesce(c, F.lit(0))).over(up_to_here).alias(c) for c in COUNTERS)
    )
    unknown = F.lit(None).cast("double")
    return summed.select(
        "app", F.timestamp_millis(F.col("step") * step_ms).alias("ts"), *COUNTERS[:-1], (F.col("maxMem") / MEGABYTE).alias("maxMem_MB"),
        unknown.alias("memUsed_MB"), unknown.alias("remainingMem_MB"),
    )
