"""Metrics of the platform's own jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The mark of a task-end line of Spark's event log, and the parts that are kept.
TASK_END_MARK = r'"Event"\s*:\s*"SparkListenerTaskEnd"'
TASK_END = (
    "`Task Info` struct<`Task ID`: bigint, Host: string, Speculative: boolean, Failed: boolean, "
    "Killed: boolean, `Finish Time`: bigint>, "
    "`Task Metrics` struct<`Executor CPU Time`: bigint, `JVM GC Time`: bigint, "
    "`Executor Deserialize CPU Time`: bigint, `Executor Deserialize Time`: bigint, `Result Size`: bigint, "
    "`Result Serialization Time`: bigint, `Memory Bytes Spilled`: bigint, `Disk Bytes Spilled`: bigint, "
    "`Shuffle Read Metrics`: struct<`Remote Blocks Fetched`: bigint, `Local Blocks Fetched`: bigint, "
    "`Remote Bytes Read`: bigint, `Local Bytes Read`: bigint, `Fetch Wait Time`: bigint, "
    "`Total Records Read`: bigint>, "
    "`Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: bigint, `Shuffle Records Written`: bigint, "
    "`Shuffle Write Time`: bigint>, "
    "`Input Metrics`: struct<`Bytes Read`: bigint, `Records Read`: bigint>, "
    "`Output Metrics`: struct<`Bytes Written`: bigint, `Records Written`: bigint>>"
)
TASK_COLUMNS = {
    "task_id": ("Task Info", "Task ID"),
    "host": ("Task Info", "Host"),
    "speculative": ("Task Info", "Speculative"),
    "failed": ("Task Info", "Failed"),
    "killed": ("Task Info", "Killed"),
    "finish_time": ("Task Info", "Finish Time"),
    "executor_cpu_time": ("Task Metrics", "Executor CPU Time"),
    "jvm_gc_time": ("Task Metrics", "JVM GC Time"),
    "deserialize_cpu_time": ("Task Metrics", "Executor Deserialize CPU Time"),
    "deserialize_time": ("Task Metrics", "Executor Deserialize Time"),
    "result_size": ("Task Metrics", "Result Size"),
    "result_serialization_time": ("Task Metrics", "Result Serialization Time"),
    "memory_bytes_spilled": ("Task Metrics", "Memory Bytes Spilled"),
    "disk_bytes_spilled": ("Task Metrics", "Disk Bytes Spilled"),
    "remote_blocks_fetched": ("Task Metrics", "Shuffle Read Metrics", "Remote Blocks Fetched"),
    "local_blocks_fetched": ("Task Metrics", "Shuffle Read Metrics", "Local Blocks Fetched"),
    "remote_bytes_read": ("Task Metrics", "Shuffle Read Metrics", "Remote Bytes Read"),
    "local_bytes_read": ("Task Metrics", "Shuffle Read Metrics", "Local Bytes Read"),
    "fetch_wait_time": ("Task Metrics", "Shuffle Read Metrics", "Fetch Wait Time"),
    "shuffle_records_read": ("Task Metrics", "Shuffle Read Metrics", "Total Records Read"),
    "shuffle_bytes_written": ("Task Metrics", "Shuffle Write Metrics", "Shuffle Bytes Written"),
    "shuffle_records_written": ("Task Metrics", "Shuffle Write Metrics", "Shuffle Records Written"),
    "shuffle_write_time": ("Task Metrics", "Shuffle Write Metrics", "Shuffle Write Time"),
    "input_bytes": ("Task Metrics", "Input Metrics", "Bytes Read"),
    "input_records": ("Task Metrics", "Input Metrics", "Records Read"),
    "output_bytes": ("Task Metrics", "Output Metrics", "Bytes Written"),
    "output_records": ("Task Metrics", "Output Metrics", "Records Written"),
}
SNAPSHOTS_SHOWN = 5
DELAYED_INTERVALS = 6


def task_metrics(log_lines: DataFrame) -> DataFrame:
    """One row per finished task from the lines (``value``) of an event log."""
    ended = log_lines.where(F.col("value").rlike(TASK_END_MARK))
    lines = ended.select(F.from_json("value", TASK_END).alias("line"))

    def field(path: tuple[str, ...]) -> Column:
        column = F.col("line")
        for name in path:
            column = column.getField(name)
        return column

    return lines.select(*[field(path).alias(name) for name, path in TASK_COLUMNS.items()])


def last_task(tasks: DataFrame) -> DataFrame:
    """The metrics of the task that finished last."""
    row = F.struct(*tasks.columns)
    return tasks.agg(F.max_by(row, F.struct("finish_time", "task_id")).alias("t")).select("t.*")


def task_totals(tasks: DataFrame) -> DataFrame:
    """Tasks, time, spill and data volumes per host."""
    summed = (
        "executor_cpu_time", "jvm_gc_time", "memory_bytes_spilled", "disk_bytes_spilled",
        "remote_bytes_read", "local_bytes_read", "shuffle_bytes_written", "input_records", "output_records",
    )
    return tasks.groupBy("host").agg(
        F.count("*").alias("tasks"), F.count_if("failed").alias("failed_tasks"), *[F.sum(c).alias(c) for c in summed]
    )


def batch_metrics(progress_lines: DataFrame, interval_ms: int) -> DataFrame:
    """Delays and records per streaming batch from progress reports (``value``).

    The scheduling delay is what a trigger took outside of the batch itself. ``blocked`` is set
    when the whole delay exceeds six intervals. Batches are numbered from zero, so the count of
    finished ones is the number plus one.
    """
    report = F.from_json(
        "value",
        "name string, batchId bigint, timestamp string, numInputRows bigint, "
        "durationMs struct<triggerExecution: bigint, addBatch: bigint>",
    )
    rows = progress_lines.select(report.alias("p"))
    start = F.unix_millis(F.try_to_timestamp("p.timestamp"))
    total = F.col("p.durationMs.triggerExecution")
    return rows.select(
        F.col("p.name").alias("query"),
        F.col("p.batchId").alias("batch_id"),
        F.col("p.numInputRows").alias("records"),
        (total - F.coalesce("p.durationMs.addBatch", F.lit(0))).alias("schedule_delay"),
        total.alias("total_delay"),
        start.alias("processing_start"),
        (start + total).alias("processing_end"),
        (F.col("p.batchId") + 1).alias("finished_batches"),
        (total > DELAYED_INTERVALS * interval_ms).alias("blocked"),
    )


def newest_snapshots(snapshots: DataFrame, count: int = SNAPSHOTS_SHOWN) -> DataFrame:
    """The newest monitoring snapshots, a top-k."""
    return snapshots.orderBy(F.desc("ts")).limit(count)


def _percent(part: str, *parts: str) -> Column:
    whole = sum((F.col(p).cast("bigint") for p in parts), F.lit(0))
    return F.when(F.col(part) == 0, 0.0).otherwise(F.round(F.try_divide(F.col(part) * 100.0, whole), 2))


def health_ratios(snapshots: DataFrame) -> DataFrame:
    """Shares of stages, batches and memory, in percent with two decimals."""
    stages = ("failedStages", "runningStages", "waitingStages")
    batches = ("runningBatches", "waitingBatches", "totalCompletedBatches")
    memory = ("memUsed_MB", "remainingMem_MB")
    return snapshots.select(
        "ts",
        _percent("failedStages", *stages).alias("error_rate"),
        _percent("runningStages", *stages).alias("operating_rate"),
        _percent("waitingStages", *stages).alias("waiting_rate"),
        _percent("runningBatches", *batches).alias("running_batch_share"),
        _percent("waitingBatches", *batches).alias("waiting_batch_share"),
        _percent("totalCompletedBatches", *batches).alias("completed_batch_share"),
        _percent("memUsed_MB", *memory).alias("used_memory_share"),
        _percent("remainingMem_MB", *memory).alias("free_memory_share"),
        _percent("maxMem_MB", *memory).alias("max_memory_share"),
    )


def health_board(snapshots: DataFrame) -> DataFrame:
    return health_ratios(newest_snapshots(snapshots))
