"""Job-performance tables from Spark event logs (JSON lines).

The event log is read with a DECLARED schema -- inferring one over millions
of mixed event types is a full extra pass -- and each table is one
aggregate: task-end events grouped by stage (or executor), joined with the
stage-completed / executor-added rows, which are one per stage / executor.
``duration_ms`` is the summed executor run time of a stage's tasks (CPU-side
work), not wall-clock time; wall-clock is ``wall_ms`` when completion times
are present.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, S, D = T.LongType(), T.StringType(), T.DoubleType()

# --- fixed values: bottleneck labels and rule limits, KPI labels --------------
BOTTLENECK_UNKNOWN = "Unknown"
BOTTLENECK_GC = "GC_PRESSURE"
BOTTLENECK_SHUFFLE = "SHUFFLE_HEAVY"
BOTTLENECK_IO = "IO_BOUND"
BOTTLENECK_COMPUTE = "COMPUTE_BOUND"
GC_RATIO_LIMIT = 0.2  # GC time / run time
SHUFFLE_GB_LIMIT = 50  # GB read + written
INPUT_GB_LIMIT = 100  # GB, together with run time
RUNTIME_MS_LIMIT = 600_000
KPI_LABELS = ["Total Stages", "Total Tasks", "Total Runtime (min)", "Total Shuffle (GB)", "GC Time (min)", "Bottleneck"]
STAGE_NAME_CHARS = 50
TOP_STAGES = 15
# --- end of fixed values -----------------------------------------------------


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


EVENT_LOG_SCHEMA = _st(
    ("Event", S),
    ("Stage ID", L),
    ("Stage Attempt ID", L),
    ("Task End Reason", _st(("Reason", S))),
    ("Task Info", _st(("Executor ID", S), ("Host", S), ("Failed", T.BooleanType()), ("Killed", T.BooleanType()))),
    (
        "Task Metrics",
        _st(
            ("Executor Run Time", L),
            ("Executor CPU Time", L),
            ("JVM GC Time", L),
            ("Peak Execution Memory", L),
            ("Input Metrics", _st(("Bytes Read", L))),
            ("Output Metrics", _st(("Bytes Written", L))),
            ("Shuffle Read Metrics", _st(("Remote Bytes Read", L), ("Local Bytes Read", L))),
            ("Shuffle Write Metrics", _st(("Shuffle Bytes Written", L))),
        ),
    ),
    ("Task Executor Metrics", _st(("JVMHeapMemory", L), ("OnHeapUnifiedMemory", L))),
    (
        "Stage Info",
        _st(
            ("Stage ID", L),
            ("Stage Attempt ID", L),
            ("Stage Name", S),
            ("Number of Tasks", L),
            ("Submission Time", L),
            ("Completion Time", L),
            ("Failure Reason", S),
        ),
    ),
    ("Executor ID", S),
    ("Executor Info", _st(("Host", S), ("Total Cores", L))),
    ("Block Manager ID", _st(("Executor ID", S), ("Host", S))),
    ("Maximum Memory", L),
)


def c(path: str) -> Column:
    return F.col(".".join(f"`{p}`" for p in path.split(".")))


def z(col: Column) -> Column:
    """Missing metric -> 0."""
    return F.coalesce(col, F.lit(0))


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """A single log file, or a rolled event-log directory (events_* files)."""
    return spark.read.schema(EVENT_LOG_SCHEMA).json(path)


def stage_metrics(log: DataFrame) -> DataFrame:
    """one row per stage attempt, 11 columns (+ wall_ms)."""
    tasks = log.filter(F.col("Event") == "SparkListenerTaskEnd").groupBy(
        c("Stage ID").alias("stage_id"), c("Stage Attempt ID").alias("attempt")
    ).agg(
        F.count(F.lit(1)).alias("tasks_ended"),
        F.sum(z(c("Task Metrics.Executor Run Time"))).alias("duration_ms"),
        F.sum(z(c("Task Metrics.Input Metrics.Bytes Read"))).alias("input_bytes"),
        F.sum(z(c("Task Metrics.Output Metrics.Bytes Written"))).alias("output_bytes"),
        F.sum(
            z(c("Task Metrics.Shuffle Read Metrics.Remote Bytes Read"))
            + z(c("Task Metrics.Shuffle Read Metrics.Local Bytes Read"))
        ).alias("shuffle_read_bytes"),
        F.sum(z(c("Task Metrics.Shuffle Write Metrics.Shuffle Bytes Written"))).alias("shuffle_write_bytes"),
        F.sum(z(c("Task Metrics.JVM GC Time"))).alias("gc_time_ms"),
        (F.sum(z(c("Task Metrics.Executor CPU Time"))) / 1e6).alias("executor_cpu_time_ms"),
    )
    stages = log.filter(F.col("Event") == "SparkListenerStageCompleted").select(
        c("Stage Info.Stage ID").alias("stage_id"),
        c("Stage Info.Stage Attempt ID").alias("attempt"),
        F.substring(F.coalesce(c("Stage Info.Stage Name"), F.lit("")), 1, STAGE_NAME_CHARS).alias("name"),
        F.when(c("Stage Info.Failure Reason").isNotNull(), F.lit("FAILED")).otherwise(F.lit("COMPLETE")).alias("status"),
        z(c("Stage Info.Number of Tasks")).alias("num_tasks"),
        (c("Stage Info.Completion Time") - c("Stage Info.Submission Time")).alias("wall_ms"),
    )
    joined = stages.join(tasks, ["stage_id", "attempt"], "full_outer")
    return joined.select(
        F.col("stage_id").cast("int").alias("stage_id"),
        F.coalesce("name", F.lit("")).alias("name"),
        F.coalesce("status", F.lit("ACTIVE")).alias("status"),
        F.coalesce("num_tasks", "tasks_ended", F.lit(0)).cast("long").alias("num_tasks"),
        *[z(F.col(x)).cast("long").alias(x) for x in (
            "duration_ms", "input_bytes", "output_bytes", "shuffle_read_bytes", "shuffle_write_bytes", "gc_time_ms",
        )],
        z(F.col("executor_cpu_time_ms")).cast("double").alias("executor_cpu_time_ms"),
        "wall_ms",
    )


def executor_metrics(log: DataFrame) -> DataFrame:
    """one row per executor.  ``peak_memory_mb`` is the peak JVM heap
    reported with task ends (an event log has no 'memory used now')."""
    tasks = log.filter(F.col("Event") == "SparkListenerTaskEnd").groupBy(
        c("Task Info.Executor ID").alias("executor_id")
    ).agg(
        F.count_if(c("Task End Reason.Reason") == "Success").alias("tasks_complete"),
        F.count_if(c("Task End Reason.Reason") != "Success").alias("tasks_failed"),
        F.sum(z(c("Task Metrics.JVM GC Time"))).alias("gc_time_ms"),
        F.max(z(c("Task Executor Metrics.JVMHeapMemory"))).alias("peak_heap"),
    )
    added = log.filter(F.col("Event") == "SparkListenerExecutorAdded").groupBy(
        c("Executor ID").alias("executor_id")
    ).agg(F.max(c("Executor Info.Host")).alias("host"), F.max(c("Executor Info.Total Cores")).alias("cores"))
    bm = log.filter(F.col("Event") == "SparkListenerBlockManagerAdded").groupBy(
        c("Block Manager ID.Executor ID").alias("executor_id")
    ).agg(F.max(c("Maximum Memory")).alias("max_memory"), F.max(c("Block Manager ID.Host")).alias("bm_host"))
    joined = added.join(bm, "executor_id", "full_outer").join(tasks, "executor_id", "full_outer")
    mb = 1024.0 * 1024.0
    return joined.select(
        "executor_id",
        F.coalesce("host", "bm_host", F.lit("")).alias("host"),
        z(F.col("cores")).cast("int").alias("cores"),
        (z(F.col("max_memory")) / mb).alias("max_memory_mb"),
        (z(F.col("peak_heap")) / mb).alias("peak_memory_mb"),
        F.lit(0).alias("tasks_active"),
        z(F.col("tasks_complete")).cast("int").alias("tasks_complete"),
        z(F.col("tasks_failed")).cast("int").alias("tasks_failed"),
        z(F.col("gc_time_ms")).cast("long").alias("gc_time_ms"),
    )


def job_summary(stages: DataFrame, digits: int = 6) -> DataFrame:
    """A19: totals over the stage table, one aggregate."""
    return stages.agg(
        F.count(F.lit(1)).alias("total_stages"),
        z(F.sum("num_tasks")).cast("long").alias("total_tasks"),
        F.round(z(F.sum("duration_ms")) / 60000.0, digits).alias("total_runtime_min"),
        F.round((z(F.sum("shuffle_read_bytes")) + z(F.sum("shuffle_write_bytes"))) / 1e9, digits).alias("total_shuffle_gb"),
        F.round(z(F.sum("gc_time_ms")) / 60000.0, digits).alias("total_gc_time_min"),
    )


def job_bottleneck(stages: DataFrame, digits: int = 6) -> DataFrame:
    """A20: ordered rules -- GC time > 20% of run time -> GC_PRESSURE;
    shuffle > 50 GB -> SHUFFLE_HEAVY; input > 100 GB and run time > 600 s ->
    IO_BOUND; else COMPUTE_BOUND; no stages -> Unknown."""
    t = stages.agg(
        F.count(F.lit(1)).alias("n"),
        z(F.sum("duration_ms")).alias("runtime"),
        (z(F.sum("shuffle_read_bytes")) + z(F.sum("shuffle_write_bytes"))).alias("shuffle"),
        z(F.sum("gc_time_ms")).alias("gc"),
        z(F.sum("input_bytes")).alias("input"),
    )
    gc_ratio = F.col("gc") / F.greatest(F.col("runtime"), F.lit(1))
    shuffle_gb = F.col("shuffle") / 1e9
    input_gb = F.col("input") / 1e9
    label = (
        F.when(F.col("n") == 0, F.lit(BOTTLENECK_UNKNOWN))
        .when(gc_ratio > GC_RATIO_LIMIT, F.lit(BOTTLENECK_GC))
        .when(shuffle_gb > SHUFFLE_GB_LIMIT, F.lit(BOTTLENECK_SHUFFLE))
        .when((input_gb > INPUT_GB_LIMIT) & (F.col("runtime") > RUNTIME_MS_LIMIT), F.lit(BOTTLENECK_IO))
        .otherwise(F.lit(BOTTLENECK_COMPUTE))
    )
    return t.select(
        label.alias("bottleneck"),
        F.round(gc_ratio, digits).alias("gc_ratio"),
        F.round(shuffle_gb, digits).alias("shuffle_gb"),
        F.round(input_gb, digits).alias("input_gb"),
    )


def slow_stages(stages: DataFrame, n: int = TOP_STAGES) -> DataFrame:
    """T4/F4: the n stages with the largest run time (ties: lower id), with
    shuffle MB (/1e6), GC seconds and run seconds."""
    return stages.orderBy(F.col("duration_ms").desc(), F.col("stage_id").asc()).limit(n).select(
        "stage_id",
        "name",
        "duration_ms",
        (F.col("duration_ms") / 1000.0).alias("duration_s"),
        (F.col("shuffle_read_bytes") / 1e6).alias("shuffle_read_mb"),
        (F.col("shuffle_write_bytes") / 1e6).alias("shuffle_write_mb"),
        (F.col("gc_time_ms") / 1000.0).alias("gc_s"),
    )


def job_kpis(stages: DataFrame, digits: int = 6) -> DataFrame:
    """(kpi, value, text) label/value table of the summary and verdict."""
    s = job_summary(stages, digits).crossJoin(job_bottleneck(stages, digits).select("bottleneck"))
    numeric = ["total_stages", "total_tasks", "total_runtime_min", "total_shuffle_gb", "total_gc_time_min"]
    items = [
        F.struct(F.lit(k).alias("kpi"), F.col(col).cast("double").alias("value"), F.lit(None).cast("string").alias("text"))
        for k, col in zip(KPI_LABELS, numeric)
    ] + [
        F.struct(
            F.lit(KPI_LABELS[-1]).alias("kpi"), F.lit(None).cast("double").alias("value"), F.col("bottleneck").alias("text")
        )
    ]
    return s.select(F.explode(F.array(*items)).alias("k")).select("k.*")
