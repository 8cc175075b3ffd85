import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from event_ml.operators import jobmetrics as jm

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
STAGE_SCHEMA = (
    "stage_id int, name string, status string, num_tasks long, duration_ms long, input_bytes long, "
    "output_bytes long, shuffle_read_bytes long, shuffle_write_bytes long, gc_time_ms long, "
    "executor_cpu_time_ms double"
)


@pytest.fixture(scope="module")
def event_log(scratch):
    """A real event log of a small job, written by a separate Spark app."""
    log_dir = os.path.join(scratch, "eventlog")
    os.makedirs(log_dir, exist_ok=True)
    code = textwrap.dedent(
        f"""
        from pyspark.sql import SparkSession
        s = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", {log_dir!r})
             .config("spark.sql.shuffle.partitions", "3").getOrCreate())
        s.read.parquet("/root/testdata/sf0.001/lineitem.parquet").groupBy("l_returnflag").count().collect()
        s.stop()
        """
    )
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    (app,) = os.listdir(log_dir)
    return os.path.join(log_dir, app)


def test_stage_and_executor_tables_from_event_log(spark, event_log):
    log = jm.read_event_log(spark, event_log).cache()
    stages = jm.stage_metrics(log).collect()
    assert len(stages) >= 2
    assert all(r["status"] == "COMPLETE" and r["num_tasks"] >= 1 for r in stages)
    assert sum(r["shuffle_write_bytes"] for r in stages) > 0
    assert sum(r["shuffle_read_bytes"] for r in stages) > 0
    assert any(r["input_bytes"] > 0 for r in stages)
    assert all(len(r["name"]) <= 50 for r in stages)
    execs = jm.executor_metrics(log).collect()
    assert [r["executor_id"] for r in execs] == ["driver"]
    assert execs[0]["cores"] == 2 and execs[0]["max_memory_mb"] > 0
    assert execs[0]["tasks_complete"] == sum(r["num_tasks"] for r in stages)
    summary = jm.job_summary(jm.stage_metrics(log)).collect()[0]
    assert summary["total_stages"] == len(stages)


def _stages(spark, rows):
    full = [(i, f"s{i}", "COMPLETE", 1, *r, 0.0) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, STAGE_SCHEMA)


@pytest.mark.parametrize(
    "rows, expected",
    [
        # (duration, input, output, shuffle_read, shuffle_write, gc)
        ([(1000, 0, 0, 0, 0, 300)], "GC_PRESSURE"),
        ([(1000, 0, 0, 40 * 10**9, 20 * 10**9, 0)], "SHUFFLE_HEAVY"),
        ([(700000, 200 * 10**9, 0, 0, 0, 0)], "IO_BOUND"),
        ([(500000, 200 * 10**9, 0, 0, 0, 0)], "COMPUTE_BOUND"),
        ([(0, 0, 0, 0, 0, 1)], "GC_PRESSURE"),  # max(runtime, 1) guard
    ],
)
def test_bottleneck_rules(spark, rows, expected):
    assert jm.job_bottleneck(_stages(spark, rows)).collect()[0]["bottleneck"] == expected


def test_bottleneck_empty_is_unknown(spark):
    empty = spark.createDataFrame([], STAGE_SCHEMA)
    assert jm.job_bottleneck(empty).collect()[0]["bottleneck"] == "Unknown"


def test_slow_stages_and_kpis(spark):
    st = _stages(spark, [(d, 0, 0, 2 * 10**6, 10**6, 5) for d in range(30)])
    top = jm.slow_stages(st, 15).collect()
    assert len(top) == 15 and top[0]["duration_ms"] == 29 and top[0]["shuffle_read_mb"] == 2.0
    kpis = {r["kpi"]: r for r in jm.job_kpis(st).collect()}
    assert kpis["Total Stages"]["value"] == 30 and kpis["Bottleneck"]["text"] == "GC_PRESSURE"


def test_streaming_scoring(spark, scratch):
    from event_ml.operators import features as fe
    from event_ml.operators import models as md
    from event_ml.schema import EVENT_FEATURES, event_schema
    from event_ml.sources.generate import synthetic_events
    from event_ml.streaming.scoring import event_stream, score, start_scoring

    cols = EVENT_FEATURES[:4]
    src = os.path.join(scratch, "stream-in")
    ev = synthetic_events(spark, 600, signal=2.0).select(
        *[F.col(c).cast("float").alias(c) for c in ["label", *EVENT_FEATURES]]
    )
    ev.write.mode("overwrite").parquet(src)
    train = fe.assemble(spark.read.parquet(src).withColumn("label", F.col("label").cast("double")), cols)
    model = md.make_estimator("LogisticRegression", maxIter=5).fit(train)
    assembler_stage = fe.prep_pipeline(cols, "features").getStages()[0].setOutputCol("features")
    stream = event_stream(spark, src, event_schema())
    scored = score(stream, [fe.EventFeatureEngineer(), assembler_stage, model], keep=["label"])
    out, ck = os.path.join(scratch, "stream-out"), os.path.join(scratch, "stream-ck")
    q = start_scoring(scored, out, ck)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == 600 and set(got.columns) == {"label", "prob_1", "prediction"}


def test_entry_contract(spark):
    sys.path.insert(0, ROOT)
    import __spark_entry__ as e

    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len(o) >= 50
    out = e.entry(spark)
    assert out.columns == ["threshold", "tp", "fp", "tn", "fn", "cost"]
    assert out.count() == 1


def test_queries_without_the_training_data_folder(monkeypatch):
    """A missing folder leaves the other queries; any other missing module is an error."""
    import sys

    import __spark_entry__ as entry

    from event_ml.plans import registry

    for name in ("event_ml.llm", "event_ml.llm.queries"):
        monkeypatch.setitem(sys.modules, name, None)
    assert entry._llm() == ({}, {})
    assert set(registry.queries()) <= set(entry.queries()) and set(registry.oracle_sql()) <= set(entry.oracle_sql())
