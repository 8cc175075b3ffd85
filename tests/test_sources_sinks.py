import json
import os

from pyspark.sql import functions as F

from event_ml import schema as sc
from event_ml.session import build_session, spark_conf_from_config
from event_ml.sinks import writers as w
from event_ml.sources import files as fs
from event_ml.sources.generate import range_smoke, synthetic_events, unit_events


def test_declared_schema():
    s = sc.event_schema()
    assert len(s.fields) == 29 and s.fields[0].name == "label"
    assert all(f.nullable for f in s.fields)
    m = json.loads(sc.schema_to_json_map(s))
    assert sc.check_schema_map(m) == []
    assert sc.schema_from_json(s.json()) == s
    assert sc.feature_group("m_bb") == "high_level" and sc.feature_group("jet1_pT") == "low_level"


def test_permissive_csv_keeps_malformed_rows(spark, scratch):
    path = os.path.join(scratch, "bad.csv")
    good = ",".join(["1"] + ["0.5"] * 28)
    lines = [good, good, ",".join(["0"] + ["1.0"] * 27), good + ",9.9", ",".join(["1", "abc"] + ["0.1"] * 27)]
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    # one-pass ingest to parquet partitioned by the malformed flag
    ing = fs.ingest_csv(spark, path, sc.event_schema(), os.path.join(scratch, "ingested"))
    rep2 = fs.ingest_report(ing).collect()[0]
    assert (rep2["n_rows"], rep2["n_good"], rep2["n_malformed"]) == (5, 2, 3)
    good_df, bad_df = fs.split_malformed(ing)
    assert good_df.count() == 2 and sorted(r[0] for r in bad_df.collect()) == sorted(lines[2:])
    assert sc.CORRUPT_COLUMN not in good_df.columns


def test_inferred_and_positional_csv(spark, scratch):
    df = unit_events(spark, 50).select("label", "lepton_pT", "m_bb")
    p1 = w.write_csv(df, os.path.join(scratch, "hdr"), header=True)
    back = fs.read_csv_inferred(spark, p1)
    assert back.columns == ["label", "lepton_pT", "m_bb"] and back.count() == 50
    p2 = w.write_csv(df, os.path.join(scratch, "nohdr"), header=False)
    pos = fs.read_csv_positional(spark, p2, ["label", "feature_1", "feature_2"])
    assert pos.columns == ["label", "feature_1", "feature_2"]
    assert abs(pos.agg(F.sum("feature_2")).first()[0] - df.agg(F.sum("m_bb")).first()[0]) < 1e-3


def test_parquet_partitioned_roundtrip(spark, scratch):
    df = unit_events(spark, 200)
    path = w.write_parquet(df, os.path.join(scratch, "pq"), partition_by=["label"])
    assert sorted(os.listdir(path))[-2:] == ["label=0.0", "label=1.0"]
    chk = w.readback_check(spark, path, 200, 29).collect()[0]
    assert chk["matches"] and chk["n_rows"] == 200
    assert set(spark.read.parquet(path).columns) == set(df.columns)


def test_result_table_and_schema_sinks(spark, scratch):
    t = spark.createDataFrame([("GBT", 0.77, 15.0)], "Algorithm string, `Val AUC` double, `Train Time (s)` double")
    p = w.write_result_table(t, os.path.join(scratch, "summary"))
    back = fs.read_result_csv(spark, p, fs.TRAINING_SUMMARY_SCHEMA).collect()[0]
    assert back["Algorithm"] == "GBT" and back["Val AUC"] == 0.77
    sp = w.write_schema_json(spark, sc.event_schema(), os.path.join(scratch, "schema"))
    text = "\n".join(r["value"] for r in spark.read.text(sp).collect())
    assert sc.check_schema_map(json.loads(text)) == []


def test_generators(spark):
    assert range_smoke(spark).count() == 100
    u = unit_events(spark, 1000)
    assert u.count() == 1000 and len(u.columns) == 29
    assert {r[0] for r in u.select("label").distinct().collect()} == {0.0, 1.0}
    s = synthetic_events(spark, 2000, signal=2.0)
    assert s.count() == 2000 and abs(s.agg(F.avg("m_bb")).first()[0] - 50) < 3


def test_config_keys_all_honoured():
    conf = spark_conf_from_config(
        {"driver_memory": "8g", "executor_memory": "6g", "shuffle_partitions": 200, "num_executors": 4,
         "executor_cores": 4, "checkpoint_dir": "/shared/ckpt"}
    )
    assert conf["spark.sql.shuffle.partitions"] == "200"
    assert conf["spark.executor.instances"] == "4"
    assert conf["spark.checkpoint.dir"] == "/shared/ckpt"
    assert conf["spark.ui.enabled"] == "false"
    assert conf["spark.serializer"].endswith("KryoSerializer")


def test_config_file_loads(scratch):
    from event_ml.session import load_config

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    cfg = load_config(os.path.join(root, "config", "spark_config.yaml"))
    for key in ("driver_memory", "executor_memory", "shuffle_partitions"):
        assert key in cfg


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    import pytest

    from event_ml.session import ensure_checkpoint_dir

    conf = SimpleNamespace(get=lambda *a: None)
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, getConf=lambda: conf)
        with pytest.raises(ValueError, match="share"):
            ensure_checkpoint_dir(SimpleNamespace(sparkContext=context, conf=conf))


def test_build_session_reuses_and_sets_checkpoint(spark):
    s = build_session({"shuffle_partitions": 8})
    assert s.sparkContext.getCheckpointDir()
