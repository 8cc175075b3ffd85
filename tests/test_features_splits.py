import os

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from event_ml.operators import features as fe
from event_ml.operators import splits as sp
from event_ml.schema import ENGINEERED_FEATURES, EVENT_FEATURES
from event_ml.sources.generate import unit_events


@pytest.fixture(scope="module")
def events(spark):
    return unit_events(spark, 1000).withColumn("key", F.monotonically_increasing_id().cast("string")).cache()


def test_transformer_adds_exactly_five_columns(events):
    out = fe.EventFeatureEngineer().transform(events)
    added = set(out.columns) - set(events.columns)
    assert added == set(ENGINEERED_FEATURES)
    r = out.select("jet1_b_tag", "jet2_b_tag", "jet3_b_tag", "jet4_b_tag", "bjet_multiplicity").first()
    assert r["bjet_multiplicity"] == sum(1 for v in list(r)[:4] if v > 0.5)


def test_transformer_persists(events, scratch):
    eng = fe.EventFeatureEngineer()
    path = os.path.join(scratch, "eng")
    Pipeline(stages=[eng]).fit(events).write().overwrite().save(path)
    again = PipelineModel.load(path)
    a = eng.transform(events).select(ENGINEERED_FEATURES).collect()
    b = again.transform(events).select(ENGINEERED_FEATURES).collect()
    assert a == b


def test_transformer_custom_columns(spark):
    df = spark.createDataFrame([(2.0, 0.0, 1.0, 3.0)], "a double, b double, c double, d double")
    t = fe.EventFeatureEngineer(
        ratio_num="a", ratio_den="b", sum_cols=["c", "d"], flag_cols=["c", "d"], flag_thresholds=[0.5, 5.0],
        ratio2_num="d", ratio2_den="c", diff_a="a", diff_b="d", output_cols=["r", "s", "f", "r2", "g"],
    )
    r = t.transform(df).first()
    assert r["r"] == pytest.approx(2.0 / 1e-6) and r["s"] == 4.0 and r["f"] == 1 and r["g"] == 1.0


def test_assembler_skip_report_matches_assembler(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (None, 1.0), (float("nan"), 1.0), (float("inf"), 1.0)], "a double, b double"
    )
    rep = fe.assembler_report(df, ["a", "b"]).collect()[0]
    assert (rep["n_rows"], rep["n_kept"], rep["n_dropped"]) == (4, 2, 2)
    assert fe.assemble(df, ["a", "b"]).count() == rep["n_kept"]


def test_standardise_twin_matches_mllib(events):
    cols = EVENT_FEATURES[:3]
    vec = fe.assemble(events, cols, "raw")
    scaled = fe.fit_scaler(vec, "raw", "z").transform(vec)
    ml = scaled.select(vector_to_array("z").alias("z")).collect()
    sql = fe.standardise_columns(events, cols).select(*cols).collect()
    for a, b in zip(ml, sql):
        assert list(a["z"]) == pytest.approx([b[c] for c in cols], abs=1e-9)
    means = scaled.select(vector_to_array("z")[0].alias("f0")).agg(F.avg("f0")).first()[0]
    assert abs(means) < 0.1


def test_pca_variance(events):
    vec = fe.assemble(events, EVENT_FEATURES, "raw")
    z = fe.fit_scaler(vec, "raw", "features").transform(vec)
    rows = fe.pca_variance(z, "features", k=20).orderBy("component").collect()
    assert len(rows) == 20
    assert all(a["cumulative"] <= b["cumulative"] for a, b in zip(rows, rows[1:]))


def test_splits_disjoint_complete_and_partition_independent(events):
    names, weights = ["train", "val", "test"], [0.7, 0.15, 0.15]
    a = sp.with_split(events, "key", names, weights, salt="s")
    b = sp.with_split(events.repartition(7), "key", names, weights, salt="s")
    ma = {r["key"]: r["split"] for r in a.collect()}
    mb = {r["key"]: r["split"] for r in b.collect()}
    assert ma == mb and len(ma) == 1000
    parts = sp.hash_split(events, "key", weights, salt="s")
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 1000 and 600 < sizes[0] < 800


def test_normalised_weights():
    cuts = sp.normalised_cuts([0.12, 0.8])
    assert cuts[-1] == 1 << 32 and abs(cuts[0] / (1 << 32) - 0.12 / 0.92) < 1e-9


def test_stratified_split_per_class(events):
    t = sp.stratified_split(events, "key", "label", ["train", "test"], [0.8, 0.2], salt="x")
    sizes = {(r["label"], r["split"]): r["count"] for r in t.groupBy("label", "split").count().collect()}
    for lbl in (0.0, 1.0):
        assert sizes[(lbl, "train")] + sizes[(lbl, "test")] == 500


def test_smallest_by_hash_equals_sort_limit(events):
    from event_ml.functions.columns import hash_u32

    keyed = events.withColumn("h", hash_u32(F.concat(F.lit("q"), F.col("key"))))
    expected = {r["key"] for r in keyed.orderBy("h", "key").limit(137).collect()}
    for bits in (16, 3):  # 3 bits per pass forces many refinement passes
        got = {r["key"] for r in sp.smallest_by_hash(events, "key", 137, salt="q", bits_per_pass=bits).collect()}
        assert got == expected
    assert sp.smallest_by_hash(events, "key", 5000, salt="q").count() == 1000


def test_smallest_by_hash_of_equal_and_null_keys(spark):
    rows = [("hot", i % 7) for i in range(300)] + [(None, i) for i in range(5)] + [("a", 1), ("a", 1), ("b", 2)]
    df = spark.createDataFrame(rows, "key string, v int")
    for k in (1, 3, 10, 290, 307):
        for bits in (16, 5):
            got = sp.smallest_by_hash(df, "key", k, bits_per_pass=bits)
            kept = [tuple(r) for r in got.collect()]
            assert len(kept) == k and got.columns == ["key", "v"]
            assert all(kept.count(r) <= rows.count(r) for r in kept)
    h = {r["key"]: r["h"] for r in df.select("key", sp.key_hash("key").alias("h")).collect()}
    first = min(h, key=lambda x: (h[x], x or ""))
    assert {r["key"] for r in sp.smallest_by_hash(df, "key", 1).collect()} == {first}


def test_null_keys_fall_into_one_split_by_their_hash(spark):
    df = spark.createDataFrame([(None,)] * 8 + [("",)] * 2, "key string")
    assert sp.with_split(df, "key", ["a", "b"], [0.5, 0.5]).select("split").distinct().count() == 1
    assert sp.hash_sample(df, "key", 1.0).count() == 10


def test_hash_sample_fraction(events):
    n = sp.hash_sample(events, "key", 0.3, salt="z").count()
    assert 230 < n < 370
    assert sp.capped_fraction(1000, 200) == 0.2 and sp.capped_fraction(100, 200) == 1.0
