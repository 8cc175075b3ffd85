"""Randomised property tests (hypothesis): exact metrics against brute force
on small inputs with many ties, threshold counts, exact-k selection."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from event_ml.operators import metrics as m
from event_ml.operators import splits as sp
from event_ml.operators import thresholds as th

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_strategy = st.lists(
    st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=2, max_size=40
).filter(lambda rs: len({y for y, _ in rs}) == 2)


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg) / (len(pos) * len(neg))


@SETTINGS
@given(rows=rows_strategy)
def test_auc_matches_brute_force(spark, rows):
    df = spark.createDataFrame([(float(y), float(s)) for y, s in rows], "label double, score double")
    got = m.auc_exact(df, "score", "label", n_blocks=3).collect()[0]["auc"]
    assert abs(got - brute_auc(rows)) < 1e-12


@SETTINGS
@given(rows=rows_strategy, cuts=st.lists(st.integers(0, 7), min_size=1, max_size=5, unique=True))
def test_threshold_counts(spark, rows, cuts):
    df = spark.createDataFrame([(float(y), float(s)) for y, s in rows], "label double, score double")
    for r in th.cost_curve(df, "score", "label", cuts).collect():
        t = r["threshold"]
        assert r["tp"] == sum(1 for y, s in rows if y == 1 and s >= t)
        assert r["fp"] == sum(1 for y, s in rows if y == 0 and s >= t)
        assert r["tp"] + r["fp"] + r["tn"] + r["fn"] == len(rows)


@SETTINGS
@given(keys=st.lists(st.integers(0, 10**6), min_size=1, max_size=60, unique=True), k=st.integers(1, 70))
def test_smallest_by_hash_is_sort_limit(spark, keys, k):
    df = spark.createDataFrame([(str(x),) for x in keys], "key string")
    got = {r["key"] for r in sp.smallest_by_hash(df, "key", k, salt="p", bits_per_pass=2).collect()}
    h = df.withColumn("h", sp.key_hash("key", "p"))
    want = {r["key"] for r in h.orderBy("h", "key").limit(k).collect()}
    assert got == want


@SETTINGS
@given(keys=st.lists(st.text(min_size=1, max_size=8), min_size=1, max_size=50, unique=True))
def test_split_is_partition_independent(spark, keys):
    df = spark.createDataFrame([(x,) for x in keys], "key string")
    a = {r["key"]: r["split"] for r in sp.with_split(df, "key", ["a", "b"], [0.3, 0.7]).collect()}
    b = {r["key"]: r["split"] for r in sp.with_split(df.repartition(3), "key", ["a", "b"], [0.3, 0.7]).collect()}
    assert a == b and set(a) == set(keys)
    assert df.withColumn("s", sp.split_index("key", [0.3, 0.7])).filter(F.col("s").isNull()).count() == 0
