import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from event_ml.functions.quantiles import exact_quantiles
from event_ml.operators import explore as x
from event_ml.operators import quality as q


@pytest.fixture(scope="module")
def dirty(spark):
    rows = [
        (1.0, 1.0, 2.0, None, 5.0),
        (0.0, None, 4.0, None, 5.0),
        (1.0, float("nan"), 6.0, None, 5.0),
        (0.0, 3.0, float("inf"), None, 5.0),
        (1.0, 5.0, 8.0, None, 5.0),
        (0.0, 7.0, 10.0, None, 5.0),
    ]
    return spark.createDataFrame(rows, "label double, a double, b double, empty double, const double")


def test_null_profile(dirty):
    rows = {r["feature"]: r for r in q.null_profile(dirty, ["a", "b", "empty", "const"]).collect()}
    assert set(rows) == {"a", "empty"}
    assert rows["a"]["null_count"] == 1 and rows["a"]["null_or_nan_count"] == 2
    assert rows["a"]["null_pct"] == round(2 / 6 * 100, 4)
    assert rows["a"]["n_affected_columns"] == 2


def test_invalid_rows_include_infinity(dirty):
    s = q.invalid_summary(dirty, ["a", "b"]).collect()[0]
    assert (s["n_null_rows"], s["n_nan_rows"], s["n_inf_rows"], s["n_invalid_rows"]) == (1, 1, 1, 3)
    assert q.invalid_rows(dirty, ["a", "b"]).count() == 3


def test_all_null_and_constant(dirty):
    rows = {r["feature"]: r["all_null"] for r in q.all_null_columns(dirty, ["a", "empty", "const"]).collect()}
    assert rows == {"a": False, "empty": True, "const": False}
    d = {r["feature"]: r for r in q.describe_numeric(dirty, ["const"]).collect()}
    assert d["const"]["stddev"] == 0.0


def test_median_fill_replaces_null_and_nan(dirty):
    filled, med = q.median_fill(dirty, ["a"])
    assert med.collect()[0]["median"] == 4.0  # median of 1, 3, 5, 7 (null and NaN ignored)
    vals = sorted(r["a"] for r in filled.collect())
    assert vals == [1.0, 3.0, 4.0, 4.0, 5.0, 7.0]


def test_exact_quantiles_match_numpy(spark):
    rng = random.Random(4)
    vals = [rng.randint(0, 50) / 7 for _ in range(999)]
    df = spark.createDataFrame([(v, v * 2) for v in vals], "u double, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    for accuracy, blocks in ((1000, 1), (20, 7), (90, 3)):  # whole ranges, and sketched brackets
        got = {(r["feature"], r["prob"]): r["value"] for r in exact_quantiles(df, ["u", "v"], probs, accuracy, blocks).collect()}
        for p in probs:
            assert got[("u", p)] == pytest.approx(np.quantile(vals, p), abs=1e-12)
            assert got[("v", p)] == pytest.approx(np.quantile([2 * v for v in vals], p), abs=1e-12)


def test_label_distribution_half_up(spark):
    df = spark.createDataFrame([(1.0,)] * 2 + [(0.0,)] * 1, "label double")
    rows = {r["label"]: r for r in q.label_distribution(df).collect()}
    assert rows[1.0]["pct"] == 66.67 and rows[0.0]["pct"] == 33.33


def test_density_histogram_integrates_to_one(spark):
    rng = random.Random(8)
    rows = [(float(rng.randint(0, 1)), rng.gauss(0, 1), 3.0) for _ in range(500)]
    df = spark.createDataFrame(rows, "label double, x double, c double")
    h = x.density_histogram(df, ["x", "c"], "label", bins=60).collect()
    assert len(h) == 2 * 2 * 60
    for feat in ("x", "c"):
        for lbl in (0.0, 1.0):
            part = sorted((r for r in h if r["feature"] == feat and r["label"] == lbl), key=lambda r: r["bin"])
            n = sum(r["count"] for r in part)
            assert n == sum(1 for r in rows if r[0] == lbl)
            width = part[1]["bin_lo"] - part[0]["bin_lo"]
            assert sum(r["density"] * width for r in part) == pytest.approx(1.0, abs=1e-9)
    const = [r for r in h if r["feature"] == "c" and r["label"] == 0.0]
    assert min(r["bin_lo"] for r in const) == pytest.approx(2.5)  # widened by 0.5


def test_correlation_pairs_match_numpy(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=300)
    b = a * 0.5 + rng.normal(size=300)
    c = rng.normal(size=300)
    df = spark.createDataFrame([(float(i), float(j), float(k)) for i, j, k in zip(a, b, c)], "a double, b double, c double")
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in x.correlation_pairs(df, ["a", "b", "c"], 12).collect()}
    assert set(got) == {("b", "a"), ("c", "a"), ("c", "b")}
    assert got[("b", "a")] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-9)


def test_group_value_equals_window(spark):
    from pyspark.sql import Window

    df = spark.createDataFrame([(i, i % 3) for i in range(100)], "id long, g long")
    a = x.with_group_value(df, ["g"], F.count(F.lit(1)), "n").orderBy("id").collect()
    b = df.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("g"))).orderBy("id").collect()
    assert [(r["id"], r["n"]) for r in a] == [(r["id"], r["n"]) for r in b]


def test_class_separation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0), (0.0, 0.0), (0.0, 2.0)], "label double, v double")
    r = x.class_separation(df, ["v"], "label").collect()[0]
    assert r["smd"] == pytest.approx(2 / math.sqrt(2), abs=1e-6)


def test_select_metric_validates(spark):
    t = spark.createDataFrame([("m1", 0.7)], "model string, auc double")
    assert x.select_metric(t, "auc", ["model"]).collect()[0]["value"] == 0.7
    with pytest.raises(ValueError):
        x.select_metric(t, "nope", ["model"])
