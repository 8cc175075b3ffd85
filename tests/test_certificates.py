import random

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.sql import functions as F

from event_ml.operators import certificates as ct
from event_ml.operators import features as fe
from event_ml.operators import scaling as sc


def gini(labels):
    p = sum(labels) / len(labels)
    return 2 * p * (1 - p)


def slow_split(pairs):
    """(lo, hi, gain, n_left, pos_left) by trying every cut."""
    values, best = sorted({v for v, _ in pairs}), None
    labels = [y for _, y in pairs]
    for lo, hi in zip(values, values[1:]):
        left, right = [y for v, y in pairs if v <= lo], [y for v, y in pairs if v > lo]
        gain = gini(labels) - len(left) / len(pairs) * gini(left) - len(right) / len(pairs) * gini(right)
        if best is None or gain > best[2] + 1e-12:
            best = (lo, hi, gain, len(left), sum(left))
    return best


@pytest.mark.parametrize("n_blocks", [1, 6])
def test_best_splits_against_every_cut(spark, n_blocks):
    rng = random.Random(n_blocks)
    rows = [(float(rng.randint(0, 30)), rng.choice([0.5, None, float("nan"), 2.0]), 7.0, float(rng.random() < 0.4)) for _ in range(300)]
    rows = [(a + 5 * y, b, c, y) for a, b, c, y in rows] + [(1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, constant double, label double")
    got = {r.feature: r for r in ct.best_splits(df, ["a", "b", "constant"], n_blocks=n_blocks).collect()}
    assert set(got) == {"a", "b"}  # a constant has no split
    for i, name in enumerate("ab"):
        lo, hi, gain, n_left, pos_left = slow_split([(r[i], r[3]) for r in rows if r[3] is not None and r[i] is not None and r[i] == r[i]])
        r = got[name]
        assert (r.lo, r.hi, r.n_left, r.pos_left) == (lo, hi, n_left, pos_left) and r.gain == pytest.approx(gain, abs=1e-12)
    assert ct.best_splits(df.limit(0), ["a"]).count() == 0


def test_a_tree_splits_at_the_best_split(spark):
    rng = random.Random(5)
    rows = [(rng.random(), rng.random(), float(y)) for y in (rng.randint(0, 1) for _ in range(400))]
    rows = [(a + 0.6 * y, b + 0.2 * y, y) for a, b, y in rows]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    found = ct.best_splits(df, ["a", "b"]).orderBy(F.desc("gain")).first()
    model = DecisionTreeClassifier(maxDepth=1, maxBins=500).fit(fe.assemble(df, ["a", "b"]))
    feature, threshold, gain = ct.root_split(model)
    assert ["a", "b"][feature] == found.feature and found.lo <= threshold <= found.hi and gain == pytest.approx(found.gain, abs=1e-12)
    constant = df.withColumn("a", F.lit(1.0))
    assert ct.root_split(DecisionTreeClassifier(maxDepth=1).fit(fe.assemble(constant, ["a"]))) is None


def test_logistic_certificate_against_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 2))
    y = (rng.random(500) < 1 / (1 + np.exp(-(x @ [1.5, -0.7] + 0.3)))).astype(float)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, label double")
    w = np.array([0.4, -0.2, 0.1])
    got = ct.logistic_certificate(df, ["a", "b"], F.col("label"), w, 0.05)
    one = np.c_[x, np.ones(500)]
    p = 1 / (1 + np.exp(-one @ w))
    pen = np.array([0.05, 0.05, 0])
    assert got["loss"] == pytest.approx(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)) + (pen * w * w).sum() / 2)
    assert got["gradient"] == pytest.approx((p - y) @ one / 500 + pen * w)
    assert got["curvature"] == pytest.approx((one * (p * (1 - p))[:, None]).T @ one / 500 + np.diag(pen))
    model = LogisticRegression(maxIter=200, tol=1e-12, regParam=0.05, standardization=False).fit(fe.assemble(df, ["a", "b"]))
    best = [*model.coefficients, model.intercept]
    for _ in range(12):  # Newton steps of the certificate itself
        w = w + ct.logistic_certificate(df, ["a", "b"], F.col("label"), w, 0.05)["step"]
    assert w == pytest.approx(best, abs=1e-6)
    assert abs(ct.logistic_certificate(df, ["a", "b"], F.col("label"), best, 0.05)["gradient"]).max() < 1e-6
    far = ct.logistic_certificate(df, ["a"], F.col("label"), [1e6, 0.0], 0.0)
    assert np.isfinite(far["loss"])
    with pytest.raises(ValueError):
        ct.logistic_certificate(df.limit(0), ["a"], F.col("label"), [0, 0], 0)


def test_second_moments_of_unequal_tasks(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(203, 5)) * [1, 2, 3, 4, 5] + 1e6
    df = spark.createDataFrame([(r.tolist(),) for r in x] + [(None,)], "v array<double>").repartition(7)
    n, mean, covariance = ct.second_moments(df, F.col("v"), 5)
    assert n == 203 and mean == pytest.approx(x.mean(0), rel=1e-12) and covariance == pytest.approx(np.cov(x.T), rel=1e-8, abs=1e-8)
    rows = ct.spectrum(df, F.col("v"), 5, 3, target=0.8).collect()
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert [r.variance for r in rows] == pytest.approx(values[:3].tolist(), rel=1e-7)
    assert rows[0].total == pytest.approx(values.sum()) and rows[0].squared == pytest.approx((values**2).sum())
    assert [r.reached_target for r in rows] == (np.cumsum(values / values.sum())[:3] >= 0.8).tolist()
    assert ct.second_moments(df.limit(0), F.col("v"), 5)[0] == 0


def test_partition_balance(spark):
    rows = {r.partitions: r for r in sc.partition_balance(spark.range(1000), (4, 10)).collect()}
    assert rows[4].n_rows == 1000 and rows[10].n_filled == 10 and rows[10].ideal_rows == 100 and 100 <= rows[10].largest <= 120
    none = sc.partition_balance(spark.range(0), (4,)).first()
    assert (none.n_rows, none.n_filled, none.largest, none.largest_share) == (0, 0, 0, None)
