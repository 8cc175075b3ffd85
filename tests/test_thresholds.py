import random

import pytest

from event_ml.operators import thresholds as th


def brute_curve(rows, thresholds, cost_fn=3, cost_fp=1):
    out = {}
    labels = [y for y, _ in rows]
    for t in thresholds:
        tp = sum(1 for y, s in rows if y == 1 and s >= t)
        fp = sum(1 for y, s in rows if y == 0 and s >= t)
        tn = sum(1 for y, s in rows if y == 0 and s < t)
        fn = sum(1 for y, s in rows if y == 1 and s < t)
        preds = {1 if s >= t else 0 for _, s in rows}
        if len(set(labels) | preds) < 2:
            continue
        out[t] = (tp, fp, tn, fn, cost_fn * fn + cost_fp * fp)
    return out


def make(spark, rows):
    return spark.createDataFrame([(float(y), float(s)) for y, s in rows], "label double, score double")


def test_cost_curve_matches_brute_force(spark):
    rng = random.Random(7)
    rows = [(rng.randint(0, 1), round(rng.random(), 2)) for _ in range(500)]
    thr = th.default_thresholds()
    got = {r["threshold"]: (r["tp"], r["fp"], r["tn"], r["fn"], r["cost"])
           for r in th.cost_curve(make(spark, rows), "score", "label", thr).collect()}
    assert got == brute_curve(rows, thr)
    assert len(thr) == 80 and thr[0] == 0.1 and thr[-1] == 0.89


def test_counts_add_up_at_every_threshold(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 1), rng.random()) for _ in range(300)]
    for r in th.cost_curve(make(spark, rows), "score", "label").collect():
        assert r["tp"] + r["fp"] + r["tn"] + r["fn"] == 300


def test_single_class_guard(spark):
    # all negatives; predictions all negative above 0.5 -> those rows vanish
    rows = [(0, 0.3), (0, 0.4)]
    got = th.cost_curve(make(spark, rows), "score", "label", [0.2, 0.35, 0.5]).collect()
    assert sorted(r["threshold"] for r in got) == [0.2, 0.35]
    assert {r["threshold"] for r in got} == set(brute_curve(rows, [0.2, 0.35, 0.5]))


def test_empty_input(spark):
    df = spark.createDataFrame([], "label double, score double")
    assert th.cost_curve(df, "score", "label").count() == 0


def test_optimum_first_minimum_on_ties(spark):
    rows = [(1, 0.9), (0, 0.1)]  # every threshold in (0.1, 0.9] is perfect
    curve = th.cost_curve(make(spark, rows), "score", "label", [0.2, 0.3, 0.4])
    opt = th.cost_optimum(curve).collect()[0]
    assert opt["threshold"] == 0.2 and opt["cost"] == 0


def test_ratio_sweep_and_reduction(spark):
    rng = random.Random(11)
    rows = [(rng.randint(0, 1), rng.random()) for _ in range(400)]
    curve = th.cost_curve(make(spark, rows), "score", "label").cache()
    sweep = {r["fn_weight"]: r for r in th.cost_ratio_sweep(curve).collect()}
    pts = curve.collect()
    for w in range(1, 11):
        best = min(pts, key=lambda r: (w * r["fn"] + r["fp"], r["threshold"]))
        assert sweep[w]["threshold"] == best["threshold"]
    red = th.cost_reduction(curve, 0.5).collect()[0]
    assert red["min_cost"] <= red["baseline_cost"]


def test_confusion_grid_and_metrics_vs_mllib(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rng = random.Random(5)
    data = [(float(rng.randint(0, 1)), float(rng.randint(0, 1))) for _ in range(200)]
    df = spark.createDataFrame(data, "label double, prediction double")
    counts = th.confusion_counts(df)
    assert counts.count() == 4
    got = th.classification_metrics(counts, digits=10).collect()[0]
    for metric, col in (("accuracy", "accuracy"), ("f1", "f1"),
                        ("weightedPrecision", "weighted_precision"), ("weightedRecall", "weighted_recall")):
        ev = MulticlassClassificationEvaluator(metricName=metric).evaluate(df)
        assert got[col] == pytest.approx(ev, abs=1e-9)


def test_confusion_completes_missing_cells(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "label double, prediction double")
    cells = {(r["label"], r["prediction"]): r["n"] for r in th.confusion_counts(df).collect()}
    assert cells == {(0.0, 0.0): 0, (0.0, 1.0): 0, (1.0, 0.0): 0, (1.0, 1.0): 2}
    norm = th.confusion_normalised(th.confusion_counts(df)).collect()
    assert {r["rate"] for r in norm if r["label"] == 1.0} == {0.0, 1.0}
