import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from event_ml.operators import features as fe
from event_ml.operators import models as md
from event_ml.operators import resample as rs
from event_ml.operators import scaling as sc
from event_ml.operators import splits as sp
from event_ml.sources.generate import synthetic_events

FEATS = ["lepton_pT", "lepton_eta", "lepton_phi", "m_bb"]


@pytest.fixture(scope="module")
def data(spark):
    ev = synthetic_events(spark, 4000, signal=3.0, partitions=4).withColumn("key", F.col("event_id").cast("string"))
    vec = fe.assemble(ev, FEATS, "raw")
    tagged = sp.with_split(vec, "key", ["train", "test"], [0.75, 0.25], salt="m")
    train = tagged.filter("split = 'train'")
    scaler = fe.fit_scaler(train, "raw", "features")
    tr = scaler.transform(train).select("key", "label", "features").cache()
    te = scaler.transform(tagged.filter("split = 'test'")).select("key", "label", "features").cache()
    return tr, te


@pytest.mark.parametrize("name", ["LogisticRegression", "SVM"])
def test_linear_models_learn_planted_signal(data, name):
    tr, te = data
    model, row = md.train_and_evaluate(name, tr, te)
    r = row.collect()[0]
    assert r["val_auc"] > 0.8 and r["train_time_s"] > 0
    preds = {x[0] for x in model.transform(te).select("prediction").distinct().collect()}
    assert preds <= {0.0, 1.0}


def test_forest_and_importances(spark, data):
    tr, te = data
    model = md.make_estimator("RandomForest", numTrees=10, maxDepth=4).fit(tr)
    assert model.getNumTrees == 10
    imp = md.feature_importances(spark, model, FEATS).collect()
    assert {r["feature"] for r in imp} == set(FEATS)
    top = max(imp, key=lambda r: r["importance"])["feature"]
    assert top in ("lepton_pT", "lepton_eta")


def test_save_load_same_predictions(data, scratch):
    tr, te = data
    model = md.make_estimator("GBT", maxIter=5).fit(tr)
    path = os.path.join(scratch, "gbt")
    md.save_model(model, path)
    again = md.load_model("GBT", path)
    a = model.transform(te).select("prediction").collect()
    b = again.transform(te).select("prediction").collect()
    assert a == b


def test_cross_validate_hash_folds(data):
    tr, _ = data
    folded = tr.withColumn("fold", sp.split_index("key", [1, 1, 1], salt="f"))
    cv = md.cross_validate(folded, "LogisticRegression", {"regParam": [0.01, 0.1]}, num_folds=3)
    rows = cv.collect()
    assert len(rows) == 2 and all(0.5 < r["avg_auc"] <= 1.0 for r in rows)


def test_bootstrap_ci_properties(spark):
    import random

    rng = random.Random(0)
    rows = [(float(y), rng.random() + 0.3 * y) for y in [rng.randint(0, 1) for _ in range(2000)]]
    df = spark.createDataFrame(rows, "label double, score double")
    reps = {r["replicate"]: r["auc"] for r in rs.bootstrap_auc(df, "score", "label", 100, 7, n_blocks=1).collect()}
    assert len(reps) == 100 and len(set(reps.values())) > 90  # replicates differ
    blocks = {r["replicate"]: r["auc"] for r in rs.bootstrap_auc(df, "score", "label", 100, 7, n_blocks=7).collect()}
    assert reps == pytest.approx(blocks, abs=1e-12)  # blocks do not change any replicate
    ci = rs.bootstrap_ci(rs.bootstrap_auc(df, "score", "label", 100, 7)).collect()[0]
    assert ci["ci_low"] <= ci["mean"] <= ci["ci_high"]


def test_draw_tree_is_a_multinomial_with_a_fixed_total():
    """Rows' counts: fixed totals, the same from any task, mean 1, variance and covariance of a multinomial."""
    n, boots = 5000, 400
    whole = rs.DrawTree(3, 1, n, boots).below(np.arange(n + 1))
    assert (whole[:, 0] == 0).all() and (whole[:, -1] == n).all()
    counts = np.diff(whole, axis=1)
    assert counts.min() == 0 and not (counts[0] == counts[1]).all()
    for ends in ([0, 1, 1023, 1024, 1025], [2048, 4999, 5000], [700], [], [5000]):
        assert (rs.DrawTree(3, 1, n, boots).below(np.array(ends, np.int64)) == whole[:, ends]).all()
    assert abs(counts.mean(0).std() - 1 / np.sqrt(boots)) < 0.005 and abs(counts.var() - 1) < 0.01
    halves = np.stack([whole[:, 2500], n - whole[:, 2500]])
    assert 0.85 < halves[0].std() / np.sqrt(n / 4) < 1.15
    for other in (rs.DrawTree(4, 1, n, boots), rs.DrawTree(3, 0, n, boots)):
        assert (other.below(np.arange(n + 1)) != whole).any()
    assert rs.DrawTree(3, 1, 0, boots).below(np.zeros(2, np.int64)).tolist() == [[0, 0]] * boots
    assert (rs.DrawTree(3, 1, 1, boots).below(np.arange(2)) == [0, 1]).all()


@pytest.mark.parametrize("sizes", [(1, 1), (3, 1500), (1025, 1024)])
def test_replicates_keep_class_sizes(spark, sizes):
    rows = [(float(y), (i * 7919 % 101) / 10 + y) for y in (0, 1) for i in range(sizes[y])]
    df = spark.createDataFrame(rows, "label double, score double")
    got = rs.bootstrap_auc(df, "score", "label", 20, 1, n_blocks=3).collect()
    assert len(got) == 20 and {(r["n_neg"], r["n_pos"]) for r in got} == {sizes}
    assert all(0 <= r["auc"] <= 1 for r in got)
    assert rs.bootstrap_auc(df.limit(0), "score", "label", 20, 1).count() == 0
    one_class = rs.bootstrap_auc(df.where("label = 1"), "score", "label", 20, 1).collect()
    assert {r["auc"] for r in one_class} == {None}


def test_bootstrap_of_many_equal_scores(spark):
    """Mean and spread of the replicates against the exact AUC and a
    resampling of the rows themselves."""
    import random

    from event_ml.operators import metrics as m

    rng = random.Random(3)
    rows = [(float(y), round(rng.random() + 0.3 * y, 1)) for y in [rng.randint(0, 1) for _ in range(3000)]]
    df = spark.createDataFrame(rows, "label double, score double")
    exact = m.auc_exact(df, "score", "label").first()["auc"]
    got = [r["auc"] for r in rs.bootstrap_auc(df, "score", "label", n_boot=300, seed=5).collect()]
    y, s = (np.array(c) for c in zip(*rows))
    draw, own = np.random.default_rng(1), []
    for _ in range(300):
        p, n = draw.choice(s[y == 1], (y == 1).sum()), np.sort(draw.choice(s[y == 0], (y == 0).sum()))
        own.append(((np.searchsorted(n, p, "left") + np.searchsorted(n, p, "right")) / 2).mean() / len(n))
    assert abs(np.mean(got) - exact) < 4 * np.std(own) / np.sqrt(300)
    assert 0.8 < np.std(got) / np.std(own) < 1.25


def test_a_failing_model_has_a_status(data):
    tr, te = data
    fitted, status = md.fit_all(tr, te, {"LogisticRegression": {"maxIter": 5}, "GBT": {"maxDepth": 99}})
    got = {r["model"]: r["status"] for r in status.collect()}
    assert got == {"LogisticRegression": "ok", "GBT": "failed"} and list(fitted) == ["LogisticRegression"]


def test_stability_and_group_stats(data, spark):
    tr, te = data
    st = rs.stability(tr, te, "key", lambda d: md.make_estimator("LogisticRegression", maxIter=10).fit(d),
                      levels=(0.1, 0.2), trials=2)
    rows = st.collect()
    assert len(rows) == 4 and all(r["test_auc"] > 0.8 for r in rows)
    g = rs.group_mean_std(st, "perturbation_pct", "test_auc").collect()
    assert len(g) == 2 and all(r["band_low"] <= r["mean"] <= r["band_high"] for r in g)


def test_scaling_tables(data, spark):
    tr, _ = data
    fit = lambda d: md.make_estimator("RandomForest", numTrees=2, maxDepth=3).fit(d)
    t = sc.ideal_line(sc.strong_scaling(tr, fit, (2, 4))).orderBy("partitions").collect()
    assert [r["partitions"] for r in t] == [2, 4]
    assert t[1]["ideal_time_s"] == pytest.approx(t[0]["time_s"] / 2)
