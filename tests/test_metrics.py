import random

import pytest
from pyspark.sql import functions as F

from event_ml.functions.prefix import ordered_prefix
from event_ml.operators import metrics as m


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    wins = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    return wins / (len(pos) * len(neg))


def brute_ap(rows):
    P = sum(y for y, _ in rows)
    ap, prev_r = 0.0, 0.0
    for t in sorted({s for _, s in rows}, reverse=True):
        tp = sum(1 for y, s in rows if y == 1 and s >= t)
        fp = sum(1 for y, s in rows if y == 0 and s >= t)
        r = tp / P
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    return ap


def frame(spark, rows):
    return spark.createDataFrame([(float(y), float(s)) for y, s in rows], "label double, score double")


@pytest.fixture(scope="module")
def tied(spark):
    rng = random.Random(1)
    rows = [(rng.randint(0, 1), rng.randint(0, 20) / 20) for _ in range(600)]
    return rows, frame(spark, rows)


def test_exact_auc_with_ties(tied):
    rows, df = tied
    auc = m.auc_exact(df, "score", "label").collect()[0]["auc"]
    assert auc == pytest.approx(brute_auc(rows), abs=1e-12)


def test_auc_symmetry(tied, spark):
    rows, df = tied
    a = m.auc_exact(df, "score", "label").collect()[0]["auc"]
    flipped = df.withColumn("score", 1 - F.col("score"))
    b = m.auc_exact(flipped, "score", "label").collect()[0]["auc"]
    assert a == pytest.approx(1 - b, abs=1e-12)


def test_trapezoid_equals_exact_and_evaluator(tied, spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rows, df = tied
    ranked = m.ranked_scores(df, "score", "label")
    trap = m.roc_auc_trapezoid(ranked).collect()[0]["roc_auc"]
    exact = m.auc_exact(df, "score", "label").collect()[0]["auc"]
    assert trap == pytest.approx(exact, abs=1e-12)
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", metricName="areaUnderROC").evaluate(df)
    assert ev == pytest.approx(exact, abs=1e-9)
    pr_ev = BinaryClassificationEvaluator(rawPredictionCol="score", metricName="areaUnderPR").evaluate(df)
    assert m.auc_pr(ranked).collect()[0]["auc_pr"] == pytest.approx(pr_ev, abs=1e-9)


def test_average_precision(tied):
    rows, df = tied
    ap = m.average_precision(m.ranked_scores(df, "score", "label")).collect()[0]["average_precision"]
    assert ap == pytest.approx(brute_ap(rows), abs=1e-12)


def test_roc_monotone_and_endpoints(tied):
    _, df = tied
    pts = m.roc_points(m.ranked_scores(df, "score", "label")).collect()
    pts = sorted(pts, key=lambda r: (r["fpr"], r["tpr"]))
    assert pts[0]["fpr"] == 0.0 and pts[0]["tpr"] == 0.0
    assert pts[-1]["fpr"] == 1.0 and pts[-1]["tpr"] == 1.0
    assert all(a["tpr"] <= b["tpr"] for a, b in zip(pts, pts[1:]))
    pr = m.pr_points(m.ranked_scores(df, "score", "label")).collect()
    assert any(r["threshold"] is None and r["precision"] == 1.0 and r["recall"] == 0.0 for r in pr)


def test_prefix_does_not_depend_on_blocks(spark):
    rng = random.Random(9)
    rows = [(g, i, rng.randint(0, 5)) for g in ("a", "b") for i in range(400)]
    df = spark.createDataFrame(rows, "g string, k long, v long")
    small = ordered_prefix(df, "k", ["v"], ["g"], descending=True, n_blocks=1)
    big = ordered_prefix(df, "k", ["v"], ["g"], descending=True, n_blocks=11)
    a = sorted((r["g"], r["k"], r["v_cum"]) for r in small.collect())
    b = sorted((r["g"], r["k"], r["v_cum"]) for r in big.collect())
    assert a == b


def test_auc_does_not_depend_on_blocks(tied):
    rows, df = tied
    a = m.auc_exact(df, "score", "label", n_blocks=1).collect()[0]["auc"]
    b = m.auc_exact(df, "score", "label", n_blocks=9).collect()[0]["auc"]
    assert a == b


def test_auc_of_billions_of_rows(spark):
    """Counts whose products don't fit a long."""
    n = 6 * 10**9
    ranked = spark.createDataFrame(
        [(2.0, n, 0, n, 0, n, n), (1.0, 0, n, n, n, n, n)], "score double, pos long, neg long, tp long, fp long, n_pos long, n_neg long"
    )
    assert m.auc_from_ranked(ranked).first()["auc"] == 1.0


def test_no_table_stays_persisted(spark, tied):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    m.auc_exact(tied[1], "score", "label").collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_grouped_auc_and_leaderboard(spark):
    rng = random.Random(2)
    rows = [(g, float(rng.randint(0, 1)), rng.random()) for g in (1, 2, 3) for _ in range(100)]
    df = spark.createDataFrame(rows, "model int, label double, score double")
    per = {r["model"]: r["auc"] for r in m.auc_exact(df, "score", "label", ["model"]).collect()}
    for g in (1, 2, 3):
        assert per[g] == pytest.approx(brute_auc([(y, s) for gg, y, s in rows if gg == g]), abs=1e-12)
    board = m.leaderboard(m.auc_exact(df, "score", "label", ["model"]), "auc", "model").collect()
    best = max(per, key=per.get)
    assert [r["model"] for r in board if r["rank"] == 1] == [best]


@pytest.mark.parametrize("n_blocks", [1, 4, 9])
def test_reduced_roc_keeps_bends_and_area(spark, n_blocks):
    """Against the definition over the whole list of points, at every cut into blocks."""
    rng = random.Random(n_blocks)
    rows = [(y, s) for s in range(120) for y in rng.choice([[0], [1], [0], [0, 1]])]
    df = frame(spark, rows)
    ranked = m.ranked_scores(df, "score", "label", n_blocks=n_blocks, neighbours=True)
    every = sorted((r.tp, r.fp, r.threshold) for r in m.roc_points(ranked).collect() if r.threshold is not None)
    got = sorted((r.tp, r.fp, r.threshold) for r in m.roc_points(ranked, drop_collinear=True).collect() if r.threshold is not None)
    step = lambda i: (every[i][0] - every[i - 1][0], every[i][1] - every[i - 1][1])
    wanted = [x for i, x in enumerate(every) if i in (0, len(every) - 1) or step(i) != step(i + 1)]
    assert got == wanted and len(got) < len(every)
    area = lambda pts: sum((f - g) * (t + u) / 2 for (u, g, _), (t, f, _) in zip([(0, 0, 0), *pts], pts))
    assert area(got) == area(every)


def test_reduced_roc_by_group(spark):
    df = frame(spark, [(i % 2, i % 7) for i in range(40)]).withColumn("g", F.col("score") > 3)
    ranked = m.ranked_scores(df, "score", "label", ["g"], n_blocks=5, neighbours=True)
    last = {r.g: (r.pos_next, r.neg_next) for r in ranked.where("tp = n_pos AND fp = n_neg").collect()}
    assert last == {True: (None, None), False: (None, None)}
    assert ranked.where("pos_next IS NULL").count() == 2


@pytest.mark.parametrize("bins", [1, 7, 20, 1000])
def test_binned_auc_equals_the_evaluator(spark, bins):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = random.Random(bins)
    rows = [(y, round(rng.random() + 0.3 * y, 3)) for y in (rng.randint(0, 1) for _ in range(900))]
    df = frame(spark, rows).coalesce(1)
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=bins)
    got = m.auc_binned(df, "score", "label", bins, n_blocks=5).first()
    # the evaluator's groups end at its partitions' ends: one partition
    assert got.auc == pytest.approx(ev.evaluate(df), abs=1e-12)
    assert got.auc_pr == pytest.approx(ev.setMetricName("areaUnderPR").evaluate(df), abs=1e-12)
    assert m.auc_binned(df.where("label = 1"), "score", "label", bins).first().auc is None
