import math

from pyspark.sql import functions as F

from event_ml.functions.columns import count_at_least, literal_table, pct_half_up
from event_ml.functions.joins import join_small


def test_join_small_leaves_the_choice_to_the_planner(spark):
    big = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    small = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    a = join_small(big, small, "k")
    assert "BroadcastHashJoin" in plan(a)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = join_small(big, small, "k")
        assert "SortMergeJoin" in plan(b)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
        assert b.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_literal_table_types_and_specials(spark):
    rows = [(1, float("nan"), "it's", True), (2, float("inf"), None, False), (3, None, "a\\b", None)]
    t = literal_table(spark, rows, "i int, x double, s string, b boolean")
    assert [f.dataType.simpleString() for f in t.schema.fields] == ["int", "double", "string", "boolean"]
    got = t.orderBy("i").collect()
    assert math.isnan(got[0]["x"]) and got[1]["x"] == float("inf") and got[2]["x"] is None
    assert got[0]["s"] == "it's" and got[1]["s"] is None and got[2]["s"] == "a\\b"
    assert [r["b"] for r in got] == [True, False, None]
    assert literal_table(spark, [], "i int").count() == 0


def test_count_at_least_name_and_column_forms(spark):
    df = spark.createDataFrame([(v,) for v in (None, 0.5, 1.0, 1.5, 2.0, 9.0)], "s double")
    thr = [1.0, 2.0, 1.5]
    a = [r[0] for r in df.select(count_at_least(thr, "s")).collect()]
    b = [r[0] for r in df.select(count_at_least(thr, F.col("s"))).collect()]
    assert a == b == [None, 0, 1, 2, 3, 3]


def test_pct_half_up_exact(spark):
    rows = [(1, 3), (2, 3), (6669, 20000), (1, 8), (1_082_001, 40_000_037), (5 * 10**17, 10**18)]
    rows += [(k, t) for t in (40_000_037, 400_000_003, 10**12 + 39) for p in (271, 3333, 9999) for k in range(t * p // 10000 - 3, t * p // 10000 + 4)]
    df = spark.createDataFrame(rows, "c long, t long")
    got = [r[0] for r in df.select(pct_half_up("c", "t", 2)).collect()]
    assert got == [(20000 * c + t) // (2 * t) / 100 for c, t in rows]
    assert got[:5] == [33.33, 66.67, 33.35, 12.5, 2.7]
