import sys

import pytest
from pyspark.sql import functions as F

from event_ml.llm.common import join_weighted, most_frequent, staged
from event_ml.llm.tokens import Recent


@pytest.mark.parametrize("heavy", [1, 3, 2000])
def test_join_weighted_is_a_join(spark, heavy):
    """With no, some and all keys broadcast."""
    rows = [(k, i) for i, k in enumerate("a" * 60 + "bb" + "cdefg" + "zz")]
    big = staged(spark.createDataFrame(rows, "k string, i int"), "t")
    small = staged(big.where("k <> 'z'").groupBy("k").agg(F.count("*").alias("n"), F.min("i").alias("first")), "t")
    got = sorted(tuple(r) for r in join_weighted(big, small, "k", "n", heavy).select("k", "i", "n", "first").collect())
    assert got == sorted(tuple(r) for r in big.join(small, "k").select("k", "i", "n", "first").collect()) and len(got) == 67
    assert join_weighted(big, small.limit(0), "k", "n", heavy).count() == 0


def test_most_frequent_keeps_whole_levels(spark):
    counts = spark.createDataFrame([(i, n) for i, n in enumerate([1] * 50 + [2] * 20 + [1000, 5000])], "k int, n long")
    for at_most, wanted in ((1, {5000}), (5, {1000, 5000}), (30, {2, 1000, 5000}), (100, {1, 2, 1000, 5000}), (0, set())):
        got = most_frequent(counts, "n", at_most)
        assert {r.n for r in got.collect()} == wanted and got.count() <= at_most
    assert most_frequent(counts.limit(0), "n", 5).count() == 0


def test_recent_lets_go_of_what_was_used_once():
    table = Recent(10)
    table.put("kept", 1)
    for i in range(1000):
        assert table.get("kept") == 1
        table.put(i, i)
        assert len(table.young) + len(table.old) <= 21
    assert table.get(3) is None and table.get(999) == 999


def test_a_missing_library_is_an_error(monkeypatch):
    import __spark_entry__ as entry

    for name in [m for m in sys.modules if m.startswith("event_ml.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "zstandard", None)
    with pytest.raises(ModuleNotFoundError, match="zstandard"):
        entry._llm()
