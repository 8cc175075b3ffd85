import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from event_ml.llm import merkle


def h(*values):
    return hashlib.sha256("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values).encode()).hexdigest()


def joined(digests):
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([joined(levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def slow_manifest(rows):
    """[(doc_id, leaf, subroot, root, proof, folded, verified)] of (doc_id, source, lang, n_chars, text)."""
    trees = defaultdict(list)
    for r in rows:
        text = r[4]
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text) if hit else text
        trees[r[1]].append((r[0] is not None, r[0] or 0, h(*r), h(*r[:4], lower), r[0]))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: levels_of([x[2] for x in sorted(trees[s])]) for s in names}
    top = levels_of([built[s][-1][0] for s in names])
    out = []
    for rank, s in enumerate(names):
        for idx, (_, _, leaf, own, doc) in enumerate(sorted(trees[s])):
            proof = ""
            for levels, i in ((built[s], idx), (top, rank)):
                for level in levels[:-1]:
                    run = level[i // 16 * 16 : i // 16 * 16 + 16]
                    proof += "".join(run[: i % 16] + run[i % 16 + 1 :])
                    own = joined(run[: i % 16] + [own] + run[i % 16 + 1 :])
                    i //= 16
            root = top[-1][0]
            out.append((doc, leaf, built[s][-1][0], root, hashlib.sha256(proof.encode()).hexdigest(), own, own == root))
    return out


def rows_of(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def check(spark, rows):
    got = rows_of(merkle.prove(spark.createDataFrame(rows, SCHEMA)))
    assert got == sorted(slow_manifest(rows), key=str)
    return got


def test_op11_against_brute_force(spark, small_dir, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = rows_of(merkle.op11_merkle_climb(spark, small_dir))
    assert got == sorted(slow_manifest(rows), key=str)
    assert {r[6] for r in got} == {True, False}


def test_trees_of_every_height(spark):
    """4 levels and a block boundary (4,500 rows), two levels, runs of 16 and 17, single leaves, a null source."""
    sizes = {"big": 4500, "b": 257, "c": 17, "d": 16, "é": 2, "e": 1, None: 1, "": 3}
    rows = [(i * 7 % 9001, s, None if i % 3 else "en", i, f"Text {i} A") for s, n in sizes.items() for i in range(n)]
    check(spark, rows)


def test_many_sources(spark):
    check(spark, [(i, f"s{i % 300}", "en", 1, "T" * (i % 4)) for i in range(330)])


@pytest.mark.parametrize("rows", [[(1, "s", "en", 1, "A")], [(None, None, None, None, None)], [(5, "a", "x", 1, "B"), (5, "b", "x", 1, "B")]])
def test_single_leaves(spark, rows):
    got = check(spark, rows)
    assert len(rows) > 1 or got[0][1] == got[0][2] == got[0][3]


def test_odd_rows(spark, odd_docs, no_docs):
    """Nulls, empty and long texts, repeated rows, and columns named like the operator's own."""
    odd = odd_docs.withColumn("leaf", F.lit("x")).withColumn("tree", F.lit(3)).withColumn("src", F.lit("y")).withColumn("one", F.lit(9)).withColumn("n", F.lit("z"))
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in odd.collect()]
    got = rows_of(merkle.prove(odd))
    assert got == sorted(slow_manifest(rows), key=str)
    assert merkle.prove(no_docs).count() == 0 and merkle.prove(no_docs).columns == merkle.prove(odd).columns


def test_only_the_changed_leaf_fails(spark):
    """A change in one text is seen by that leaf's climb alone, and every climb uses stored siblings."""
    rows = [(i, "s", "en", 1, "abc") for i in range(40)]
    hit = next(i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 0)
    rows[hit] = (hit, "s", "en", 1, "Abc")
    got = check(spark, rows)
    assert [r[0] for r in got if not r[6]] == [hit]


def test_the_row_limit_is_put_back(spark, documents):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    merkle.prove(documents.limit(3)).count()
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
