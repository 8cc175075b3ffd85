import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from event_ml.llm import line_dedup, multiset_hash


def slow_dedup(rows, min_chars):
    """{(id, text): (text, n_lines, n_deleted)} by comparing all places."""
    docs = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    lines = [t.split("\n") for _, t in docs]
    places, out = defaultdict(list), {}
    for d, own in enumerate(lines):
        for p, line in enumerate(own):
            places[line].append((d, p))
    for d, own in enumerate(lines):
        gone = set()
        for p, line in enumerate(own):
            longest = 0
            for e, q in places[line]:
                if (e, q) >= (d, p):
                    break
                n = 0
                while p + n < len(own) and q + n < len(lines[e]) and own[p + n] == lines[e][q + n]:
                    n += 1
                longest = max(longest, n)
            if longest and sum(len(x.strip(" ")) for x in own[p : p + longest]) >= min_chars:
                gone |= set(range(p, p + longest))
        out[docs[d]] = ("\n".join(x for i, x in enumerate(own) if i not in gone), len(own), len(gone))
    return out


def test_op7_against_all_places(spark, small_dir, texts):
    wanted = slow_dedup(list(texts.items()), 1)
    got = line_dedup.op7_line_suffix_array(spark, small_dir).collect()
    assert {(r.doc_id, texts[r.doc_id]): (r.text, r.n_lines, r.n_deleted) for r in got} == wanted


@pytest.mark.parametrize("min_chars", [1, 4])
def test_runs_of_few_lines(spark, min_chars):
    rng = random.Random(min_chars)
    rows = [(i, "\n".join(rng.choice(["a", "b", "", " c "]) for _ in range(rng.randint(1, 13)))) for i in range(14)]
    rows += [(None, rows[3][1]), (20, rows[5][1] + "\n" + rows[6][1])]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").withColumn("t", F.col("text")), min_chars).collect()
    assert {(r.doc_id, r.t): (r.text, r.n_lines, r.n_deleted) for r in got} == slow_dedup(rows, min_chars)


def test_classes_spread_over_tasks(spark, monkeypatch):
    """With every class spread, the same lines go."""
    rng = random.Random(8)
    rows = [(i, "\n".join(rng.choice(["a", "bb", "c d", "", "e"]) for _ in range(rng.randint(1, 9)))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("t", F.col("text"))
    monkeypatch.setattr(line_dedup, "repeated_lines", lambda numbered, own=line_dedup.repeated_lines: (own(numbered)[0], 2))
    got = line_dedup.dedup_lines(df).collect()
    assert {(r.doc_id, r.t): (r.text, r.n_lines, r.n_deleted) for r in got} == slow_dedup(rows, 1)


def test_lines_of_odd_rows(odd_docs, no_docs):
    rows = line_dedup.dedup_lines(odd_docs.withColumn("n_lines", F.lit("x")), 20)
    assert sorted(rows.columns) == sorted({*odd_docs.columns, "n_lines", "n_deleted"})
    got = defaultdict(list)
    for r in rows.collect():
        got[r.doc_id].append((r.text, r.n_lines, r.n_deleted))
    text = odd_docs.where("doc_id = 1").first().text
    assert got[1] == [(text, 3, 0)] and got[5] == [("", 3, 3)] * 2
    assert got[2] == [(None, None, None)] and got[3] == [("", 1, 0)]
    assert got[None] == [("", 1, 1)] and got[7][0][2] == 0
    assert line_dedup.dedup_lines(no_docs).count() == 0


def slow_edits(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    for i, (k, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        cut = len(text) // 3
        yield k, text, text[: len(text) - cut] + following[:cut], following


def squared(a):
    return sum(v * v for v in a.values())


def pieces(text):
    return Counter(x for x in re.split(r"(?<=\n)|(?<=[.!?] )", text) if x)


def test_op4_against_python(spark, small_dir, texts):
    got = {r.doc_id: r for r in multiset_hash.op4_multiset_hash(spark, small_dir).collect()}
    assert len(got) == len(texts)
    errors, prints = [], defaultdict(set)
    for k, text, edited, following in slow_edits(texts.items()):
        r = got[k]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        prints[text].add(r.fingerprint)
        prints[edited].add(r.edited_fingerprint)
        for other, near in ((edited, r.near_edited), (following, r.near_next)):
            a, b = pieces(text), pieces(other)
            exact = 1 - (squared(a - b) + squared(b - a)) / max(1, squared(a) + squared(b))
            errors.append(abs(near - exact))
    assert all(len(x) == 1 for x in prints.values())
    assert sum(errors) / len(errors) < 0.08 and max(errors) < 0.45


def test_order_insertion_deletion(spark):
    base = spark.createDataFrame([("a\nb\nb. c\n", "b. c\na\nb\n", "b. c\n", "a\nb\n")], "x string, y string, part string, rest string")
    fps = base.select(*[multiset_hash.summed(multiset_hash.piece_hashes(multiset_hash.pieces(F.col(c)))).alias(c) for c in base.columns])
    x, y, part, rest = (spark.createDataFrame(fps.collect(), fps.schema).select(F.col(c)).first()[0] for c in base.columns)
    assert x == y != part
    one = spark.createDataFrame([(x, part, rest)], "x array<long>, part array<long>, rest array<long>")
    got = one.select(multiset_hash.delete(F.col("x"), F.col("part")).alias("d"), multiset_hash.insert(F.col("part"), F.col("rest")).alias("i")).first()
    assert (got.d, got.i) == (rest, x)


def test_lanes_wrap(spark):
    """More pieces than a lane counts: sums stay modulo two to the twentieth."""
    many = spark.range(1).select(F.array(F.transform(F.sequence(F.lit(1), F.lit((1 << 20) + 5)), lambda i: F.lit(-1).cast("long")), F.array(F.lit(-1).cast("long"))).alias("h"))
    assert many.select(multiset_hash.summed(F.col("h")).alias("fp")).first().fp[1:3] == [sum(5 << s for s in multiset_hash.SHIFTS)] * 2


def test_fingerprints_of_odd_rows(odd_docs, no_docs):
    rows = multiset_hash.fingerprint_edits(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = defaultdict(set)
    for r in rows:
        by[r.doc_id].add((r.n_chars, r.fingerprint))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert by[2] == by[3] and by[1] == by[5] and by[7] == by[None] and len(by[5]) == 1
    single = multiset_hash.fingerprint_edits(odd_docs.where("doc_id = 9")).first()
    assert single.near_next == 1.0
    assert multiset_hash.fingerprint_edits(no_docs).count() == 0
