import math
import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from event_ml.llm import decontaminate, simhash


def slow_fingerprint(text, n=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ")
    for c in "\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, max_bits=4):
    """Smallest id by (id, fingerprint) over all pairs."""
    ids, fps = [r[0] for r in rows], np.array([r[1] for r in rows], np.uint64)
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= max_bits):
            a, b = find(i), find(int(j))
            label[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(ids[i])
    least = {g: min((x for x in own if x is not None), default=None) for g, own in groups.items()}
    return [least[find(i)] for i in range(len(rows))]


def test_op6_against_all_pairs(spark, small_dir, texts):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op6_simhash_pivot_tables(spark, small_dir).collect()}
    fps = [(k, slow_fingerprint(t)) for k, t in sorted(texts.items())]
    assert {k: v[0] for k, v in got.items()} == {k: f"{fp:016x}" for k, fp in fps}
    assert [got[k][1] for k, _ in fps] == components(fps)


@pytest.mark.parametrize("max_bucket", [2048, 2])
def test_links_of_dense_groups(spark, max_bucket):
    """Chains, a ball of near fingerprints and random ones, compared or by midpoints."""
    rng = random.Random(4)
    fps = {rng.getrandbits(64) for _ in range(150)}
    centre = rng.getrandbits(64)
    for _ in range(60):
        fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    chain = rng.getrandbits(64)
    for _ in range(15):
        chain ^= sum(1 << b for b in rng.sample(range(64), 4))
        fps.add(chain)
    rows = [(simhash.signed(f), f) for f in fps]
    prints = spark.createDataFrame([(s,) for s, _ in rows], "fp long")
    from event_ml.llm.common import connected_components

    roots = {r.node: r.root for r in connected_components(simhash.links(prints, 4, max_bucket), "t").collect()}
    assert [roots.get(s, s) for s, _ in rows] == components(rows)


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    by = {(r.doc_id, r.fingerprint): r.component_id for r in got}
    assert len(got) == odd_docs.count()
    assert {i: c for (i, f), c in by.items() if f == "0" * 16} == {2: 2, 3: 2, 4: 2}
    assert [c for (i, _), c in by.items() if i in (1, 5)] == [1, 1]
    assert [c for (i, _), c in by.items() if i in (None, 7)] == [7, 7]
    assert simhash.near_duplicates(no_docs).count() == 0
    with pytest.raises(ValueError):
        simhash.links(odd_docs, 3, 10)


def test_one_row_of_each_group_stays(odd_docs, no_docs):
    kept = simhash.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 7, 8, 9]
    only_null = odd_docs.where("doc_id IS NULL OR doc_id = 9")
    assert sorted((r.doc_id is None) for r in simhash.drop_near_duplicates(only_null.unionByName(only_null)).collect()) == [False, True]
    assert simhash.drop_near_duplicates(no_docs).count() == 0


def test_components_that_share_an_id_or_have_none(spark):
    words = ITEM.split()
    unlike = [" ".join(words), " ".join(reversed(words))]
    rows = [(1, t) for t in unlike] + [(2, t) for t in unlike]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect())) == sorted((1, t) for t in unlike)
    long = [f"w{i}" for i in range(2000)]
    near = [" ".join(long), " ".join([*long[:-1], "other"])]
    fps = [simhash.fingerprint(t, 4) for t in near]
    assert fps[0] != fps[1] and (fps[0] ^ fps[1]).bit_count() <= 4
    assert simhash.drop_near_duplicates(spark.createDataFrame([(None, t) for t in near], "doc_id long, text string")).count() == 1


def test_masks_share_three_blocks():
    masks = simhash.block_masks(4)
    assert len(masks) == 35 and sum(m.bit_count() for m in masks) == 64 * 15
    rng = random.Random(1)
    for _ in range(300):
        flipped = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not flipped & m for m in masks)


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def overlaps(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontaminate.find_overlaps(d, b, **options).collect()}


def test_substitutions_are_tolerated(spark):
    words = ITEM.split()
    other = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen".split()
    for places in ((), (5,), (3, 11), (2, 9, 16)):
        changed = [("zzz" if i in places else w) for i, w in enumerate(words)]
        got = overlaps(spark, [(1, " ".join([*other, *changed, *other])), (2, " ".join(other * 5))], [(7, ITEM), (8, " ".join(reversed(words)))])
        assert list(got) == [(1, 7)]
        r = got[1, 7]
        assert (r.doc_start, r.item_start, r.n_words, r.n_equal) == (14, 0, 20, 20 - len(places))


def test_short_stretches_and_case(spark):
    words = ITEM.split()
    docs = [(1, " ".join(words[:11])), (2, " ".join(words[:12]).upper()), (3, ITEM.replace(" ", ", ") + "."), (4, None), (5, ""), (6, "x " * 30_000 + ITEM)]
    assert set(overlaps(spark, docs, [(7, ITEM), (7, ITEM), (None, None), (9, "")])) == {(2, 7), (3, 7), (6, 7)}
    short = overlaps(spark, [(1, "go alpha beta gamma delta epsilon zeta eta theta now")], [(7, "alpha beta gamma delta epsilon zeta eta theta")])
    assert set(short) == {(1, 7)}


def test_every_overlap_with_short_items(spark):
    """All items of 1 to 14 words, under all substitutions that the ratio allows, cut documents and a script without blanks."""
    words, docs, items = ITEM.split(), [], []
    for n in range(1, 15):
        own = [f"{w}{n}" for w in words[:n]]
        items.append((n, " ".join(own)))
        for differ in range(n - math.ceil(0.8 * n) + 1):
            for places in combinations(range(n), differ):
                changed = [("zzz" if i in places else w) for i, w in enumerate(own)]
                docs.append((n, " ".join(["go", *changed, "now"])))
                docs.append((n, " ".join(changed).removeprefix("zzz ").removesuffix(" zzz")))
        docs.append((100, " ".join(["zzz"] * (n - math.ceil(0.8 * n) + 1) + own[n - math.ceil(0.8 * n) + 1 :])))
    items += [(20, "今天天气很好"), (21, "วันนี้อากาศดี")]
    docs += [(20, "他说今天天气很好。"), (21, "เขาว่าวันนี้อากาศดีมาก"), (100, "今天下雨")]
    numbered = [(i, text) for i, (_, text) in enumerate(docs)]
    assert set(overlaps(spark, numbered, items)) == {(i, n) for i, (n, _) in enumerate(docs) if n != 100}


def test_op5_against_all_runs(spark, small_dir, texts):
    """Every document with a run of twelve words of an item is found, others aren't."""
    items = {r.item_id: r.text for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()}
    runs = {}
    for k, t in items.items():
        ids = decontaminate._WORD.findall(t.lower())
        for i in range(len(ids) - 11):
            runs.setdefault(tuple(ids[i : i + 12]), set()).add(k)
    wanted = set()
    for k, t in texts.items():
        ids = decontaminate._WORD.findall((t or "").lower())
        wanted |= {(k, item) for i in range(len(ids) - 11) for item in runs.get(tuple(ids[i : i + 12]), ())}
    got = {(r.doc_id, r.item_id) for r in decontaminate.op5_spaced_seeds(spark, small_dir).collect()}
    assert wanted and got == wanted


def test_decontamination_of_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "and it was happy with that the end of the story")], "item_id long, text string")
    kept = decontaminate.drop_contaminated(odd_docs, bench, min_words=8)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3, 4, 7, 8, 9]
    assert decontaminate.drop_contaminated(no_docs, bench).count() == 0
    assert decontaminate.drop_contaminated(odd_docs, bench.limit(0)).count() == odd_docs.count()


def test_a_long_text_meets_a_frequent_item_once(spark, monkeypatch):
    """20,000 words with a two-word item all over: one row with all diagonals, the text's words joined once."""
    rows, met = [], decontaminate.met
    monkeypatch.setattr(decontaminate, "met", lambda *a: rows.append(met(*a)) or rows[-1])
    text = "alpha beta " * 10_000
    got = overlaps(spark, [(1, text), (2, "beta alpha"), (3, text)], [(7, "alpha beta"), (8, "alpha gamma")])
    assert set(got) == {(1, 7), (3, 7)}
    assert [(got[k].doc_start, got[k].item_start, got[k].n_words, got[k].n_equal) for k in got] == [(0, 0, 2, 2)] * 2
    found = rows[0].select("diagonals").collect()
    assert sorted(len(r.diagonals) for r in found) == [10_000, 10_000]


def test_best_overlap_against_all_diagonals():
    rng = np.random.default_rng(6)
    for _ in range(60):
        ids, own = rng.integers(0, 3, 40), rng.integers(0, 3, 9)
        every = np.arange(-len(own) + 1, len(ids))
        found = []
        for d in every.tolist():
            a, b = max(0, -d), min(len(own), len(ids) - d)
            start, n, equal = decontaminate.longest_overlap(own[a:b] == ids[a + d : b + d], 0.8)
            if n:
                found.append((equal, -n, -(a + start + d), -(a + start)))
        assert decontaminate.best_overlap(rng.permutation(every), ids, own, 0.8) == max(found)


def test_longest_overlap():
    equal = np.array([0, 1, 1, 1, 0, 1, 0, 0, 1], bool)
    assert decontaminate.longest_overlap(equal, 0.8) == (1, 5, 4)
    assert decontaminate.longest_overlap(np.zeros(4, bool), 0.8) == (0, 0, 0)
    assert decontaminate.longest_overlap(np.zeros(0, bool), 0.8) == (0, 0, 0)


@pytest.mark.parametrize("max_bucket", [2048, 2])
def test_keys_and_midpoints_are_never_broadcast(spark, monkeypatch, max_bucket):
    """A join of 35 keys or 2,081 midpoints a fingerprint doesn't pass the driver, however small Spark takes it to be."""
    plans = []

    def recorded(df, label, write=simhash.staged):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label)

    monkeypatch.setattr(simhash, "staged", recorded)
    fps = [0, 1, 3, 7, 1 << 40, 5 << 40]
    prints = simhash.staged(spark.createDataFrame([(fp,) for fp in fps], "fp long"), "test-prints")
    found = simhash.staged(simhash.links(prints, 4, max_bucket), "test-links")
    assert not any("Broadcast" in p for p in plans)
    # all six are within four bits of zero: one component
    linked = {0} | {r.u for r in found.collect()} | {r.v for r in found.collect()}
    assert linked == set(fps)


def test_tables_that_grow_with_the_documents_are_never_broadcast(spark, odd_docs, monkeypatch):
    """Only the few heavy keys of a weighted join pass the driver: two joins for each of the two."""
    plans = []
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()

    def recorded(df, label, write=simhash.staged):
        plans.append(plan_of(df))
        return write(df, label)

    monkeypatch.setattr(simhash, "staged", recorded)
    kept = simhash.drop_near_duplicates(odd_docs)
    plans.append(plan_of(kept))
    assert [n for p in plans if (n := p.count("BroadcastHashJoin"))] == [2, 2]
    assert kept.count() == len({r.root for r in simhash.near_duplicates(odd_docs).collect()})
