import math
from collections import Counter, defaultdict

import corpus_pipeline

from event_ml.llm import decontaminate, queries, simhash
from event_ml.llm.common import connected_components, previous_in_order
from tests.llm.test_lines_fingerprints import slow_dedup
from tests.llm.test_near_duplicates import components, slow_fingerprint


def test_every_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
    assert queries.ORACLE_SQL.keys() <= queries.QUERIES.keys()


def shows_an_item(text, items):
    """Whether twelve equal words stand in a stretch of some diagonal with 80 % equal words, by trying all stretches."""
    words = decontaminate._WORD.findall((text or "").lower())
    places = defaultdict(list)
    for p, w in enumerate(words):
        places[w].append(p)
    for own in items:
        diagonals = Counter(p - i for i, w in enumerate(own) for p in places.get(w, ()))
        for d in (d for d, n in diagonals.items() if n >= min(12, math.ceil(0.8 * len(own)))):
            equal = [int(0 <= i + d < len(words) and words[i + d] == w) for i, w in enumerate(own)]
            for a in range(len(own)):
                for b in range(a + 1, len(own) + 1):
                    n = sum(equal[a:b])
                    if n >= 0.8 * (b - a) and n >= min(12, math.ceil(0.8 * len(own))):
                        return True
    return False


def test_stages_one_by_one(spark, small_dir, documents):
    docs, kept = documents, {}
    before = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before[name] = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.staged(stage(spark, docs, small_dir), name)
        assert docs.columns == documents.columns
        kept[name] = {r.doc_id: r for r in docs.collect()}
    assert len(kept["language"]) >= 0.97 * documents.count()
    lines = slow_dedup([(k, r.text) for k, r in before["repeated_lines"].items()], 1)
    wanted = {k: t for (k, _), (t, n, gone) in lines.items() if not gone or gone < n}
    assert {k: r.text for k, r in kept["repeated_lines"].items()} == wanted
    assert all(r.n_chars == len(r.text) for r in kept["repeated_lines"].values() if r.text != before["repeated_lines"][r.doc_id].text)
    fps = [(k, slow_fingerprint(r.text)) for k, r in sorted(before["near_duplicates"].items())]
    assert kept["near_duplicates"].keys() == set(components(fps))
    items = [decontaminate._WORD.findall(r.text.lower()) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect() if r.text]
    clean = {k for k, r in before["benchmark"].items() if not shows_an_item(r.text, items)}
    assert kept["benchmark"].keys() == clean < before["benchmark"].keys()
    pieces = corpus_pipeline.packed(spark, docs, small_dir).collect()
    assert {r.doc_id for r in pieces} == kept["benchmark"].keys()
    assert corpus_pipeline.run(spark, small_dir).count() == len(pieces)


def test_pipeline_of_odd_rows(spark, odd_docs, no_docs, small_dir):
    for docs, n in ((odd_docs, 4), (no_docs, 0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.staged(stage(spark, docs, small_dir), name)
            if name != "packed":
                assert docs.columns == odd_docs.columns
        assert docs.select("doc_id").distinct().count() <= n


def test_the_table_keeps_its_own_columns(spark, odd_docs, small_dir):
    """Columns named like an operator's results stay as they are."""
    own = {r.doc_id: (r.n_lines, r.n_deleted, r.score) for r in odd_docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, odd_docs, small_dir)
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in odd_docs.schema]
        assert all((r.n_lines, r.n_deleted, r.score) == own[r.doc_id] for r in got.collect()), name


def test_components_and_order(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40) if i != 20] + [(7, 7), (50, 40), (60, 61)], "u long, v long")
    roots = {r.node: r.root for r in connected_components(edges, "t").collect()}
    assert roots == {i: 0 if i <= 20 else 21 for i in range(41)} | {50: 21, 60: 60, 61: 60}
    assert connected_components(edges.limit(0), "t").count() == 0
    keys = [5, -3, 900, 7, 7, 1 << 60]
    got = {r.k: r.before for r in previous_in_order(spark.createDataFrame([(k,) for k in keys], "k long"), "k", "t").collect()}
    assert got == {5: -3, 7: 5, 900: 7, 1 << 60: 900, -3: 1 << 60}
