import hashlib
import io
import math
import random
import time
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from event_ml.llm import language_id, maxent_lm, url_rules, warc
from event_ml.llm.common import scratch_dir


def test_op9_held_out_accuracy(spark, documents, small_dir):
    lang = {r.doc_id: r.lang for r in documents.collect()}
    got = language_id.op9_byte_cnn(spark, small_dir).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held) > 20


def test_pair_tables_give_the_convolution():
    rng = np.random.default_rng(2)
    net = language_id.Network(["a", "b"], [rng.normal(size=(w, 256, 3)).astype("f4") for w in language_id.WIDTHS], rng.normal(size=9), rng.normal(size=(9, 2)), rng.normal(size=2))
    x = rng.integers(0, 256, (5, language_id.WINDOW)).astype(np.uint8)
    tops = []
    for k in net.filters:
        conv = np.array([[sum(k[j][row[t + j]] for j in range(len(k))) for t in range(len(row) - len(k) + 1)] for row in x])
        tops.append(conv.max(1))
    wanted = np.maximum(np.concatenate(tops, 1) + net.bias, 0) @ net.out + net.out_bias
    assert np.allclose(language_id.Scorer(net).logits(x), wanted, atol=1e-4)


def test_scores_of_whole_texts():
    """A text's languages by its windows' logits, convolved one by one and weighted by their bytes."""
    rng = np.random.default_rng(5)
    net = language_id.Network(["x", "y", "z"], [rng.normal(size=(w, 256, 2)).astype("f4") for w in language_id.WIDTHS], rng.normal(size=6), rng.normal(size=(6, 3)), rng.normal(size=3))
    texts = ["Ab", "short TEXT é", "word one two " * 60, "Zz" * 128, "q" * 257, None, "", "12 !?"]
    found, scores = language_id.Scorer(net).score(texts)
    for text, lang, score in zip(texts, found, scores, strict=True):
        if not text or not any(c.isalpha() for c in text):
            assert (lang, score) == ("und", 0.0)
            continue
        raw = text.encode().lower()
        total, weights = np.zeros(3), 0
        for at in range(0, len(raw), language_id.WINDOW):
            part = raw[at : at + language_id.WINDOW]
            row = list(part) + [0] * (language_id.WINDOW - len(part))
            tops = np.concatenate([np.max([sum(k[j][row[t + j]] for j in range(len(k))) for t in range(len(row) - len(k) + 1)], axis=0) for k in net.filters])
            total += len(part) * (np.maximum(tops + net.bias, 0) @ net.out + net.out_bias)
            weights += len(part)
        p = np.exp(total / weights - (total / weights).max())
        p /= p.sum()
        assert lang == net.languages[int(p.argmax())] and score == pytest.approx(p.max(), rel=1e-4)


def test_languages_of_odd_rows(odd_docs, no_docs):
    got = defaultdict(set)
    for r in language_id.identify(odd_docs).collect():
        got[r.doc_id].add((r.lang_pred, r.score))
    assert all(got[k] == {("und", 0.0)} for k in (2, 3, 4, 9))
    assert all(lang in ("en", "fr") for k in (1, 5, 7, 8, None) for lang, _ in got[k])
    assert len(got[5]) == 1
    assert language_id.identify(no_docs).count() == 0
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}
    kept = language_id.keep_identified(odd_docs, 0.0)
    assert kept.schema.names == odd_docs.columns and kept.count() == odd_docs.count() - 4
    assert kept.where("doc_id = 1").first() == odd_docs.where("doc_id = 1").first()


def test_unsure_languages_stay(odd_docs, monkeypatch):
    unsure = language_id.Network(["a", "b", "c"], [np.zeros((w, 256, 1), np.float32) for w in language_id.WIDTHS], np.zeros(3), np.zeros((3, 3)), np.zeros(3))
    monkeypatch.setattr(language_id, "fit", lambda *a, **b: unsure)
    assert language_id.keep_identified(odd_docs).count() == odd_docs.count() - 4


def test_op2_base_score_and_model(spark, small_dir, texts):
    got = {r.doc_id: r for r in maxent_lm.op2_hashed_maxent(spark, small_dir).collect()}
    words = {k: [*maxent_lm.words_of(t), None] for k, t in texts.items()}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in texts}
    counts = Counter(w for k, own in words.items() if not held[k] for w in own)
    total, kinds = sum(counts.values()), len(counts)
    for k, own in words.items():
        r = got[k]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[k], len(own), total)
        assert r.n_known == sum(counts[w] > 0 for w in own)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in own), rel_tol=1e-9)
        assert r.score < 0


def test_probabilities_add_up(spark):
    """All one-word texts and the empty one, with words known or not."""
    rows = [(i, "aa ab ba aa cc") for i in range(30)]
    extra = [(1000 + i, w) for i, w in enumerate(["aa", "ab", "ba", "cc"])]
    held = [(k, t) for k, t in ((next(j for j in range(10_000 * i, 10_000 * i + 500) if zlib.crc32(str(j).encode()) % 7 == 2), t) for i, (_, t) in enumerate(extra, 1))]
    df = spark.createDataFrame(rows + held, "doc_id long, text string")
    got = {r.doc_id: r for r in maxent_lm.score(df, stride=1).collect()}
    weights = np.zeros((maxent_lm.BUCKETS + 1, maxent_lm.CLASSES), np.float32)
    features, classes, starts = maxent_lm.targets([[b"aa", b"ab"], []])
    assert classes.tolist() == [maxent_lm.word_class(b"aa"), maxent_lm.word_class(b"ab"), maxent_lm.END, maxent_lm.END]
    assert starts.tolist() == [0, 3] and (features[:, 0] == features[:, 3]).all()
    assert np.allclose(np.exp(maxent_lm.class_scores(weights, features)).sum(1), 1)
    assert all(r.n_known == r.n_tokens for r in got.values())
    assert sum(10 ** got[k].score for k, _ in held) < 1


def slow_scores(rows, weights):
    """Scores by the model's definition, one token at a time, from its weights."""
    mask = (1 << 64) - 1
    a, b, c, d, e = (int(m) for m in maxent_lm.MULTIPLIERS)
    shift = 64 - maxent_lm.BUCKETS.bit_length() + 1
    words = {k: [w.encode().lower() for w in (t or "").split()] for k, t in rows}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in words}
    counts = Counter(w for k, own in words.items() if not held[k] for w in [*own, None])
    every = {w for own in words.values() for w in own}
    classes = {w: zlib.crc32(w[:2]) % 47 for w in every} | {None: 47}
    room = Counter({k: 1 for k in range(48)})  # a word that training didn't have
    for w, n in counts.items():
        room[classes[w]] += n + (w is not None)
    out = {}
    for k, own in words.items():
        total, before = 0.0, [0, 0, 0]
        for w in [*own, None]:
            one, two, three = before
            rows_of = [(one + 1) * a, ((one * b & mask) ^ (two + 3)) * c, (two + 5) * d, (three + 7) * e]
            logits = weights[maxent_lm.BUCKETS].astype(float) + sum(weights[(x & mask) >> shift].astype(float) for x in rows_of)
            total += (logits - np.log(np.exp(logits).sum()))[classes[w]] / math.log(10) + math.log10((counts[w] + 1) / room[classes[w]])
            before = [zlib.crc32(w) | 1 if w is not None else 0, one, two]
        out[k] = total
    return out


def test_scores_against_the_definition(spark, documents, monkeypatch):
    kept, averaged = [], maxent_lm.averaged
    monkeypatch.setattr(maxent_lm, "averaged", lambda *a: kept.append(averaged(*a)) or kept[-1])
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").limit(40).collect()] + [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "NEVER seen é 日本")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for frequent in (150_000, 3):
        got = {r.doc_id: r.score for r in maxent_lm.score(df, frequent=frequent).collect()}
        wanted = slow_scores(rows, kept[-1])
        assert got.keys() == wanted.keys() and np.abs(kept[-1]).max() > 0.1
        assert all(got[k] == pytest.approx(wanted[k], rel=1e-5, abs=1e-6) for k in wanted)


def test_frequent_and_other_words_agree(spark, documents):
    few, many = (sorted((r.doc_id, round(r.base_score, 6), round(r.score, 6), r.n_known) for r in maxent_lm.score(documents.limit(40), frequent=n).collect()) for n in (5, 10_000))
    assert few == many


def test_scores_of_odd_rows(odd_docs, no_docs):
    got = maxent_lm.score(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r.doc_id: (r.n_tokens, r.score) for r in got}
    assert by[2] == by[3] == by[4] and by[2][0] == 1 and by[1] == by[5]
    assert maxent_lm.score(no_docs).count() == 0
    unseen = maxent_lm.score(odd_docs.where("doc_id = 7")).first()
    assert unseen.n_tokens == 13


def test_every_training_position_takes_a_step(spark, documents, monkeypatch):
    moved, averaged = [], maxent_lm.averaged

    def counted(learned, weights):
        moved.append(learned.where(F.col("bucket") == maxent_lm.BUCKETS).agg(F.sum("updates")).first()[0] or 0)
        return averaged(learned, weights)

    monkeypatch.setattr(maxent_lm, "averaged", counted)
    one_word = documents.select(F.col("doc_id") + 1_000_000, F.lit("word")).limit(20)
    scored = maxent_lm.score(documents.select("doc_id", "text").limit(40).union(one_word))
    assert sum(moved) == scored.first().train_tokens


def slow_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = rest[: min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])]
    path = rest[len(host) :]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in url_rules.RULES:
        own, _, start = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return host, path, best


def slow_mining(labelled, support, confidence, most):
    """Association rules to a verdict, pruned, by counting all token sets."""
    sets = Counter(c for tokens, _ in labelled for n in range(1, most + 1) for c in combinations(tokens, n))
    both = Counter((c, v) for tokens, v in labelled for n in range(1, most + 1) for c in combinations(tokens, n))
    rules = {(c, v): (n / sets[c], n / len(labelled)) for (c, v), n in both.items() if n >= support * len(labelled) - 1e-9 and n / sets[c] >= confidence}
    return {(c, v): x for (c, v), x in rules.items() if not any(rules.get((s, v), (0,))[0] >= x[0] for n in range(1, len(c)) for s in combinations(c, n))}


def test_op3_against_counting(spark, small_dir):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{small_dir}/pages.parquet").collect()}
    host, path = url_rules.host_and_path(F.col("url"))
    tokens = {r.page_id: r.t for r in spark.read.parquet(f"{small_dir}/pages.parquet").select("page_id", url_rules.tokens(host, path).alias("t")).collect()}
    rules = slow_mining([(tokens[k], slow_rule(u)[2][0]) for k, u in urls.items() if slow_rule(u)[2]], 0.01, 0.8, 3)
    for r in url_rules.op3_association_rules(spark, small_dir).collect():
        host, path, best = slow_rule(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, best and best[1])
        fitting = [(c, s, len(a), " ".join(a), v) for (a, v), (c, s) in rules.items() if set(a) <= set(tokens[r.page_id])]
        wanted = best[0] if best else max(fitting)[4] if fitting else "allow"
        assert r.verdict == wanted


def test_rules_of_four_tokens(spark):
    """Only all four of a, b, c, d together tell a verdict."""
    labelled = [(list("abcd"), "block")] * 10 + [(t, "allow") for t in (list("abc"), list("abd"), list("acd"), list("bcd")) for _ in range(10)]
    df = spark.createDataFrame(labelled, "tokens array<string>, verdict string")
    rules = {(tuple(r.antecedent), r.verdict): round(r.confidence, 9) for r in url_rules.mined_rules(df, 0.01, 0.8, None).collect()}
    assert rules == {(("a", "b", "c", "d"), "block"): 1.0} | {k: round(c, 9) for k, (c, _) in slow_mining(labelled, 0.01, 0.8, 4).items()}


def judged_slowly(urls, labelled_by):
    """Verdicts by counting all token sets; ``urls`` are (url, tokens)."""
    rules = slow_mining([(t, labelled_by(u)[2][0]) for u, t in urls if labelled_by(u)[2]], 0.01, 0.8, 12)
    out = []
    for u, t in urls:
        best = labelled_by(u)[2]
        fitting = [(c, s, len(a), " ".join(a), v) for (a, v), (c, s) in rules.items() if set(a) <= set(t)]
        out.append(best[0] if best else max(fitting)[4] if fitting else "allow")
    return out


def long_urls(n, words, rng):
    """Sites with a template of ``words`` path words that all their URLs share, and a word or two that tell."""
    out = []
    for i in range(n):
        host = rng.choice(["a.org", "b.com", "c.net", "example.org"])
        start = rng.choice(["/de", "/fr", "/es", "/en/1", ""]) if host != "a.org" else ""
        same = "/".join(chr(97 + j % 26) * 2 + "x" * (j // 26) for j in range(words))
        out.append(f"http://{host}{start}/{same}/{rng.choice(['red', 'green', 'blue'])}-{rng.choice(['one', 'two'])}")
    return out


def test_rules_of_urls_with_shared_words(spark):
    rng = random.Random(4)
    urls = long_urls(300, 3, rng)
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    host, path = url_rules.host_and_path(F.col("url"))
    tokens = {r.url: r.t for r in df.select("url", url_rules.tokens(host, path).alias("t")).collect()}
    got = {r.page_id: r.verdict for r in url_rules.judge(df).collect()}
    assert [got[i] for i in range(300)] == judged_slowly([(u, tokens[u]) for u in urls], slow_rule)


@pytest.mark.parametrize("words", [15, 30])
def test_long_urls_are_mined_in_seconds(spark, words):
    """The same verdicts as with three shared words: the template is one item."""
    short, long = long_urls(400, 3, random.Random(9)), long_urls(400, words, random.Random(9))
    began = time.monotonic()
    verdicts = [{r.page_id: (r.verdict, r.confidence) for r in url_rules.judge(spark.createDataFrame(list(enumerate(u)), "page_id long, url string")).collect()} for u in (short, long)]
    assert verdicts[0] == verdicts[1] and len(set(verdicts[0].values())) > 2
    assert time.monotonic() - began < 120


def test_items_of_tokens(spark):
    """Tokens with the same URLs are one item; those of one verdict or of all URLs are alone."""
    labelled = [(list("abxz"), "block")] * 3 + [(list("abyz"), "allow")] * 3 + [(list("cz"), "allow")] * 2 + [(["q", "z"], "allow")]
    df = spark.createDataFrame(labelled, "tokens array<string>, verdict string")
    got = {r.token: (r.item, r.n, r.alone) for r in url_rules.token_items(df, 2, 9).collect()}
    assert got == {"a": ("a", 6, False), "b": ("a", 6, False), "x": ("x", 3, True), "y": ("y", 3, True), "c": ("c", 2, True), "z": ("z", 9, True)}


def test_rules_of_odd_urls(spark):
    urls = ["http://A.ORG?x", "https://example.org/es/", "https://x.example.org/en/12#y", "https://example.org/en", "//a.org/", "", None, "a://b://org/x", "http://org", "http://notorg/", "http://m.com/fr/1", "http://com/de/", "ftp://café.org/É x", "http://x.org/\n/es"]
    df = spark.createDataFrame([(i if i else None, u, "x", "y") for i, u in enumerate(urls + urls[:2])], "page_id long, url string, host string, rule string")
    got = url_rules.judge(df).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        host, path, best = slow_rule((urls + urls[:2])[r.page_id or 0])
        assert (r.host, r.path, r.rule) == (host, path, best and best[1])
        if best:
            assert r.verdict == best[0]
    assert {r.verdict for r in url_rules.judge(df.where("url IS NULL")).collect()} == {"allow"}
    assert url_rules.judge(df.limit(0)).count() == 0


PAGES = [(1, "http://a/", "<p>" + "x" * 120), (2, None, "<p>" + "x" * 120), (2, "http://c d/\r\n", "<p>" + "x" * 120), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (None, "u", "<p>" + "x" * 120), (7, "u", "é" * 50), (8, "u", "é" * 50), (9, "u", "y" * 500_000), (None, "u", "only null " * 30)]


def test_archives_of_odd_rows(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("x"))
    for roll in (1 << 26, 200):
        folder = scratch_dir(spark, "warc")
        archives = warc.write_archives(df, folder, roll_bytes=roll)
        got = Counter(tuple(r)[:5] for r in warc.read_archives(archives, folder).collect())
        wanted = Counter()
        for page, _, html in PAGES:
            raw = (html or "").encode()
            first = min((p for p, _, h in PAGES if h == html and p is not None), default=None) if len(raw) >= 100 else None
            again = first is not None and page != first
            wanted[page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None] += 1
        assert got == wanted
        assert archives.agg(F.sum("records")).first()[0] == len(PAGES)
    assert warc.read_archives(warc.write_archives(df.limit(0), folder), folder).count() == 0


def archive(*records, dictionary=None):
    packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    return (warc.dictionary_frame(dictionary) if dictionary else b"") + b"".join(packer.compress(r) for r in records)


def test_frames_need_their_dictionary():
    some = [warc.record(i, "http://x/", f"page {i} ".encode() * 40, hashlib.sha256(f"page {i} ".encode() * 40).hexdigest(), len(f"page {i} " * 40), None) for i in range(60)]
    trained = zstandard.train_dictionary(4096, some).as_bytes()
    whole = archive(*some, dictionary=trained)
    for chunk in (1, 7, 1 << 18):
        assert list(warc.frames(io.BytesIO(whole), chunk)) == some
    assert [warc.parsed(r)[0] for r in some] == list(range(60))
    with pytest.raises(warc.WarcError):
        list(warc.frames(io.BytesIO(whole[len(warc.dictionary_frame(trained)) :])))


def test_broken_archives():
    good = warc.record(1, "http://x/", b"payload", hashlib.sha256(b"payload").hexdigest(), 7, None)
    whole = archive(good)
    for broken in (whole[:-3], whole + b"abc", whole + b"12345678", b"\x5d\x2a\x4d\x18\xff\0\0\0x"):
        with pytest.raises(warc.WarcError):
            list(warc.frames(io.BytesIO(broken)))
    for a, b in ((b"payload", b"paxload"), (b"WARC/1.1", b"WARC/9"), (b"WARC-Date: ", b"X-Date: "), (b"Content-Length: 7", b"Content-Length: 8"), (b"<urn:page:1>", b"<x>"), (b"response", b"metadata")):
        with pytest.raises(warc.WarcError):
            warc.parsed(good.replace(a, b, 1))
    with pytest.raises(warc.WarcError):
        warc.parsed(good + b"x")


def test_a_kept_text_goes_to_python_once(spark, odd_docs, monkeypatch):
    """Texts aren't sent twice, and a worker lets go of other operators' tables first."""
    from event_ml.llm import common

    sent = []

    def recorded(df, run, schema, send=common.map_batches):
        sent.append((df, run))
        return send(df, run, schema)

    monkeypatch.setattr(language_id, "map_batches", recorded)
    kept = language_id.keep_identified(odd_docs)
    df, run = sent[-1]
    assert len(df.columns) == len(odd_docs.columns) and kept.columns == odd_docs.columns
    monkeypatch.setattr(common, "_KEPT", {"table of another operator": "x"})
    rows = sum(batch.num_rows for batch in run(df.toArrow().to_batches()))
    assert rows == odd_docs.count() and [kind[0] for kind in common._KEPT] == ["languages"]


def test_other_words_are_joined_as_they_occur(spark, documents):
    """Rare words' logarithms are summed by row, without a shuffle by row and word before."""
    found = maxent_lm.score(documents.limit(40), frequent=5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(row#" in plan and not any("hashpartitioning(row#" in x and "word#" in x.split("hashpartitioning(row#")[1].split(")")[0] for x in plan.splitlines())


def test_each_distinct_word_is_looked_up_once_a_part():
    """Words come from Arrow, as ``words_of`` has them; a part's repeats don't reach Python."""
    texts = [None, "", " \t\n", "A b\x0bA\x0cé\x1c É  b ", "\x85x y　z Iİ", "b " * 500 + "end"]
    found, lengths = maxent_lm.split_words(pa.array(texts, pa.string()))
    own = [maxent_lm.words_of(t) for t in texts]
    assert lengths.tolist() == [len(d) for d in own] and found.cast(pa.binary()).to_pylist() == [w for d in own for w in d]

    class Counted(dict):
        looked = 0

        def __missing__(self, word):
            self[word] = own = len(self)
            return own

        def __getitem__(self, word):
            Counted.looked += 1
            return super().__getitem__(word)

    words, slow = maxent_lm.Numbered(), maxent_lm.Numbered()
    words.numbers = Counted()
    assert words.of_words(found).tolist() == slow.of(own).tolist() and list(words.numbers) == list(slow.numbers)
    assert Counted.looked == len(slow)
    assert words.of_words(found.slice(0, 0)).tolist() == []


def test_parts_are_bounded_by_rows_and_text(monkeypatch):
    monkeypatch.setattr(maxent_lm, "PART", 3)
    monkeypatch.setattr(maxent_lm, "PART_BYTES", 10)
    texts = ["x" * 25, "a", None, "", "b", "c" * 10, "d", "e" * 9, "f" * 11]
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(texts)], ["doc_id", "text"])
    parts = [p.column(0).to_pylist() for p in maxent_lm.parts_of(batch, 1)]
    assert parts == [[0], [1, 2, 3], [4], [5], [6, 7], [8]]


def test_a_step_sums_each_bucket_whole():
    """Summing block by block gives each row the sum of its tokens, however frequent it is."""
    rng = np.random.default_rng(7)
    features = np.where(rng.random((4, 3000)) < 0.3, 5, rng.integers(0, maxent_lm.BUCKETS, (4, 3000)))
    classes = rng.integers(0, maxent_lm.CLASSES, 3000)
    trainer = maxent_lm.Trainer(np.zeros((maxent_lm.BUCKETS + 1, maxent_lm.CLASSES), np.float32), 0.4)
    trainer.add(features, classes)
    miss = np.full((3000, maxent_lm.CLASSES), -1 / maxent_lm.CLASSES)
    miss[np.arange(3000), classes] += 1
    grad = np.zeros((maxent_lm.BUCKETS + 1, maxent_lm.CLASSES))
    for f in features:
        np.add.at(grad, f, miss)
    grad[-1] = miss.sum(0)
    grad /= 3000
    assert np.allclose(trainer.weights, 0.4 * grad / np.sqrt(1e-6 + grad * grad), atol=2e-3)
    assert trainer.updates.sum() == 5 * 3000 and trainer.size == 0
