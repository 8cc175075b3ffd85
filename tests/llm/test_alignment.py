import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from event_ml.llm import alignment

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def direct():
    """text -> [(start, end, id)] of A and of B, by the two files' own readers."""
    reader = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reader.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    # the byte-level alphabet: printable bytes are themselves, the others follow from 256 on
    same = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    chars = {chr(b): b for b in same} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in same)}
    entries = {i: bytes(chars[c] for c in t) for t, i in reader.get_vocab().items() if i < 50256}

    def piece(i):
        p = model.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()

    def spans(ids, raw, data):
        out, at = [], 0
        for i in ids:
            out.append((at, at + len(raw(i)), i))
            at += len(raw(i))
        return out if b"".join(raw(i) for i in ids) == data else None

    def both(text):
        data = (" " + text).encode()
        return spans(reader.encode(" " + text, add_special_tokens=False).ids, entries.get, data), spans(model.encode(text), piece, data)

    return both


def slow_alignment(rows, direct):
    aligned, totals = {}, Counter()
    for _, text in rows:
        if text and text not in aligned:
            a, b = direct(text)
            if a is None or b is None:
                continue
            links, j = [], 0
            for s, e, i in a:  # every B token that begins before this one ends
                while j and b[j - 1][1] > s:
                    j -= 1
                while j < len(b) and b[j][1] <= s:
                    j += 1
                while j < len(b) and b[j][0] < e:
                    links.append((i, b[j][2]))
                    j += 1
            cuts = sorted({x[1] for x in a} & {x[1] for x in b})
            groups, at_a, at_b = [], 0, 0
            for cut in cuts:
                ids = ([], [])
                while at_a < len(a) and a[at_a][1] <= cut:
                    ids[0].append(str(a[at_a][2]))
                    at_a += 1
                while at_b < len(b) and b[at_b][1] <= cut:
                    ids[1].append(str(b[at_b][2]))
                    at_b += 1
                groups.append(",".join(ids[0]) + "|" + ",".join(ids[1]))
            aligned[text] = (a, b, links, groups)
        if text in aligned:
            totals.update(aligned[text][2])
    most = {}
    for (_, b), n in totals.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for doc, text in rows:
        if text not in aligned:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links, groups = aligned[text]
        best = sum(totals[x] == most[x[1]] for x in links)
        out.append((doc, len(a), len(b), len(groups), len(links), best, sum(totals[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_op12_against_brute_force(spark, small_dir, documents, direct):
    wanted = slow_alignment([(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()], direct)
    assert rows_of(alignment.op12_exact_dedup_alignment(spark, small_dir)) == wanted


ODD = [
    "a", " ", "   ", "x ", "  two  blanks  ", "tab\tand\nline\r\n", "don't I'LL", "<|endoftext|> a<s></s><unk>", "日本語 テスト 🙂👍", "é ́e ﬁ ｱ", "a▁b",
    "▁", "\x00\x01 �", "l" * 9000, "ab" * 6000 + " end", "a b　c", "1234 5678 !!", "word " * 3000,
]


@pytest.mark.parametrize("frequent", [2_000_000, 40, 0])
def test_odd_texts_and_rare_pairs(spark, direct, frequent):
    """Every way of counting: all pairs in the task, some, and all by the join."""
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, "the cat sat on the mat") for i in range(30)] + [(None, None), (None, "the cat"), (7, "")]
    got = rows_of(alignment.align(spark.createDataFrame(rows, "doc_id long, text string"), frequent=frequent))
    assert got == slow_alignment(rows, direct)
    assert any(r[1] == 0 and r[0] == ODD.index("a▁b") for r in got)


def test_odd_rows(spark, odd_docs, no_docs, direct):
    odd = odd_docs.withColumn("copies", F.lit("x")).withColumn("pairs", F.lit(1)).withColumn("row", F.lit("y")).withColumn("n_a", F.lit(-1))
    assert rows_of(alignment.align(odd)) == slow_alignment([(r.doc_id, r.text) for r in odd.collect()], direct)
    assert alignment.align(no_docs).count() == 0 and alignment.align(no_docs).columns == COLUMNS


def test_the_tables_of_ranks_and_of_the_tokenizer_file_agree(direct, texts):
    path = public_tokenizers.path
    own = alignment.Aligner(path("byte_bpe_50k.tiktoken"), path("byte_bpe_50k.json"), public_tokenizers.PATTERN, path("piece_bpe_32k.model"))
    several = [t for t in texts.values() if t][:80] + ODD + [f" a{chr(c)}b {chr(c)}1{chr(c)}  {chr(c)}'s" for c in range(1, 0x3000, 7)]
    for text, found in zip(several, own.ids(several), strict=True):
        a, b = direct(text)
        if found is None:
            assert a is None or b is None
        else:
            assert [x[2] for x in a] == found[0].tolist() and [x[2] for x in b] == found[1].tolist()
