import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from event_ml.llm import packing, separators, tokens
from event_ml.llm.common import scratch_dir


def reader(special):
    t = Tokenizer.from_file(tokens.default_vocabulary())
    t.encode_special_tokens = not special
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def direct():
    """The contract's call: strings of special tokens give their ids."""
    return reader(True)


ODD = ["", None, "  x y ", "a\x1cb", "é ́e", "ΟΔΟΣ ΟΔΟΣ.", "don't I'LL x''s !'s 'S", "日本語 テスト 🙂👍", "\x00\x01 �", "a\x85b\xa0c ÀÉÎ ß ĲŸ ¹²½ ªº İI ǅ ſ", "l" * 5000, "aé" * 3000]
MARKED = ["<|endoftext|> a<|endoftext|>", "x <|endoftext|> y", "<|ENDOFTEXT|>", "a<|startoftext|>B c", "<|endoftext |>"]


@pytest.mark.parametrize("special", [False, True])
def test_chunks_give_the_ids_of_whole_texts(texts, special):
    wanted = reader(special)
    several = ODD + MARKED + list(texts.values())[:60] + ODD
    for limit in (500_000, 10):
        encoder = tokens.ChunkEncoder(tokens.default_vocabulary(), special=special, max_entries=limit)
        for at in (0, 0, 40):
            assert [x.tolist() for x in encoder.encode(several[at:])] == [wanted(t) for t in several[at:]]
    assert wanted("x <|endoftext|> y") == [343, 49407, 344] or not special


def test_words_merge_as_the_tokenizer_merges():
    """Words of all lengths and alphabets, cut and merged here, against the tokenizer."""
    rng, wanted = random.Random(11), reader(False)
    letters = ["abcdefghijklmnopqrstuvwxyz", "etaoin", "aàâäæçéèêëîïôœùûüÿñßø", "ąćęłńóśźż", "0123456789", "'sdltmre!?.,-", "abcABC019'!é "]
    encoder = tokens.ChunkEncoder(tokens.default_vocabulary(), max_entries=1000)
    lines = [" ".join("".join(rng.choices(rng.choice(letters), k=rng.randint(1, 24))) for _ in range(40)) for _ in range(500)]
    lines += [f"a{chr(c)}b {chr(c)}1{chr(c)} {chr(c)}'s" for c in [*range(1, 0x600), 0x1E9E, 0x212B, 0xFB01, 0x3000, 0xAC00, 0x1F600]]
    assert [x.tolist() for x in encoder.encode(lines)] == [wanted(t) for t in lines]


def check_packing(rows, wanted, capacity):
    """Every id in one piece, no overlap, gapless sequences without padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.array(wanted[r.doc_id], "<u4")
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= capacity and (at == capacity or at & (at - 1) == 0)
    return pieces


def test_op8_pieces_cover_every_document(spark, small_dir, texts, direct):
    rows = packing.op8_cost_balanced_packing(spark, small_dir).collect()
    wanted = {k: direct(t) + [2] for k, t in texts.items()}
    pieces = check_packing(rows, wanted, 4096)
    for k, ids in wanted.items():
        at = 0
        for start, n in sorted(pieces[k]):
            assert start == at
            at += n
        assert at == len(ids)


def test_packing_of_odd_rows(odd_docs, no_docs, direct):
    rows = packing.pack(odd_docs, capacity=64, block_tokens=500).collect()
    assert sum(r.length for r in rows) == sum(len(direct(r.text)) + 1 for r in odd_docs.collect())
    assert sum(r.length for r in rows if r.doc_id == 5) == 2 * (len(direct(odd_docs.where("doc_id = 1").first().text)) + 1)
    assert sum(r.length for r in rows if r.doc_id == 2) == 1
    assert packing.pack(no_docs).count() == 0


def test_costs_are_balanced():
    rng = np.random.default_rng(1)
    lengths = [int(x) for x in rng.integers(1, 3000, 900)]
    _, room, cost = packing.balance(lengths, 4096, 1.0, 1 / 6144)
    full = cost[np.array(room) == 4096]
    order = np.cumsum(lengths) // 4096  # documents one after the other
    naive = np.array([sum(n + n * n / 6144 for n, o in zip(lengths, order) if o == k) for k in range(len(full))])
    assert full.std() < 0.5 * naive.std()
    assert sum(room) == sum(lengths)
    with pytest.raises(ValueError):
        packing.pack(None, capacity=100)


def test_op1_counts_tokens_of_every_document(spark, small_dir, texts, direct):
    got = {r.doc_id: r.n_tokens for r in separators.op1_separator_scan(spark, small_dir).collect()}
    assert got == {k: len(direct(t)) for k, t in texts.items()}


@pytest.mark.parametrize("block_bytes", [2, 6, 14, 1 << 20])
def test_blocks_are_stitched(spark, tmp_path, monkeypatch, block_bytes):
    monkeypatch.setattr(separators, "SPAN", 3)
    rng = np.random.default_rng(3)
    wanted = set()
    for name, ids in {"a": [9, 1, 2, 9, 9, 3], "b": [], "c": [1, 2, 3], "d": [9], "e": rng.integers(5, 12, 300).tolist()}.items():
        path = tmp_path / f"{name}.bin"
        path.write_bytes(np.array(ids, "<u2").tobytes())
        at = n = 0
        for i, x in enumerate([*ids, None]):
            if x == 9 or x is None and i > at:
                wanted.add((name, n, at, i - at, x == 9))
                at, n = i + 1, n + 1
    files = spark.createDataFrame([(f"file:{p}", p.stat().st_size) for p in tmp_path.iterdir()], "path string, length long")
    got = separators.scan_separators(files, separator=9, block_bytes=block_bytes).collect()
    assert {(r.path[-5], r.ordinal, r.start, r.n_tokens, r.terminated) for r in got} == wanted


def test_files_of_odd_rows(spark, odd_docs, no_docs, direct):
    folder = scratch_dir(spark, "token-files")
    manifest = separators.write_token_files(odd_docs, folder)
    files = spark.read.format("binaryFile").load(folder).select("path", "length")
    counts = sorted(r.n_tokens for r in separators.scan_separators(files).collect())
    assert counts == sorted(len(direct(r.text)) for r in odd_docs.collect())
    assert manifest.count() == odd_docs.count()
    assert separators.write_token_files(no_docs, folder).count() == 0


def test_broken_width(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"abc")
    files = spark.createDataFrame([(f"file:{tmp_path}/x.bin", 3)], "path string, length long")
    with pytest.raises(Exception, match="no whole number"):
        separators.scan_separators(files).collect()
