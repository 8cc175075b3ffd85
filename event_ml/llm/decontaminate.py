"""Benchmark decontamination by spaced-seed hashing.

Texts are word sequences (runs of letters, digits and underscores, lower
case; in scripts without blanks each character is a word).  A mask such as
``11011011`` picks the positions that a window's hash reads, so a substituted
word under a 0 doesn't hide the match.  An item of fewer than ``SHORT`` words
has masks of its own, of which one fits whatever words are substituted.

1. The benchmark's windows are hashed, and their hashes set bits of a filter
   of fixed size, which is the only thing broadcast.
2. One pass over the documents hashes every window under every mask; documents
   with a window in the filter are written with their words and those windows.
3. The windows join the benchmark's on the full hash; hits meet by document and
   item, one row with the diagonals (differences of the positions) on which
   they lie.  Both word sequences join that row once.
4. On each diagonal all words are compared, and the longest stretch with at
   least ``min_ratio`` equal words counts if it has enough of them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from event_ml.llm.common import kept_in_worker, map_batches, staged, table
from event_ml.llm.simhash import row_key

#: Words read under 1; each mask reads six.
MASKS = ("11011011", "101100111", "1110100011")
#: Log2 of the filter's bits (2 MiB).
FILTER_BITS = 24

#: Items of fewer words have their own masks.
SHORT = 15
#: Thai, Lao, Myanmar, Khmer, kana and Han.
_UNSPACED = "\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ecd\u1000-\u103f\u1780-\u17d3\u3005-\u3007\u3041-\u3096\u30a1-\u30fa\u30fc\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
_WORD = re.compile(rf"[^\W{_UNSPACED}]+|[{_UNSPACED}]")


class _Ids(dict):
    """Word to 32-bit id; forgets all when it has 300,000 words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 300_000:
            self.clear()
        self[word] = own = xxhash.xxh32_intdigest(word.encode("utf-8", "replace"), 42)
        return own


def word_ids(text: str | None) -> np.ndarray:
    words = _WORD.findall((text or "").lower())
    return np.fromiter(map(kept_in_worker("word ids", _Ids).__getitem__, words), np.uint32, len(words))


def window_hashes(ids: np.ndarray, mask: str) -> np.ndarray:
    """The 64-bit hash of each window of ``mask``'s length (none for shorter texts)."""
    n = len(ids) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, xxhash.xxh64_intdigest(mask, 42), np.uint64)
    for i, read in enumerate(mask):
        if read == "1":
            out = (out ^ ids[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


def short_masks(n: int, least: int) -> list[tuple[int, str]]:
    """(first position, mask) pairs for an item of ``n`` words: wherever
    ``least`` of them are equal, all words that one of the masks reads are.

    The words are cut into two blocks more than may differ, so two blocks at
    least are whole; one mask for each choice, without zeros at its ends.
    """
    differ = n - least
    blocks = 1 if not differ else n if n <= 5 else min(n, differ + 2)
    cuts = [round(n * i / blocks) for i in range(blocks + 1)]
    out = []
    for whole in combinations(range(blocks), blocks - differ):
        mask = "".join(("1" if i in whole else "0") * (cuts[i + 1] - cuts[i]) for i in range(blocks))
        out.append((mask.index("1"), mask.strip("0")))
    return out


def filter_places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return hashes >> np.uint64(64 - FILTER_BITS), hashes & np.uint64((1 << FILTER_BITS) - 1)


def longest_overlap(equal: np.ndarray, min_ratio: float) -> tuple[int, int, int]:
    """(start, length, equal words) of the longest stretch with at least that
    ratio of equal words, without differing words at its ends."""
    gain = np.where(equal, 1 - min_ratio, -min_ratio)
    total = np.concatenate([[0.0], np.cumsum(gain)])
    lowest = np.minimum.accumulate(total)
    first = np.searchsorted(-lowest, -total - 1e-9, side="left")
    end = int((np.arange(len(total)) - first).argmax())
    inside = np.flatnonzero(equal[first[end] : end])
    if not len(inside):
        return 0, 0, 0
    return int(first[end] + inside[0]), int(inside[-1] - inside[0] + 1), len(inside)


def best_overlap(diagonals: np.ndarray, ids: np.ndarray, own: np.ndarray, min_ratio: float) -> tuple[int, int, int, int]:
    """(equal words, -length, -start in ``ids``, -start in ``own``) of the overlap with the
    most equal words on any of the diagonals; of those the shortest, then the first."""
    best = (0, 0, 0, 0)
    for diagonal in np.sort(diagonals).tolist():
        a, b = max(0, -diagonal), min(len(own), len(ids) - diagonal)
        same = own[a:b] == ids[a + diagonal : b + diagonal]
        if same.sum() >= max(1, best[0]):
            start, n, equal = longest_overlap(same, min_ratio)
            best = max(best, (equal, -n, -(a + start + diagonal), -(a + start)))
    return best


def met(hits: DataFrame, item_seeds: DataFrame) -> DataFrame:
    """(k1, k2, item_key, diagonals): one row for each document and item that share a window."""
    return (
        hits.join(item_seeds, "seed")
        .groupBy("k1", "k2", "item_key")
        .agg(F.collect_set((F.col("pos") - F.col("item_pos")).cast("int")).alias("diagonals"))
    )


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: Sequence[str] = MASKS,
    min_words: int = 12,
    min_ratio: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, doc_start, item_start, n_words, n_equal, k1, k2): the
    longest verified overlap of every document with every item that it shows.

    An overlap has at least ``min_words`` equal words, or ``min_ratio`` of all
    words of an item that is shorter than that.  Every overlap with an item of
    fewer than ``SHORT`` words is found, longer ones as far as ``masks`` reach.
    Null and empty texts overlap with nothing; texts of any length are read
    whole.  Of equally long overlaps the first counts.  Repeated rows of ``docs``
    have one row an item (k1, k2: the row's key); repeated items too.  Other
    columns, whatever their names, are not read.  An empty table on either side
    gives no rows.  An item of one word overlaps with every document that has
    this word.
    """
    spark = docs.sparkSession

    def own_masks(n: int) -> list[tuple[int, str]]:
        least = math.ceil(min_ratio * n)
        return short_masks(n, least) if 0 < n < SHORT and 0 < least <= min_words else []

    def item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = word_ids(text)
                own = own_masks(len(ids))
                found = [window_hashes(ids, m) for m in masks] + [window_hashes(ids[at : at + len(m)], m) for at, m in own]
                seeds, pos = np.concatenate(found), np.concatenate([*[np.arange(len(x)) for x in found[: len(masks)]], [at for at, _ in own]]).astype(np.int32)
                row = [[item], [ids.view(np.int32)], [seeds.view(np.int64)], [pos]]
                types = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], ["item_id", "item_ids", "seeds", "pos"])

    items = benchmark.select(F.col(item_col).cast("long"), F.col(item_text_col).cast("string")).distinct()
    items = map_batches(items, item_windows, "item_id long, item_ids array<int>, seeds array<long>, pos array<int>")
    items = staged(items.withColumn("item_key", F.xxhash64("item_id", "item_ids")), "benchmark-items")
    # a row for each number of words under SHORT; documents are read under these masks only if an item needs them
    lengths = [r[0] for r in items.select(F.size("item_ids").alias("n")).where(F.col("n") < SHORT).distinct().collect()]
    doc_masks = list(dict.fromkeys([*masks, *(m for n in sorted(lengths) for _, m in own_masks(n))]))
    item_seeds = items.select("item_key", F.explode(F.arrays_zip("seeds", "pos")).alias("s")).select(
        "item_key", F.col("s.seeds").alias("seed"), F.col("s.pos").alias("item_pos")
    )

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            for place in filter_places(batch.column(0).to_numpy().view(np.uint64)):
                bits[place] = True
        words = np.packbits(bits, bitorder="little").view(np.int64)
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used])], ["word", "bits"])

    # at most 2**FILTER_BITS / 64 rows of 16 bytes, however large the benchmark
    words = map_batches(item_seeds.select("seed").distinct(), set_bits, "word long, bits long")
    words = words.groupBy("word").agg(F.bit_or("bits")).toArrow()
    whole = np.zeros((1 << FILTER_BITS) // 64, np.int64)
    whole[words.column(0).to_numpy()] = words.column(1).to_numpy()
    shared = spark.sparkContext.broadcast(whole.tobytes())

    def doc_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(shared.value, np.uint8), bitorder="little").view(bool)
        for batch in batches:
            for i, text in enumerate(batch.column(3).to_pylist()):
                ids = word_ids(text)
                seeds, pos = [], []
                for mask in doc_masks:
                    own = window_hashes(ids, mask)
                    high, low = filter_places(own)
                    hit = np.flatnonzero(bits[high])
                    hit = hit[bits[low[hit]]]
                    seeds.append(own[hit])
                    pos.append(hit)
                if any(map(len, pos)):
                    row = [[ids.view(np.int32)], [np.concatenate(seeds).view(np.int64)], [np.concatenate(pos)]]
                    types = [pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32())]
                    yield pa.RecordBatch.from_arrays(
                        [*batch.slice(i, 1).columns[:3], *(pa.array(v, t) for v, t in zip(row, types))], ["doc_id", "k1", "k2", "ids", "seeds", "pos"]
                    )

    keyed = docs.select(F.col(id_col).cast("long"), *row_key(id_col, text_col), F.col(text_col).cast("string"))
    schema = "doc_id long, k1 long, k2 long, ids array<int>, seeds array<long>, pos array<int>"
    held = staged(map_batches(keyed, doc_windows, schema), "suspect-documents")
    hits = held.select("doc_id", "k1", "k2", F.explode(F.arrays_zip("seeds", "pos")).alias("s")).select("k1", "k2", F.col("s.seeds").alias("seed"), F.col("s.pos").alias("pos"))
    # equal documents have equal hits, so their rows' diagonals are those of one
    pairs = met(hits, item_seeds)
    one = held.select("doc_id", "k1", "k2", "ids").dropDuplicates(["k1", "k2"])
    pairs = pairs.join(one, ["k1", "k2"]).join(items.select("item_key", "item_id", "item_ids"), "item_key")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, diagonals, ids, own in zip(range(batch.num_rows), batch.column(4), batch.column(5), batch.column(6)):
                ids, own = ids.values.to_numpy(zero_copy_only=False), own.values.to_numpy(zero_copy_only=False)
                best = best_overlap(diagonals.values.to_numpy(zero_copy_only=False), ids, own, min_ratio)
                if best[0] and best[0] >= min(min_words, math.ceil(min_ratio * len(own))):
                    out.append((key, -best[2], -best[3], -best[1], best[0]))
            if out:
                rows, *found = zip(*out)
                picked = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [*picked.columns[:4], *(pa.array(x, pa.int32()) for x in found)], ["doc_id", "item_id", "k1", "k2", "doc_start", "item_start", "n_words", "n_equal"]
                )

    schema = "doc_id long, item_id long, k1 long, k2 long, doc_start int, item_start int, n_words int, n_equal int"
    found = map_batches(pairs.select("doc_id", "item_id", "k1", "k2", "diagonals", "ids", "item_ids"), verify, schema)
    # an item id may stand for several texts
    order = F.struct(F.col("n_equal"), -F.col("n_words"), -F.col("doc_start"), -F.col("item_start"))
    best = found.groupBy("k1", "k2", "item_id").agg(F.first("doc_id").alias("doc_id"), F.max(order).alias("o"))
    return best.select(
        "doc_id", "item_id", (-F.col("o.col3")).alias("doc_start"), (-F.col("o.col4")).alias("item_start"), (-F.col("o.col2")).alias("n_words"), F.col("o.n_equal"), "k1", "k2"
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without an overlap, with all their columns."""
    found = staged(find_overlaps(docs, benchmark, id_col=id_col, text_col=text_col, **options), "contaminated")
    keys = found.select(F.col("k1").alias("_llm_k1"), F.col("k2").alias("_llm_k2")).distinct()
    return docs.select("*", *row_key(id_col, text_col)).join(keys, ["_llm_k1", "_llm_k2"], "left_anti").select(*docs.columns)


def op5_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("k1", "k2")
