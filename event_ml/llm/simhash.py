"""SimHash near-duplicates with pivot distance tables.

A text's fingerprint has a bit where more than half of its shingles' hashes
have it.  Two fingerprints are linked when at most ``max_bits`` bits differ.

* Candidates: 64 bits in ``max_bits + 3`` blocks; linked fingerprints agree on
  three blocks at least, so each choice of three blocks is a table of keys.
  Distances to pivots alone can't index 64-bit fingerprints: two random ones
  pass a pivot's test with a probability of about 0.57.
* Pivot tables: the Hamming distances of every distinct fingerprint to
  ``PIVOTS`` reference fingerprints are computed once; by the triangle
  inequality a pair whose coordinates differ by more than ``max_bits`` anywhere
  is discarded, and the survivors are verified on all 64 bits.
* Equal texts meet as one fingerprint.  A bucket gives its members' links to
  the smallest of their component, never all its pairs.  In a bucket of more
  than ``max_bucket`` fingerprints nothing is compared: each of its members is
  joined with all fingerprints within ``max_bits / 2`` bits of it, and two
  share such a midpoint exactly when they are linked.
* Keys and midpoints are many rows a fingerprint, which Spark's size estimates
  leave out, so their joins ask for a sort-merge join and are never broadcast.
  So do the joins with a row a fingerprint, a component or a document that
  stays: at any broadcast threshold the driver holds none of these tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from event_ml.llm.common import connected_components, join_weighted, map_batches, staged, table

#: Reference fingerprints of the pivot table: XXH64 of their numbers.
PIVOTS = [xxhash.xxh64_intdigest(f"pivot {i}".encode(), 42) for i in range(24)]


def fingerprint(text: str | None, shingle: int, seed: int = 42) -> int:
    """SimHash of the XXH64 hashes of ``shingle`` words; 0 without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined, lengths = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    digest = xxhash.xxh64_intdigest
    last = ends[min(shingle, len(words)) - 1 :].tolist()
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, last)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(np.uint64)[0])


def row_key(id_col: str, text_col: str) -> list[Column]:
    """128 bits that equal rows share, never null."""
    return [F.xxhash64(id_col, text_col).alias("_llm_k1"), F.xxhash64(text_col, F.lit(1), id_col).alias("_llm_k2")]


def fingerprints(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, row key, fp) of every row; ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                own = np.array([fingerprint(t, shingle) for t in part.column(3).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(own.view(np.int64))], ["doc_id", "k1", "k2", "fp"])

    keyed = docs.select(F.col(id_col).cast("long"), *row_key(id_col, text_col), F.col(text_col).cast("string"))
    return map_batches(keyed, run, "doc_id long, k1 long, k2 long, fp long")


def block_masks(max_bits: int) -> list[int]:
    """Bits of every choice of three of ``max_bits + 3`` blocks."""
    cuts = [round(64 * i / (max_bits + 3)) for i in range(max_bits + 4)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(blocks, 3)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def bucket_links(fps: np.ndarray, pivots: np.ndarray, max_bits: int) -> np.ndarray:
    """For each fingerprint the position of its component's first, by links inside the bucket."""
    near = np.ones((len(fps), len(fps)), bool)
    for column in pivots.T:
        near &= np.abs(column[:, None] - column[None, :]) <= max_bits
    a, b = np.nonzero(near)
    linked = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
    a, b = a[linked], b[linked]
    root = np.arange(len(fps))
    while True:
        least = root.copy()
        np.minimum.at(least, a, root[b])
        least = least[least]
        if (least == root).all():
            return root
        root = least


def links(prints: DataFrame, max_bits: int, max_bucket: int) -> DataFrame:
    """(u, v) pairs of fingerprints whose components are those of all links."""
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    distinct = prints.select("fp").distinct()
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for i, m in enumerate(block_masks(max_bits))]))
    keyed = distinct.select("fp", keys.alias("k")).select("fp", "k.t", "k.key")
    shared = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    distances = F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(signed(p)))).cast("tinyint") for p in PIVOTS])
    # without the hints Spark broadcasts 35 keys a fingerprint as if they were one
    members = staged(keyed.join(shared.hint("merge"), ["t", "key"]), "simhash-buckets")
    pivoted = distinct.join(members.select("fp").distinct().hint("merge"), "fp", "left_semi").select("fp", distances.alias("d"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            offsets, rows = lists.offsets.to_numpy(), lists.values
            fps = rows.field(0).to_numpy(zero_copy_only=False).view(np.uint64)
            table_d = rows.field(1).values.to_numpy(zero_copy_only=False).reshape(len(fps), -1)
            for a, b in zip(offsets, offsets[1:]):
                own = fps[a:b]
                order = np.argsort(own)
                own = own[order]
                root = bucket_links(own, table_d[a:b][order], max_bits)
                moved = root != np.arange(len(own))
                if moved.any():
                    yield pa.RecordBatch.from_arrays([pa.array(own[moved].view(np.int64)), pa.array(own[root[moved]].view(np.int64))], ["u", "v"])

    flips = [signed(sum(1 << b for b in c)) for r in range(max_bits // 2 + 1) for c in combinations(range(64), r)]
    flips = np.array(flips, np.int64)

    def midpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fp in batch.column(0).to_numpy():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(flips), fp)), pa.array(flips ^ fp)], ["fp", "mid"])

    small = members.where(F.col("n") <= max_bucket).join(pivoted.hint("merge"), "fp").groupBy("t", "key")
    lists = small.agg(F.collect_list(F.struct("fp", "d")).alias("members")).select("members")
    cold = map_batches(lists, compare, "u long, v long")
    around = map_batches(members.where(F.col("n") > max_bucket).select("fp").distinct(), midpoints, "fp long, mid long")
    least = around.groupBy("mid").agg(F.min("fp").alias("v"), F.count("*").alias("n")).where("n > 1")
    hot = around.join(least.hint("merge"), "mid").where("fp <> v").select(F.col("fp").alias("u"), "v")
    return cold.unionByName(hot).distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    max_bits: int = 4,
    max_bucket: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, fingerprint, component_id, k1, k2, root): one row a row of ``docs``.

    ``component_id`` is the smallest id reachable by links (null ids are
    passed over; null if there is no other).  Null and blank texts have
    fingerprint zero and link like any other.  Repeated rows and ties share a
    component; k1 and k2 are the row's key, and root is the component's own
    fingerprint, which no other component has.  Texts of any length are read
    whole.  Other columns, whatever their names, are not read; an empty table
    gives an empty result.
    """
    prints = staged(fingerprints(docs, shingle, id_col, text_col), "simhash-fingerprints")
    roots = connected_components(links(prints, max_bits, max_bucket), "simhash-links")
    own = prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")).join(roots.withColumnRenamed("node", "fp").hint("merge"), "fp", "left")
    own = staged(own.select("fp", "least", "rows", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    # a component or a fingerprint may have a large share of all rows
    least = staged(own.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("prints")), "simhash-components")
    named = staged(join_weighted(own, least, "root", "prints", hint="merge").select("fp", "component_id", "root", "rows"), "simhash-names")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return join_weighted(prints, named, "fp", "rows", hint="merge").select("doc_id", hexed, "component_id", "k1", "k2", "root")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest id.

    Among rows that share that id, the one with the smallest row key stays, and
    of equal rows one.  All columns are kept.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")
    stay = found.groupBy("root").agg(F.min(first).alias("k")).select(F.col("k.k1").alias("_llm_k1"), F.col("k.k2").alias("_llm_k2"))
    kept = docs.select("*", *row_key(id_col, text_col)).join(stay.hint("merge"), ["_llm_k1", "_llm_k2"], "left_semi")
    return kept.dropDuplicates(["_llm_k1", "_llm_k2"]).select(*docs.columns)


def op6_simhash_pivot_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
