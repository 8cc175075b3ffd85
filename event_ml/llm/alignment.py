"""Alignment of two public tokenizers over a corpus.

A text, with a blank before it, is encoded by a byte-level vocabulary (A) and
by a piece vocabulary (B).  Byte offsets at which tokens of both end cut them
into groups, and an A and a B token whose byte ranges overlap are linked.

* Documents are shuffled by their full text, so that each distinct text is
  encoded and aligned once, however many copies it has.  Its links are written
  as distinct pairs of ids with their numbers.
* A pair's count is the number of its links in all documents: the texts' links
  weighted by their copies, summed in Spark.
* Each text then looks up its pairs' counts.  The most frequent pairs (at most
  ``frequent``) are looked up in the task that reads the text's links; the
  others, none of which is common, are joined with their counts.
* The measures return to the documents by the texts' sha256.  Texts with a
  large share of all documents are few, and are joined by broadcast.

An interval between neighbouring ends of either vocabulary lies in one token of
each, and each overlap is one such interval.  So ends are marked in an array of
the text's bytes, and running counts of the marks give groups and links.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from event_ml.llm.common import join_weighted, kept_in_worker, map_batches, most_frequent, staged, table
from event_ml.llm.tokens import Recent

ALIGNED = "key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, times array<int>"
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class ByteVocabulary:
    """The byte-level vocabulary of a tokenizer file, encoded from its list of ranks.

    Both files hold one vocabulary.  A run of more than ``longest`` characters
    without a blank is left to the tokenizer file's own reader, whose time
    doesn't grow with the square of the run.
    """

    def __init__(self, ranks: str, whole: str, pattern: str, longest: int = 4000):
        import tiktoken

        with open(ranks, "rb") as f:
            found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=found, special_tokens={})
        self.whole, self.longest = whole, longest
        self.bytes = [b""] * (max(found.values()) + 1)
        for token, i in found.items():
            self.bytes[i] = token

    def encode(self, text: str, widest: int) -> np.ndarray:
        if widest <= self.longest:
            return self.encoding.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        reader = Tokenizer.from_file(self.whole)
        reader.encode_special_tokens = True
        return np.array(reader.encode(text, add_special_tokens=False).ids, np.int64)


class PieceVocabulary:
    """A sentencepiece model.  No piece goes on after a blank that follows other
    characters, so the ids of a text are those of its chunks, blanks and what
    follows them; each chunk's are remembered."""

    CHUNK = re.compile(r" +[^ ]+(?: +\Z)?|\A +\Z")

    def __init__(self, model: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a piece holds a blank after other characters")
        self.known: Recent = Recent()

    def chunks(self, text: str) -> list[str]:
        """Of a text that begins with a blank."""
        return self.CHUNK.findall(text)

    def encode(self, texts: Sequence[list[str]]) -> list[np.ndarray | None]:
        """One id array for each text's chunks; None where the pieces aren't the text."""
        known = {c: self.known.get(c) for c in set().union(*texts)}
        fresh = [c for c, v in known.items() if v is None]
        for chunk, ids in zip(fresh, self.model.encode([c[1:] for c in fresh], num_threads=1), strict=True):
            same = b"".join([self.bytes[i] for i in ids]) == chunk.encode()
            known[chunk] = np.array(ids, "<i4").tobytes() if same else b"?"
            if len(chunk) <= 40:
                self.known.put(chunk, known[chunk])
        out = []
        for chunks in texts:
            parts = [known[c] for c in chunks]
            out.append(None if b"?" in parts else np.frombuffer(b"".join(parts), "<i4").astype(np.int64))
        return out


def _digits(n: int) -> np.ndarray:
    """Decimal digits of 0 to n - 1, a row each, zero bytes before them and a free last column."""
    width = len(str(n - 1))
    text = np.char.rjust(np.arange(n).astype(f"S{width}"), width, b" ")
    rows = np.frombuffer(text.tobytes(), np.uint8).reshape(n, width)
    return np.concatenate([np.where(rows == ord(" "), 0, rows), np.zeros((n, 1), np.uint8)], 1).astype(np.uint8)


class Aligner:
    def __init__(self, ranks: str, whole: str, pattern: str, model: str):
        self.a, self.b = ByteVocabulary(ranks, whole, pattern), PieceVocabulary(model)
        self.size_b = len(self.b.bytes)
        if len(self.a.bytes) * self.size_b > 2**31:
            raise ValueError("pairs of ids don't fit 32 bits")
        self.len_a = np.array([len(t) for t in self.a.bytes])
        self.len_b = np.array([len(t) for t in self.b.bytes])
        width = max(len(str(len(v.bytes) - 1)) for v in (self.a, self.b))
        self.text_a, self.text_b = (np.pad(d, ((0, 0), (width + 1 - d.shape[1], 0))) for d in (_digits(len(self.a.bytes)), _digits(self.size_b)))

    def ids(self, texts: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray, int] | None]:
        """(A's ids, B's ids, bytes) of each text, None where a vocabulary doesn't give it back."""
        spaced = [" " + t for t in texts]
        chunks = [self.b.chunks(t) for t in spaced]
        for text, own, b in zip(spaced, chunks, self.b.encode(chunks), strict=True):
            n = len(text.encode())
            a = self.a.encode(text, max(map(len, own))) if b is not None else None
            yield (a, b, n) if a is not None and self.len_a[a].sum() == n == self.len_b[b].sum() else None

    def align(self, a: np.ndarray, b: np.ndarray, n: int) -> tuple[int, np.ndarray, np.ndarray, str]:
        """(groups, distinct linked pairs in order, their numbers, the groups' digest)."""
        end_a, end_b = self.len_a[a].cumsum(), self.len_b[b].cumsum()
        in_a, in_b = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
        in_a[end_a] = in_b[end_b] = True
        ended_a, ended_b, ended = (np.cumsum(m, dtype=np.int32) for m in (in_a, in_b, in_a & in_b))
        cut = np.flatnonzero(in_a | in_b) - 1  # before an end, as many have ended as the token's place
        pairs, times = np.unique((a[ended_a[cut]] * self.size_b + b[ended_b[cut]]).astype(np.int32), return_counts=True)
        group_a, group_b = ended[end_a - 1], ended[end_b - 1]
        # a group's A ids stand after the B ids of the groups before it, its B ids after its A ids
        at_a = np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")
        at_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")
        text = np.empty((len(a) + len(b), self.text_a.shape[1]), np.uint8)
        text[at_a], text[at_b] = self.text_a[a], self.text_b[b]
        text[at_a, -1] = np.where(np.diff(group_a, append=-1) != 0, ord("|"), ord(","))
        text[at_b, -1] = np.where(np.diff(group_b, append=-1) != 0, ord(";"), ord(","))
        return int(ended[-1]), pairs, times.astype(np.int32), hashlib.sha256(text[text > 0][:-1].tobytes()).hexdigest()


def aligned_texts(docs: DataFrame, ranks: str, whole: str, pattern: str, model: str) -> DataFrame:
    """Each distinct text of ``docs`` (text) that isn't null or empty, aligned, with
    its number of copies; texts without tokens have none."""
    texts = docs.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = kept_in_worker(("aligner", ranks, model), lambda: Aligner(ranks, whole, pattern, model))
        none = np.empty(0, np.int32)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                own = part.column(0).to_pylist()
                rows = []
                for found in aligner.ids(own):
                    if found is None:
                        rows.append((0, 0, 0, 0, "", none, none))
                        continue
                    a, b, n = found
                    groups, pairs, times, name = aligner.align(a, b, n)
                    rows.append((len(a), len(b), groups, len(a) + len(b) - groups, name, pairs, times))
                *numbers, names, pairs, times = zip(*rows, strict=True)
                ends = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in pairs])]).astype(np.int32))
                values = [
                    pa.array([hashlib.sha256(t.encode()).digest() for t in own], pa.binary()),
                    part.column(1),
                    *[pa.array(x, pa.int64()) for x in numbers],
                    pa.array(names, pa.string()),
                    *[pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for x in (pairs, times)],
                ]
                yield pa.RecordBatch.from_arrays(values, [c.split()[0] for c in ALIGNED.split(", ")])

    return staged(map_batches(texts, run, ALIGNED).withColumn("row", F.monotonically_increasing_id()), "aligned-texts")


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): a pair's links in all documents, and whether no pair with its B id has more."""
    links = aligned.select("copies", F.explode(F.arrays_zip("pairs", "times")).alias("l"))
    counts = staged(links.groupBy(F.col("l.pairs").alias("pair")).agg(F.sum(F.col("copies") * F.col("l.times")).alias("n")), "pair-counts")
    b = (F.col("pair") % size_b).alias("b")
    most = counts.groupBy(b).agg(F.max("n").alias("most"))  # a row an id of B
    return staged(counts.withColumn("b", b).join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def looked_up(aligned: DataFrame, counts: DataFrame, frequent: int) -> DataFrame:
    """(row, n_best, count_sum) of every aligned text."""
    often = most_frequent(counts, "n", frequent)
    rows = often.toArrow()  # at most ``frequent`` rows of 13 bytes
    order = np.argsort(rows.column("pair").to_numpy())
    lookup = tuple(rows.column(c).to_numpy()[order] for c in ("pair", "n", "best"))
    shared = aligned.sparkSession.sparkContext.broadcast(lookup)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n, best = shared.value
        for batch in batches:
            pairs, times = batch.column(1), batch.column(2)
            ends = pairs.offsets.to_numpy() - pairs.offsets[0].as_py()
            pair, time = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            at = np.minimum(np.searchsorted(codes, pair), max(len(codes) - 1, 0))
            here = codes[at] == pair if len(codes) else np.zeros(len(pair), bool)
            sums = []
            for value in (best[at], n[at]) if len(codes) else (here, here):
                total = np.concatenate([[0], np.cumsum(np.where(here, value * time, 0))])
                sums.append(pa.array(total[ends[1:]] - total[ends[:-1]], pa.int64()))
            other = pa.array(np.concatenate([[0], np.cumsum(~here)])[ends].astype(np.int32))
            rest = [pa.ListArray.from_arrays(other, pa.array(x[~here].astype(np.int32))) for x in (pair, time)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *sums, *rest], ["row", "n_best", "count_sum", "pairs", "times"])

    schema = "row long, n_best long, count_sum long, pairs array<int>, times array<int>"
    found = staged(map_batches(aligned.select("row", "pairs", "times"), run, schema), "pair-lookup")
    rare = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("t"))
    rare = rare.join(counts, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("t")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("t")).alias("more"))
    whole = found.drop("pairs", "times").join(rare, "row", "left")
    return whole.select("row", *[(F.col(c) + F.coalesce(more, F.lit(0))).alias(c) for c, more in (("n_best", "more_best"), ("count_sum", "more"))])


def align(
    docs: DataFrame,
    ranks: str | None = None,
    whole: str | None = None,
    pattern: str | None = None,
    model: str | None = None,
    frequent: int = 2_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    ``ranks`` and ``whole`` are A's vocabulary as ranks and as a tokenizer file,
    ``pattern`` its word pattern, ``model`` B's.  ``n_best`` counts the links
    whose pair has the highest count of its B id, ties included; ``count_sum``
    adds the links' counts.  Strings that look like special tokens are text.

    Null and empty texts, and texts that a vocabulary's tokens don't give back,
    have zeros and an empty digest and add nothing to the counts.  Texts of any
    length are aligned whole.  Repeated rows and texts count each time, and each
    row has its result; a null id stays null.  Other columns, whatever their
    names, are not read.  An empty table gives no rows.
    """
    import public_tokenizers

    path = public_tokenizers.path
    ranks, whole, model = ranks or path("byte_bpe_50k.tiktoken"), whole or path("byte_bpe_50k.json"), model or path("piece_bpe_32k.model")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keyed = staged(rows.select("doc_id", F.when(F.col("text") != "", F.unhex(F.sha2("text", 256))).alias("key")), "text-keys")
    aligned = aligned_texts(rows.select("text"), ranks, whole, pattern or public_tokenizers.PATTERN, model)
    counts = pair_counts(aligned, len(PieceVocabulary(model).bytes))
    own = aligned.drop("pairs", "times").join(looked_up(aligned, counts, frequent), "row").drop("row")
    found = join_weighted(keyed.where("key IS NOT NULL"), staged(own, "text-measures"), "key", "copies")
    zeros = keyed.where("key IS NULL").select("doc_id", *[F.lit(0).cast("long").alias(c) for c in MEASURES], F.lit("").alias("groups_sha256"))
    return found.select("doc_id", *MEASURES, "groups_sha256").unionByName(zeros)


def op12_exact_dedup_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
