"""Cost-balanced packing of documents into fixed-length training sequences.

A piece of n tokens costs ``linear * n + quadratic * n * n`` (projections and
attention).  Documents, longest first, go to the cheapest sequence that still
has room for them; one that fits nowhere is cut at the roomiest sequence's end
and its rest queues again.  A task packs its own rows in blocks of about
``block_tokens`` tokens, so nothing is shuffled and memory is bounded.

The sequences of a block hold exactly its tokens: full ones of ``capacity``
tokens, and the remainder split into powers of two, which need no padding.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from event_ml.llm.common import map_batches, table
from event_ml.llm.tokens import default_vocabulary, encoder

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, sequence_tokens long, sequence_cost double"
)


def room_for(total: int, capacity: int) -> list[int]:
    """Lengths of the sequences that hold ``total`` tokens without padding."""
    full, rest = divmod(total, capacity)
    return [capacity] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def balance(
    lengths: list[int], capacity: int, linear: float, quadratic: float
) -> tuple[list[tuple[int, int, int, int, int]], list[int], np.ndarray]:
    """Pieces (document, start, length, sequence, offset), the sequences'
    lengths and costs.  Ties: the earlier document, the earlier sequence."""
    room = room_for(sum(lengths), capacity)
    left, cost = np.array(room, np.int64), np.zeros(len(room))
    queue = [(-n, d, 0) for d, n in enumerate(lengths) if n]
    heapq.heapify(queue)
    pieces = []
    while queue:
        n, doc, start = heapq.heappop(queue)
        n = -n
        fits = left >= n
        to = int(np.where(fits, cost, np.inf).argmin()) if fits.any() else int(left.argmax())
        take = min(n, int(left[to]))
        pieces.append((doc, start, take, to, room[to] - int(left[to])))
        left[to] -= take
        cost[to] += linear * take + quadratic * take * take
        if take < n:
            heapq.heappush(queue, (take - n, doc, start + take))
    return pieces, room, cost


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    end_id: int = 2,
    capacity: int = 4096,
    linear: float = 1.0,
    quadratic: float = 1.0 / 6144,
    block_tokens: int = 1 << 21,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row a piece: its document, the place in it, and the place in a sequence.

    A document's ids are those of its text (null: none) and then ``end_id``, so
    empty documents have one token; the string of a special token gives its id.  Repeated rows are packed as documents of
    their own; a null id stays null; other columns, whatever their names, are not
    read.  Texts longer than a sequence are cut.  No rows give no pieces.  ``sequence_id`` is the task's number and a count inside it.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    vocabulary = vocabulary or default_vocabulary()

    def emit(ids: list[int | None], tokens: list[np.ndarray], base: int) -> tuple[pa.RecordBatch, int]:
        pieces, room, cost = balance([len(t) for t in tokens], capacity, linear, quadratic)
        rows = [
            (ids[d], s, n, zlib.crc32(tokens[d][s : s + n].tobytes()), len(tokens[d]), base + q, o, room[q], float(cost[q]))
            for d, s, n, q, o in pieces
        ]
        columns = zip(*rows, strict=True)
        types = [pa.int64()] * 8 + [pa.float64()]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names), base + len(room)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4")
        base = TaskContext.get().partitionId() << 40
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(1).to_pylist()
                for doc, own in zip(part.column(0).to_pylist(), encoder(vocabulary, special=True).encode(texts), strict=True):
                    ids.append(doc)
                    tokens.append(np.concatenate([own, end]))
                    held += len(own) + 1
                    if held >= block_tokens:
                        out, base = emit(ids, tokens, base)
                        yield out
                        ids, tokens, held = [], [], 0
        if ids:
            yield emit(ids, tokens, base)[0]

    return map_batches(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), run, SCHEMA)


def op8_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
