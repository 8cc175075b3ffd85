"""Token counts from flat token files by scanning for the end-of-document id.

A flat file is nothing but fixed-width little-endian ids; where documents end
is known only from the separators in it.  Files are cut into blocks of
``block_bytes``; each block is read on its own and compared with the separator
in one vector operation.  A document that crosses blocks is stitched by a
prefix scan over one summary row a block: separators before it, and the last
separator's place.  The scan has two levels (blocks in runs of ``SPAN``, then
runs), so one huge file is no single window.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from event_ml.llm.common import map_batches, open_store, scratch_dir, staged, table
from event_ml.llm.tokens import default_vocabulary, encoder

#: Blocks whose summaries one window row group holds.
SPAN = 4096


def write_token_files(
    docs: DataFrame,
    folder: str,
    vocabulary: str | None = None,
    separator: int = 49407,
    dtype: str = "<u2",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write each task's documents to one flat file; returns (doc_id, file, ordinal).

    The returned table is written with Spark's commit protocol and names only
    files of tasks that ended; what a lost attempt left is never read.  A null
    or empty text has no ids before its separator; a text of any length is one
    document.  Repeated rows are written each, a null id stays null, and other
    columns, whatever their names, are not read.  An empty table writes no file.
    """
    vocabulary = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([separator], dtype).tobytes()
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        name, out, n = f"tokens-{uuid.uuid4().hex}.bin", None, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = out or store.open_output_stream(f"{root}/{name}")
                for own in encoder(vocabulary, dtype).encode(part.column(1).to_pylist()):
                    if (own == separator).any():
                        raise ValueError("the separator is an id of ordinary text")
                    out.write(own.tobytes() + end)
                ordinals = pa.array(range(n, n + part.num_rows), pa.int64())
                n += part.num_rows
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([name] * part.num_rows), ordinals], ["doc_id", "file", "ordinal"])
        if out:
            out.close()

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return staged(map_batches(texts, run, "doc_id long, file string, ordinal long"), "token-manifest")


def scan_separators(
    files: DataFrame, separator: int = 49407, dtype: str = "<u2", block_bytes: int = 4 << 20
) -> DataFrame:
    """(path, ordinal, start, n_tokens, terminated) of every document in ``files`` (path, length).

    ``start`` counts ids from the file's beginning; the separator is not
    counted in ``n_tokens``.  Two separators in a row bound an empty document.
    Ids after the last separator are a document with ``terminated`` false.  An
    empty file has none, no files give no rows, and a document may be longer
    than any block.  A file whose length is no multiple of the id's width
    is an error.
    """
    width = np.dtype(dtype).itemsize
    block_bytes -= block_bytes % width

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if length % width:
                    raise ValueError(f"{path}: {length} bytes are no whole number of {width}-byte ids")
                store, name = open_store(path)
                with store.open_input_file(name) as f:
                    ids = np.frombuffer(f.read_at(min(block_bytes, length - block * block_bytes), block * block_bytes), dtype)
                ends = np.flatnonzero(ids == separator) + block * (block_bytes // width)
                row = [[path], [block], [len(ids)], [len(ends)], [int(ends[-1]) if len(ends) else None], [ends]]
                types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                names = ["path", "block", "ids", "n_ends", "last_end", "ends"]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)], names)

    blocks = files.where("length > 0").select(
        "path", "length", F.explode(F.expr(f"sequence(0L, (length - 1) div {block_bytes}L)")).alias("block")
    )
    schema = "path string, block long, ids long, n_ends long, last_end long, ends array<long>"
    found = staged(map_batches(blocks.repartition("path", "block"), find, schema), "token-blocks")
    summary = found.select("path", "block", "ids", "n_ends", "last_end", F.expr(f"block div {SPAN}").alias("run"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    in_run = before(Window.partitionBy("path", "run").orderBy("block"))
    over_runs = before(Window.partitionBy("path").orderBy("run"))
    runs = summary.groupBy("path", "run").agg(F.sum("n_ends").alias("n"), F.max("last_end").alias("last"))
    runs = runs.select(
        "path", "run", F.coalesce(F.sum("n").over(over_runs), F.lit(0)).alias("run_n"), F.max("last").over(over_runs).alias("run_last")
    )
    carried = (
        summary.select("path", "run", "block", F.sum("n_ends").over(in_run).alias("n"), F.max("last_end").over(in_run).alias("last"))
        .join(runs, ["path", "run"])
        .select(
            "path",
            "block",
            (F.coalesce("n", F.lit(0)) + F.col("run_n")).alias("first_ordinal"),
            (F.coalesce("last", "run_last", F.lit(-1)) + 1).alias("carry"),
        )
    )
    whole = (
        found.where("n_ends > 0")
        .join(carried, ["path", "block"])
        .select("path", "first_ordinal", "carry", "ends", F.posexplode("ends").alias("i", "end"))
        .select(
            "path",
            (F.col("first_ordinal") + F.col("i")).alias("ordinal"),
            F.when(F.col("i") == 0, F.col("carry")).otherwise(F.expr("ends[i - 1] + 1")).alias("start"),
            "end",
            F.lit(True).alias("terminated"),
        )
    )
    tails = (
        summary.groupBy("path")
        .agg(F.sum("ids").alias("end"), F.sum("n_ends").alias("ordinal"), F.coalesce(F.max("last_end") + 1, F.lit(0)).alias("start"))
        .where("end > start")
        .select("path", "ordinal", "start", "end", F.lit(False).alias("terminated"))
    )
    return whole.unionByName(tails).select("path", "ordinal", "start", (F.col("end") - F.col("start")).alias("n_tokens"), "terminated")


def op1_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents: their ids are written to flat files, the
    files scanned, and the scan's ordinals joined with the ids they stand for."""
    folder = scratch_dir(spark, "token-files")
    manifest = write_token_files(table(spark, sf_dir, "documents"), folder)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, n_tokens long, start long, file string, ordinal long")
    files = spark.read.format("binaryFile").load(folder).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    own = files.withColumn("file", name).join(manifest.select("file").distinct(), "file", "left_semi").select("path", "length")
    scanned = scan_separators(own).withColumn("file", name)
    return manifest.join(scanned, ["file", "ordinal"]).select("doc_id", "n_tokens", "start", "file", "ordinal")
