"""WARC archives of one Zstandard frame a record.

An archive opens with a skippable frame that holds the dictionary of all its
records' frames.  Records of equal payloads of at least ``min_revisit`` bytes
are one ``response`` and ``revisit`` records that refer to it.

Each task writes its own archives under names of its own and hands on their
names; only names of tasks that ended are read.  The reader takes an archive a
task, holds one record at a time, and checks frames, headers, lengths and
digests.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from event_ml.llm.common import map_batches, open_store, scratch_dir, staged, table

#: Fixed values of the format: the dictionary's skippable frame, the range of
#: skippable frames, a data frame's magic number, and the revisit profile.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: No capture time is known of the rows.
DATE = "1970-01-01T00:00:00Z"

COLUMNS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string"


class WarcError(ValueError):
    """An archive that breaks the format."""


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """A response's record, or with ``refers_to`` a revisit's (without payload)."""
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}"]
    if url:
        fields.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        fields += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    fields += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor().compress(dictionary)
    return struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed


def frames(stream: BinaryIO, chunk: int = 1 << 18) -> Iterator[bytes]:
    """The content of each data frame; the leading skippable frame gives their dictionary."""
    held, first, codec = b"", True, zstandard.ZstdDecompressor()

    def more(n: int) -> None:
        nonlocal held
        while len(held) < n and (got := stream.read(max(chunk, n - len(held)))):
            held += got

    while True:
        more(8)
        if not held:
            return
        if len(held) < 8:
            raise WarcError("archive ends inside a frame's header")
        magic, size = struct.unpack("<II", held[:8])
        if magic in SKIPPABLE:
            more(8 + size)
            if len(held) < 8 + size:
                raise WarcError("archive ends inside a skippable frame")
            body, held = held[8 : 8 + size], held[8 + size :]
            if first and magic == DICTIONARY_MAGIC:
                if body[:4] == struct.pack("<I", FRAME_MAGIC):
                    body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
                codec = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
        elif magic == FRAME_MAGIC:
            more(18)
            told = zstandard.frame_content_size(held[:18])
            one, parts = codec.decompressobj(), []
            try:
                while not one.eof:
                    parts.append(one.decompress(held))
                    held = one.unused_data if one.eof else stream.read(chunk)
                    if not held and not one.eof:
                        raise WarcError("archive ends inside a frame")
            except zstandard.ZstdError as e:
                raise WarcError(f"frame can't be decoded: {e}") from e
            content = b"".join(parts)
            if told >= 0 and told != len(content):
                raise WarcError(f"frame tells {told} bytes and has {len(content)}")
            yield content
        else:
            raise WarcError(f"no frame begins with {magic:#x}")
        first = False


def parsed(content: bytes) -> tuple[int | None, int, str, str, int | None]:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of a frame that is one whole record."""

    def fields(lines: list[bytes]) -> dict[str, str]:
        pairs = [x.decode("utf-8").partition(":") for x in lines]
        if not all(colon for _, colon, _ in pairs):
            raise WarcError("header line without a colon")
        return {k.strip().lower(): v.strip() for k, _, v in pairs}

    def page(urn: str) -> int | None:
        if not (m := re.fullmatch(r"<urn:page:(-?\d*)>", urn)):
            raise WarcError(f"no page is named by {urn}")
        return int(m[1]) if m[1] else None

    head, gap, rest = content.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not gap or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise WarcError("no WARC header")
    own = fields(lines)
    if lacking := {"warc-type", "warc-record-id", "warc-date", "content-length"} - own.keys():
        raise WarcError(f"header lacks {sorted(lacking)}")
    if not own["content-length"].isdigit() or len(rest) != int(own["content-length"]) + 4 or not rest.endswith(b"\r\n\r\n"):
        raise WarcError("block and Content-Length differ")
    http, gap, payload = rest[:-4].partition(b"\r\n\r\n")
    kind, digest = own["warc-type"], own.get("warc-payload-digest", "").removeprefix("sha256:")
    size = fields(http.split(b"\r\n")[1:]).get("content-length", "")
    if not gap or not size.isdigit():
        raise WarcError("no HTTP header with a length")
    if kind == "response":
        if len(payload) != int(size) or hashlib.sha256(payload).hexdigest() != digest:
            raise WarcError("payload and its length or digest differ")
        return page(own["warc-record-id"]), int(size), digest, kind, None
    if kind != "revisit" or payload or "warc-refers-to" not in own or own.get("warc-profile") != REVISIT_PROFILE:
        raise WarcError(f"no whole response or revisit: {kind}")
    return page(own["warc-record-id"]), int(size), digest, kind, page(own["warc-refers-to"])


def trained_dictionary(pages: DataFrame, id_col: str, html_col: str, rows: int = 200, chars: int = 16384, size: int = 32768) -> bytes:
    """A dictionary from the beginnings of ``rows`` pages, chosen by hash; empty if there is too little.

    It only makes frames smaller; what they hold doesn't depend on it.  The
    hashes are ranked first, so tasks send texts of chosen pages alone.
    """
    some = pages.select(F.substring(html_col, 1, chars).alias("t"), F.xxhash64(id_col, html_col).alias("h")).where("length(t) > 0")
    last = some.select("h").orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    if last is None:
        return b""
    got = [r[0].encode("utf-8", "replace") for r in some.where(F.col("h") <= last).orderBy("h", "t").limit(rows).collect()]
    try:
        return zstandard.train_dictionary(size, got).as_bytes() if len(got) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def with_records(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_revisit: int) -> DataFrame:
    """(page_id, url, html, size, digest, refers_to) of every row."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    rows = rows.select("*", F.octet_length("html").cast("long").alias("size"), F.sha2(F.col("html"), 256).alias("digest"))
    light = rows.where(F.col("size") >= min_revisit).select("digest", "page_id")
    first = light.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    refers = F.when((F.col("size") >= min_revisit) & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(first, "digest", "left").select("page_id", "url", "html", "size", "digest", refers.alias("refers_to"))


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_revisit: int = 100,
    roll_bytes: int = 64 << 20,
    level: int = 3,
) -> DataFrame:
    """Writes one record a row below ``folder``; (archive, records, bytes) of each file.

    A null html is an empty payload, a null url an empty one; payloads of any
    size are one record.  Rows that share the smallest id of their payload, such
    as repeated rows, are all responses, and a null id is larger than any.  Other
    columns, whatever their names, are not read.  An empty table writes no file.
    """
    dictionary = trained_dictionary(pages, id_col, html_col)
    rows = with_records(pages, id_col, url_col, html_col, min_revisit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        packer = zstandard.ZstdCompressor(level=level, write_checksum=True, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        out, name, n, size = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64()), pa.array([size], pa.int64())], ["archive", "records", "bytes"])

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                for page_id, url, html, length, digest, refers in zip(*(c.to_pylist() for c in batch.slice(at, 128).columns), strict=True):
                    if out is None:
                        name, n = f"pages-{uuid.uuid4().hex}.warc.zst", 0
                        out = store.open_output_stream(f"{root}/{name}")
                        begin = dictionary_frame(dictionary) if dictionary else b""
                        out.write(begin)
                        size = len(begin)
                    frame = packer.compress(record(page_id, url, html.encode("utf-8", "replace"), digest, length, refers))
                    out.write(frame)
                    n, size = n + 1, size + len(frame)
                    if size >= roll_bytes:
                        yield closed()
                        out = None
        if out is not None:
            yield closed()

    return staged(map_batches(rows, run, "archive string, records long, bytes long"), "warc-archives")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """One row a record of the named archives; a broken archive raises ``WarcError``.

    A revisit's bytes and digest are those of the full payload that it stands for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with store.open_input_stream(f"{root}/{name}") as stream:
                    for content in frames(stream):
                        rows.append((*parsed(content), name))
                        if len(rows) == 4096:
                            yield pack(rows)
                            rows = []
                if rows:
                    yield pack(rows)

    return map_batches(archives.select("archive").repartition("archive"), run, COLUMNS)


def op10_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back."""
    folder = scratch_dir(spark, "warc")
    return read_archives(write_archives(table(spark, sf_dir, "pages"), folder), folder).drop("archive")


OP10_SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT p.*, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id IS DISTINCT FROM page_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM f
"""
