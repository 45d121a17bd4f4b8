"""WARC archives in Zstandard with a dictionary made from the records themselves.

A file starts with a skippable frame that holds the dictionary, trained from the first
``sample_bytes`` of records of that file; then each record is a frame of its own, so that one can be read alone.
Of equal payloads of at least ``min_revisit`` bytes, the record of the largest page id is a
``response`` and the others are ``revisit`` records that name it.

Files are written by the tasks of one job under names that no other attempt uses; the table
``records``, which Spark commits, says which files and places count, so a task may be run again.
A task holds the sample and one record at a time. A hot payload is joined by its digest, where
Spark splits large partitions; revisits hold no payload.

Defined cases: null html is an empty payload, always a response; a null url leaves its header
out; a null page id is smaller than all; rows that repeat the largest id are all responses; other
columns are not looked at; an empty table gives no files.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.llm.shared import on_workers, open_file, shuffle_partitions, whole_file, written
from gapweave.llm.words import slices

MIN_REVISIT = 1000
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 1 << 15
DATE = "1970-01-01T00:00:00Z"
LEVEL = 3
CHUNK = 1 << 16

# fixed values of the formats
SKIPPABLE = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One record; ``first`` is the page that it revisits."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if first is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.insert(4, "WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if first is not None:
        lines[4:4] = [f"WARC-Refers-To: <urn:page:{first}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of a record, its payload if it has one."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))
    page = lambda name: int(x) if (x := fields[name][len("<urn:page:") : -1]) else None
    revisit = fields["WARC-Type"] == "revisit"
    return {
        "page_id": page("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": int(length.split(": ")[1]) if revisit else len(payload),
        "payload_digest": fields["WARC-Payload-Digest"][5:] if revisit else hashlib.sha1(payload).hexdigest(),
        "record_type": fields["WARC-Type"],
        "refers_to": page("WARC-Refers-To") if revisit else None,
        "payload": None if revisit else payload,
    }


def dictionary(sample: list[bytes], size: int):
    """Trained on the sample; too small a sample is the dictionary itself."""
    import zstandard

    total = sum(map(len, sample))
    if len(sample) >= 20 and total >= 8 * size:
        try:
            return zstandard.train_dictionary(size, sample)
        except zstandard.ZstdError:
            pass
    content = b"".join(sample)[:size]
    return zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def linked(pages: DataFrame, min_revisit: int) -> DataFrame:
    """Pages with the digest of the payload and the page to refer to."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    copies = (
        rows.where(F.octet_length("html") >= min_revisit)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    # written, so that both sides of the join are plain shuffles, of which Spark splits large partitions
    return rows.join(written(copies, "copies"), "digest", "left").withColumn(
        "first", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    )


def write_warc(
    pages: DataFrame,
    path: str,
    min_revisit: int = MIN_REVISIT,
    sample_bytes: int = SAMPLE_BYTES,
    dictionary_bytes: int = DICTIONARY_BYTES,
) -> DataFrame:
    """Write the archives; returns the table of records (page_id, file, place, length)."""
    spark = pages.sparkSession
    on_workers(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        def records() -> Iterator[tuple[int | None, bytes]]:
            for part in slices(batches, "html"):
                columns = [part.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "first")]
                for page, url, html, digest, first in zip(*columns, strict=True):
                    yield page, record(page, url, html.encode(), digest, first)

        rest = records()
        held, total = [], 0
        for one in rest:
            held.append(one)
            total += len(one[1])
            if total >= sample_bytes:
                break
        if not held:
            return
        words = dictionary([x for _, x in held], dictionary_bytes)
        name = f"{uuid.uuid4().hex}.warc.zst"
        zip_one = zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_checksum=True)
        with whole_file(path, name) as out:
            raw = words.as_bytes()
            out.write(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
            place, rows = 8 + len(raw), []
            while held:
                for page, content in held:
                    frame = zip_one.compress(content)
                    out.write(frame)
                    rows.append((page, name, place, len(frame)))
                    place += len(frame)
                held = [x for x in [next(rest, None)] if x is not None]
                if len(rows) >= 10_000 or not held:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[i] for r in rows], t) for i, t in enumerate(RECORD_TYPES)],
                        ["page_id", "file", "place", "length"],
                    )
                    rows = []

    linked(pages, min_revisit).mapInArrow(
        write, "page_id long, file string, place long, length long"
    ).write.parquet(f"{path}/records")
    return spark.read.parquet(f"{path}/records")


RECORD_TYPES = (pa.int64(), pa.string(), pa.int64(), pa.int64())


def file_records(path: str, name: str) -> Iterator[bytes]:
    """The records of one archive, one after the other."""
    import zstandard

    with open_file(path, name) as f:
        magic, size = struct.unpack("<II", f.read(8))
        if magic != SKIPPABLE:
            raise ValueError(f"{name} has no dictionary frame")
        unzip = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(f.read(size)))
        raw = f.read(CHUNK)
        while raw:
            frame, parts = unzip.decompressobj(), []
            while True:
                parts.append(frame.decompress(raw))
                if frame.eof:
                    break
                raw = f.read(CHUNK)
                if not raw:
                    raise ValueError(f"{name} ends within a record")
            raw = frame.unused_data or f.read(CHUNK)
            yield b"".join(parts)


def read_warc(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of all archives that the table of records names."""
    on_workers(spark)
    files = spark.read.parquet(f"{path}/records").select("file").distinct()
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    if not with_payload:
        names, types = names[:-1], types[:-1]
    schema = pa.schema(list(zip(names, types, strict=True)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows, held = [], 0
                for raw in file_records(path, name):
                    row = parse(raw)
                    rows.append(row)
                    held += len(raw) if with_payload else 100
                    if held > 1 << 22:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    kinds = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return files.repartition(shuffle_partitions(spark), "file").mapInArrow(
        read, kinds + (", payload binary" if with_payload else "")
    )
