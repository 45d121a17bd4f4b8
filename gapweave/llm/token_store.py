"""Token ids of documents as raw binary shards, with a minimal perfect hash index.

``write_token_store`` lays out a folder:

* ``shard-00012.ids``: the ids of consecutive documents, little-endian unsigned integers of 16 bits
  if the vocabulary allows it, else 32, each document followed by the end id; shards follow each
  other in ascending key order.
* ``entries``: a Parquet table of the documents: key, which of the rows with that key, shard,
  place in the shard, number of ids.
* ``index-00003.mph``: for a share of the keys, a minimal perfect hash table to (shard, place,
  number of ids), with a 32-bit fingerprint of each key.
* ``manifest.json``: bytes of an id, number of index tables.

Each task writes whole files of its own under a draft name and renames them, so a lost executor's
task can be run again.

Skew: documents are dealt to shards by key and by how their texts begin, so the rows of a key that repeats lie in several
shards; the tasks number them one by one, and what lies in the shards before is added afterwards. Only rows that also agree
in the first RANGE_CHARS code points of the text stay in one shard.

Defined cases: a null text counts as empty (only the end id); null keys come first;
rows that repeat a key are kept side by side, ordered by text, and numbered from 0; other columns
of the documents are not looked at; an empty table gives a store without shards; a text longer than a slice of a batch is
encoded alone.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gapweave.llm import perfect_hash
from gapweave.llm.shared import on_workers, open_file, read_file, shuffle_partitions, whole_file, written
from gapweave.llm.tokens import encoder
from gapweave.llm.words import slices

KEYS_PER_TABLE = 500_000
READ_BYTES = 1 << 23
RANGE_CHARS = 64
MANIFEST = "manifest.json"


def shard_name(number: int) -> str:
    return f"shard-{number:05d}.ids"


def index_name(number: int) -> str:
    return f"index-{number:05d}.mph"


def with_hashes(df: DataFrame, tables: int) -> DataFrame:
    """The 64-bit key, the fingerprint and the index table of each (key, nth)."""
    return (
        df.withColumn("_key", F.xxhash64("key", "nth"))
        .withColumn("_print", F.hash("nth", "key"))
        .withColumn("_table", F.pmod("_key", F.lit(tables)).cast("int"))
    )


class TokenStore:
    """A written store."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        manifest = json.loads(read_file(path, MANIFEST))
        self.tables, self.id_bytes = manifest["tables"], manifest["id_bytes"]

    def entries(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/entries")

    def shard_starts(self) -> DataFrame:
        """Ids before each shard; one row a shard."""
        sizes = self.entries().groupBy("shard").agg(F.sum("n_tokens").alias("ids"))
        before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        return sizes.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("shard_start"))

    def locate(self, keys: DataFrame) -> DataFrame:
        """Where the documents (key, nth) are, by the index; unknown ones are left out."""
        path, tables = self.path, self.tables
        asked = with_hashes(keys.select("key", "nth"), tables)
        kind = asked.schema["key"].dataType.simpleString()

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number, table = -1, None
            for batch in batches:
                of = batch.column("_table").to_numpy()
                cuts = np.flatnonzero(np.diff(of)) + 1
                for begin, end in zip([0, *cuts], [*cuts, len(of)], strict=True):
                    if end == begin:
                        continue
                    if of[begin] != number:
                        number = int(of[begin])
                        table = perfect_hash.Table(read_file(path, index_name(number)))
                    part = batch.slice(begin, end - begin)
                    values, found = table.find(
                        part.column("_key").to_numpy().view(np.uint64), part.column("_print").to_numpy()
                    )
                    part = part.filter(pa.array(found))
                    columns = [part.column("key"), part.column("nth")]
                    columns += [pa.array(values[found, i]) for i in range(3)]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "nth", "shard", "place", "n_tokens"])

        n = min(tables, shuffle_partitions(self.spark))
        return (
            asked.repartition(n, "_table")
            .sortWithinPartitions("_table")
            .mapInArrow(find, f"key {kind}, nth long, shard long, place long, n_tokens long")
        )

    def read(self, keys: DataFrame, digest_only: bool = False) -> DataFrame:
        """The ids of the documents (key, nth), as little-endian 32-bit integers, and the CRC-32 of these."""
        path, width = self.path, self.id_bytes
        places = self.locate(keys)
        kind = places.schema["key"].dataType.simpleString()

        def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                shards = batch.column("shard").to_numpy()
                begins = batch.column("place").to_numpy() * width
                sizes = batch.column("n_tokens").to_numpy() * width
                cuts = np.flatnonzero(np.diff(shards)) + 1
                for begin, end in zip([0, *cuts], [*cuts, len(shards)], strict=True):
                    if end == begin:
                        continue
                    with open_file(path, shard_name(int(shards[begin]))) as f:
                        held, base = b"", 0
                        row = begin
                        while row < end:
                            payloads, crcs, first, total = [], [], row, 0
                            while row < end and total < READ_BYTES:
                                a, n = int(begins[row]), int(sizes[row])
                                if a < base or a + n > base + len(held):
                                    f.seek(a)
                                    held, base = f.read(max(n, READ_BYTES)), a
                                stored = np.frombuffer(held, f"<u{width}", n // width, a - base)
                                payload = stored.astype("<u4").tobytes()
                                crcs.append(zlib.crc32(payload))
                                if not digest_only:
                                    payloads.append(payload)
                                total += n
                                row += 1
                            out = batch.slice(first, row - first)
                            columns = [out.column(c) for c in ("key", "nth", "shard", "place", "n_tokens")]
                            columns.append(pa.array(payloads if payloads else [None] * len(crcs), pa.binary()))
                            columns.append(pa.array(crcs, pa.int64()))
                            yield pa.RecordBatch.from_arrays(
                                columns, ["key", "nth", "shard", "place", "n_tokens", "ids", "ids_crc32"]
                            )

        return (
            places.repartition(shuffle_partitions(self.spark), "shard")
            .sortWithinPartitions("shard", "place")
            .mapInArrow(
                fetch,
                f"key {kind}, nth long, shard long, place long, n_tokens long, ids binary, ids_crc32 long",
            )
        )


def numbered(parts: DataFrame) -> DataFrame:
    """``parts`` with ``nth`` counted over all shards instead of within one.

    A key in several shards is the first or the last of each, so what is joined has a few rows for each shard.
    """
    ends = parts.groupBy("shard").agg(F.array(F.min(F.struct("key")), F.max(F.struct("key"))).alias("ends"))
    edges = ends.select(F.explode("ends").alias("end")).select(F.col("end.key").alias("edge")).distinct()
    held = parts.join(F.broadcast(edges), F.col("key").eqNullSafe(F.col("edge")), "left_semi")
    sizes = held.groupBy(F.col("key").alias("edge"), F.col("shard").alias("of")).count()
    earlier = Window.partitionBy("edge").orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("before", F.sum("count").over(earlier)).where("before > 0")
    same = F.col("key").eqNullSafe(F.col("edge")) & (F.col("shard") == F.col("of"))
    nth = (F.col("nth") + F.coalesce("before", F.lit(0))).alias("nth")
    return parts.join(F.broadcast(before), same, "left").select("key", nth, "shard", "place", "n_tokens")


def write_token_store(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    lower_words: bool = False,
    end_id: int = 0,
    key: str = "doc_id",
    text: str = "text",
) -> TokenStore:
    """Encode every whole text and write the store; returns it."""
    spark = docs.sparkSession
    on_workers(spark)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    most = max(end_id, encoder(tokenizer, lower_words).library.get_vocab_size() - 1)
    width = 2 if most < 1 << 16 else 4

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        encode = encoder(tokenizer, lower_words)
        place, last, nth = 0, (), 0
        parts = slices(batches, "text")
        first = next(parts, None)
        if first is None:
            return
        with whole_file(path, shard_name(number)) as out:
            for part in chain([first], parts):
                ids, where = encode.encode(part.column("text"), end_id)
                out.write(ids.astype(f"<u{width}").tobytes())
                counts = []
                for k in part.column("key").to_pylist():
                    nth = nth + 1 if last == (k,) else 0
                    last = (k,)
                    counts.append(nth)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"),
                        pa.array(counts, pa.int64()),
                        pa.array(np.full(part.num_rows, number, np.int64)),
                        pa.array(where[:-1] + place),
                        pa.array(np.diff(where)),
                    ],
                    ["key", "nth", "shard", "place", "n_tokens"],
                )
                place += len(ids)

    shards = shuffle_partitions(spark)
    # a prefix sorts as the text does, and what Spark samples of it to find the ranges stays small
    parts = written(
        rows.repartitionByRange(shards, F.col("key"), F.substring("text", 1, RANGE_CHARS))
        .sortWithinPartitions("key", "text")
        .mapInArrow(write, f"key {kind}, nth long, shard long, place long, n_tokens long"),
        "places",
    )
    numbered(parts).write.parquet(f"{path}/entries")
    entries = spark.read.parquet(f"{path}/entries")
    tables = max(1, -(-entries.count() // KEYS_PER_TABLE))

    def index(group: pa.Table) -> pa.Table:
        number = group.column("_table")[0].as_py()
        values = np.stack([group.column(c).to_numpy() for c in ("shard", "place", "n_tokens")], axis=1)
        keys = group.column("_key").to_numpy().view(np.uint64)
        raw = perfect_hash.build(keys, group.column("_print").to_numpy(), values)
        with whole_file(path, index_name(number)) as out:
            out.write(raw)
        return pa.table({"index": [number], "keys": [group.num_rows], "bytes": [len(raw)]})

    (
        with_hashes(entries, tables)
        .select("_table", "_key", "_print", "shard", "place", "n_tokens")
        .groupBy("_table")
        .applyInArrow(index, T._parse_datatype_string("index long, keys long, bytes long"))
        .write.parquet(f"{path}/tables")
    )
    with whole_file(path, MANIFEST) as out:
        out.write(json.dumps({"id_bytes": width, "tables": tables}).encode())
    return TokenStore(spark, path)


def token_store_rows(store: TokenStore) -> DataFrame:
    """Every document of a store read back from its files through the index."""
    read = store.read(store.entries().select("key", "nth"), digest_only=True)
    starts = F.broadcast(store.shard_starts())  # a row for each shard, so at most one for each write task
    return read.join(starts, "shard").select(
        F.col("key"), (F.col("shard_start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )
