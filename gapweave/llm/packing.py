"""Packing of token sequences: best fit in each partition, then up a tree of underfull bins.

A document becomes its ids and the end id; what is longer than a sequence is cut into whole
sequences and a rest. Every round deals its items to tasks of at most about ``ITEMS_PER_TASK``,
each of which packs them by best fit, longest first. Bins that are full but for ``slack`` ids are
done; the others go to the next round as items themselves, so that a round's tasks are merged
``1/shrinkage`` to one. It ends when one task has seen all that was left, or when a round has
merged next to nothing (such as bins that are all more than half full). Only lengths are moved, never ids.

Defined cases: a null or empty text is its end id alone; repeated rows are packed one by one; other
columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.shared import on_workers, written
from gapweave.llm.tokens import encoder
from gapweave.llm.words import slices

ITEMS_PER_TASK = 50_000
SLACK = 4
LEAST_GAIN = 0.01

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    lower_words: bool,
    end_id: int,
    size: int,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The pieces of all documents: place and length in the document, and the CRC-32 of the ids."""
    on_workers(docs.sparkSession)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = encoder(tokenizer, lower_words)
        for part in slices(batches, "text"):
            ids, where = use.encode(part.column("text"), end_id)
            raw = memoryview(ids.astype("<u4").tobytes())
            counts = -(-np.diff(where) // size)
            row = np.repeat(np.arange(len(counts)), counts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            begin = where[:-1][row] + piece * size
            end = np.minimum(begin + size, where[1:][row])
            crc = [zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(begin.tolist(), end.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(row)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(piece * size),
                    pa.array(end - begin),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return rows.mapInArrow(encode, PIECES.replace("doc_id long", f"doc_id {kind}"))


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, longest items first into the fullest bin that takes them."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: dict[int, list[int]] = {}  # by room left
    rooms: list[int] = []
    count = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        at = bisect_left(rooms, length)
        if at < len(rooms):
            room = rooms[at]
            those = open_bins[room]
            b = those.pop()
            if not those:
                del open_bins[room], rooms[at]
        else:
            b, room = count, size
            count += 1
        bins[i], offsets[i] = b, size - room
        left = room - length
        if left:
            if left not in open_bins:
                open_bins[left] = []
                insort(rooms, left)
            open_bins[left].append(b)
    return bins, offsets


def pack_round(items: DataFrame, size: int, number: int) -> DataFrame:
    """Pack the items of each group; adds bin and offset. A bin's number tells round, group and count."""

    def pack(group: pa.Table) -> pa.Table:
        lengths = group.column("length").to_numpy()
        bins, offsets = best_fit(lengths, size)
        base = (number << 56) + (group.column("group")[0].as_py() << 28)
        return group.append_column("bin", pa.array(bins + base)).append_column("offset", pa.array(offsets))

    schema = ", ".join(f"{n} {t}" for n, t in items.dtypes)
    return items.groupBy("group").applyInArrow(pack, f"{schema}, bin long, offset long")


def pack_sequences(
    pieces: DataFrame,
    size: int,
    slack: int = SLACK,
    items_per_task: int = ITEMS_PER_TASK,
) -> DataFrame:
    """``pieces`` (any columns besides length) with sequence_id and offset in the sequence."""
    rows = pieces.count()
    groups = max(1, -(-rows // items_per_task))
    # rows are dealt out in turn, so equal rows and keys that repeat are spread evenly
    dealt = pieces.repartition(groups).withColumn("group", F.spark_partition_id().cast("long"))
    packed = written(pack_round(dealt, size, 0).drop("group"), "packed")
    number, maps = 0, []
    latest = packed
    while True:
        bins = latest.groupBy("bin").agg(F.sum("length").alias("length"))
        under = written(bins.where(F.col("length") < size - slack), "underfull")
        count = under.count()
        if number and (groups == 1 or count > (1 - LEAST_GAIN) * before) or count < 2:
            break
        if groups == 1:
            break
        before, number = count, number + 1
        merged = max(1, min(groups - 1, -(-count // items_per_task)))
        fan = -(-groups // merged)
        child = F.shiftright(F.col("bin"), 28).bitwiseAND((1 << 28) - 1)
        groups = -(-groups // fan)
        items = under.select(
            F.col("bin").alias("item"), "length", F.floor(child / fan).cast("long").alias("group")
        )
        latest = written(pack_round(items, size, number).drop("group"), "merged")
        maps.append(latest)
    out = packed
    for step in maps:
        up = step.select(F.col("item").alias("bin"), F.col("bin").alias("_up"), F.col("offset").alias("_shift"))
        out = out.join(up, "bin", "left").select(
            *[c for c in out.columns if c not in ("bin", "offset")],
            F.coalesce("_up", "bin").alias("bin"),
            (F.col("offset") + F.coalesce("_shift", F.lit(0))).alias("offset"),
        )
    return out.withColumnRenamed("bin", "sequence_id")
