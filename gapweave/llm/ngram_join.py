"""Near-duplicate join of documents on word n-grams with count-vector R-trees.

A document's set holds the hashes of its ``GRAM``-word shingles. Two documents link when
100 * overlap >= 80 * union. The join finds the components of the links:

1. Equal sets are found by an aggregated digest; the smallest document stands for them.
2. Tokens are hashed into groups, about three to a group. Sets that link differ in so few tokens that they
   agree on the whole content of some group; more exactly, if a set of n tokens can differ from a
   partner in at most D tokens, then the D + 1 smallest content hashes of both have one in common.
   These are the shards of the index: every pair that links meets in one.
3. Shards with the same members are searched once. Members are points, the counts of their tokens by
   group, in an R-tree (``count_tree``); the summed coordinate minima bound the overlap. What comes out
   is a forest that joins all points which the bounds let be similar: its components are the clusters.
4. No link leaves a cluster. There, the points are searched again in an R-tree with longer vectors,
   surviving pairs of different components are verified on the sets themselves, the best bound first, and those that link join
   their components. Pairs inside a component can't change it, so a large group of near copies
   costs about one verification a member, and no link between components is lost.
5. If the numbers of links are asked for, all pairs of different sets that an R-tree of the cluster lets through are verified.

Skew: copies take part once; a shard holds a document once, and of the many shards of each document;
large shards and clusters are searched in blocks, block against block. Both searches give fewer links than points. Names are 64-bit
hashes of words and shingles; verification counts equal ones.

Defined cases: no words (or null) is an empty set, linked with nothing; fewer words than GRAM are one
shingle; null ids count as smaller than all and as one document; rows that repeat an id are one
document with several texts: it links with what any of them links with, and its rows share a component; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.llm.components import components
from gapweave.llm.count_tree import connect, link_counts, needed
from gapweave.llm.shared import on_workers, shuffle_partitions, written
from gapweave.llm.words import Words, gram_hashes, gram_places, mix, multipliers, slices

GRAM = 5
LEAST = 4  # smaller sets only link with equal ones
BLOCK = 2048
CLUSTER_BLOCK = 2048
TOKENS_PER_GROUP = 3
MOST_COUNTERS = 4096
BROADCAST_IDS = 1_000_000
NULL_ID = -(1 << 63)
KEY_BYTES = 6
DIGEST = ["n", "d1", "d2"]


# -- sets ---------------------------------------------------------------------------------


def by_row(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Indices that sort by row, then by value."""
    order = np.argsort(values)
    key = rows[order]
    return order[np.argsort(key.astype(np.uint16) if len(key) and key.max() < 1 << 16 else key, kind="stable")]


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all rows, sorted by row and hash: (row, hash)."""
    words = Words(column, lower=True)
    hashes = words.hashes()
    places = gram_places(words.row_start, GRAM)
    rows = np.searchsorted(words.row_start, places, "right") - 1
    values = gram_hashes(hashes, GRAM)[places]
    short = np.flatnonzero((words.counts > 0) & (words.counts < GRAM))
    if len(short):
        owner = np.repeat(short, words.counts[short])
        at = np.concatenate([np.arange(words.row_start[r], words.row_start[r + 1]) for r in short])
        step = at - words.row_start[owner]
        parts = hashes[at] * multipliers(GRAM, 3)[step]
        first = np.cumsum(words.counts[short]) - words.counts[short]
        whole = mix(np.add.reduceat(parts, first) + words.counts[short].astype(np.uint64))
        rows, values = np.concatenate([rows, short]), np.concatenate([values, whole])
    order = by_row(rows, values)
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[new], values[new]


def row_sums(rows: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Sums of values by row, rows ascending."""
    out = np.zeros(count, np.uint64)
    first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else np.zeros(0, np.int64)
    if len(rows):
        out[rows[first]] = np.add.reduceat(values, first)
    return out


# -- shards -------------------------------------------------------------------------------


def level_of(n: np.ndarray) -> np.ndarray:
    """Level j for sizes from LEAST * 2^j up to twice that."""
    return np.floor(np.log2(np.maximum(n, LEAST) / LEAST) + 1e-12).astype(np.int64)


def most_different(n: np.ndarray) -> np.ndarray:
    """How many tokens a set of n and a set that it links with can differ in, at most."""
    total = n + 5 * n // 4
    tried = [total - k - 2 * needed(total - k) for k in range(9)]
    return np.maximum.reduce(tried)


def ranks(rows: np.ndarray) -> np.ndarray:
    """Place of each element within its row; rows ascending."""
    first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    return np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))


def shard_keys(rows: np.ndarray, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the shards of each set; sets of fewer than LEAST tokens have none."""
    level = level_of(sizes)
    most = most_different(sizes)
    out_rows, out_keys = [], []
    usable = sizes >= LEAST
    # a set is also a point of the next level if a partner can be that large
    reaches = usable & (5 * sizes // 4 >= LEAST << (level + 1))
    for up, which in ((0, usable), (1, reaches)):
        pick = which[rows]
        r, t = rows[pick], tokens[pick]
        if not len(r):
            continue
        groups = (2 * LEAST << (level + up)) // TOKENS_PER_GROUP + 1
        group = ((t >> np.uint64(32)) * groups[r].astype(np.uint64)) >> np.uint64(32)
        cell = (r.astype(np.uint64) << np.uint64(32)) | group
        order = np.argsort(cell)
        cell, t = cell[order], mix(t[order])
        first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        content = np.add.reduceat(t, first)
        r = (cell[first] >> np.uint64(32)).astype(np.int64)
        spot = (cell[first] & np.uint64(0xFFFFFFFF)) + ((level[r] + up).astype(np.uint64) << np.uint64(32))
        keys = mix(content * multipliers(1, 17)[0] + mix(spot))
        order = by_row(r, keys)
        r, keys = r[order], keys[order]
        filled = np.bincount(r, minlength=len(sizes))
        few = filled <= most
        take = (ranks(r) <= most[r]) | few[r]
        out_rows.append(r[take])
        out_keys.append(keys[take])
        pick = (which & few)[rows]
        if pick.any():  # too few groups for the guarantee: single tokens as well
            r = rows[pick]
            keys = mix(tokens[pick] ^ multipliers(1, 19)[0])
            order = by_row(r, keys)
            take = ranks(r[order]) <= most[r[order]]
            out_rows.append(r[order][take])
            out_keys.append(keys[order][take])
    if not out_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(out_rows), np.concatenate(out_keys)


def counters_of(sizes: np.ndarray) -> np.ndarray:
    """Length of the count vector, a power of two."""
    return np.clip(2 << level_of(sizes), 16, MOST_COUNTERS)


def count_vectors(rows: np.ndarray, tokens: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Count vectors: bytes of a counter, then the counters, little-endian."""
    length = counters_of(sizes)
    begin = np.cumsum(length) - length
    cell = begin[rows] + (tokens & (length[rows] - 1).astype(np.uint64)).astype(np.int64)
    counts = np.bincount(cell, minlength=int(length.sum()))
    most = np.maximum.reduceat(counts, begin) if len(begin) else counts
    out = []
    for b, n, m in zip(begin.tolist(), length.tolist(), most.tolist(), strict=True):
        width = 1 if m < 1 << 8 else 4
        out.append(bytes([width]) + counts[b : b + n].astype(f"<u{width}").tobytes())
    return out


def packed(keys: np.ndarray) -> np.ndarray:
    """KEY_BYTES low bytes of each key; equal shorter keys only cost a needless comparison."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]


def point_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        rows, tokens = shingle_sets(part.column("text"))
        n = part.num_rows
        sizes = np.bincount(rows, minlength=n)
        d1 = row_sums(rows, mix(tokens), n)
        d2 = row_sums(rows, mix(tokens * multipliers(1, 23)[0]), n)
        r, keys = shard_keys(rows, tokens, sizes)
        order = np.argsort(r, kind="stable")
        raw = packed(keys[order]).tobytes()
        ends = np.cumsum(np.bincount(r, minlength=n)) * KEY_BYTES
        begins = np.append(0, ends[:-1])
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc"),
                pa.array(sizes.astype(np.int64)),
                pa.array(d1.view(np.int64)),
                pa.array(d2.view(np.int64)),
                pa.array([raw[b:e] for b, e in zip(begins, ends, strict=True)], pa.binary()),
                pa.array(count_vectors(rows, tokens, sizes), pa.binary()),
            ],
            ["doc", "n", "d1", "d2", "keys", "vector"],
        )


def key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "keys"):
        raw = part.column("keys").to_pylist()
        counts = np.array([len(x) // KEY_BYTES for x in raw], np.int64)
        wide = np.zeros((int(counts.sum()), 8), np.uint8)
        wide[:, :KEY_BYTES] = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, KEY_BYTES)
        docs = np.repeat(part.column("doc").to_numpy(), counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(wide.view("<i8").ravel()), pa.array(docs)], ["key", "doc"]
        )


def member_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, doc), sorted, to (list, block, doc) of the keys with several members; equal lists get one name."""
    rest_keys, rest_docs = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def lists(keys: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        size = np.diff(np.append(first, len(keys)))
        name = mix(np.add.reduceat(mix(docs.view(np.uint64)), first) + size.astype(np.uint64))
        _, pick = np.unique(name, return_index=True)
        pick = pick[size[pick] > 1]
        size, name, first = size[pick], name[pick], first[pick]
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(name, size).view(np.int64)),
                pa.array(place // BLOCK),
                pa.array(docs[np.repeat(first, size) + place]),
            ],
            ["list", "block", "doc"],
        )

    for batch in batches:
        keys = np.concatenate([rest_keys, batch.column("key").to_numpy()])
        docs = np.concatenate([rest_docs, batch.column("doc").to_numpy()])
        if not len(keys):
            continue
        cut = int(np.searchsorted(keys, keys[-1]))  # keys ascend; the last may go on
        rest_keys, rest_docs = keys[cut:], docs[cut:]
        if cut:
            yield lists(keys[:cut], docs[:cut])
    if len(rest_keys):
        yield lists(rest_keys, rest_docs)


# -- search -------------------------------------------------------------------------------


def as_matrix(raw: list[bytes]) -> np.ndarray:
    """Count vectors as a matrix; longer ones are folded to the shortest."""
    vectors = [np.frombuffer(x, f"<u{x[0]}", offset=1) for x in raw]
    width = min(map(len, vectors))
    return np.stack([v.reshape(-1, width).sum(0, dtype=np.uint32) if len(v) > width else v for v in vectors])


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each combination of ``keys``, by which the rows are sorted."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        values = [table.column(k).to_numpy() for k in keys]
        new = np.zeros(table.num_rows - 1, bool)
        for v in values:
            new |= v[1:] != v[:-1]
        cuts = np.flatnonzero(new) + 1
        for b, e in zip([0, *cuts[:-1]], cuts, strict=False):
            yield table.slice(b, e - b)
        rest = table.slice(int(cuts[-1])) if len(cuts) else table
    if rest is not None:
        yield rest


def link_batches(links: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """(u, v) in batches of a few thousand."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    count = 0
    for pair in links:
        held.append(pair)
        count += len(pair[0])
        if count > 1 << 14:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held, strict=True)], ["u", "v"])
            held, count = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held, strict=True)], ["u", "v"])


def shard_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each shard: links that join all points whose bounds let them be similar."""

    def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for run in runs(batches, ["list", "block"]):
            if run.num_rows > 1:
                docs, sizes = run.column("doc").to_numpy(), run.column("n").to_numpy()
                _, links = connect(as_matrix(run.column("vector").to_pylist()), sizes)
                if links:
                    a, b = np.array(links).T
                    yield docs[a], docs[b]

    yield from link_batches(found())


def set_rows_of_cluster(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        rows, tokens = shingle_sets(part.column("text"))
        ends = np.cumsum(np.bincount(rows, minlength=part.num_rows)) * 8
        begins = np.append(0, ends[:-1])
        raw = tokens.tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                *(part.column(c) for c in ("doc", "cluster", "block", "last")),
                pa.array([raw[b:e] for b, e in zip(begins, ends, strict=True)], pa.binary()),
            ],
            ["doc", "cluster", "block", "last", "tokens"],
        )


def vectors_of(sets: list[np.ndarray]) -> np.ndarray:
    """Count vectors of the sets of a cluster, long enough for the largest."""
    width = min(MOST_COUNTERS, 1 << int(4 * max(map(len, sets)) - 1).bit_length())
    mask = np.uint64(width - 1)
    vectors = np.stack([np.bincount((x & mask).astype(np.int64), minlength=width) for x in sets])
    return vectors.astype(np.uint8 if vectors.max() < 256 else np.uint32)


def cluster_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each cluster, or pair of its blocks: verified links that join all points that link."""

    def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for run in runs(batches, ["cluster", "pair"]):
            if run.num_rows < 2:
                continue
            docs, blocks = run.column("doc").to_numpy(), run.column("block").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in run.column("tokens").to_pylist()]
            sizes = np.array(list(map(len, sets)))

            def accept(a: int, b: int) -> bool:
                both = np.concatenate([sets[a], sets[b]])
                both.sort()
                overlap = int((both[1:] == both[:-1]).sum())
                return 100 * overlap >= 80 * (len(both) - overlap)

            _, links = connect(vectors_of(sets), sizes, accept, blocks if blocks.min() != blocks.max() else None)
            if links:
                a, b = np.array(links).T
                yield docs[a], docs[b]

    yield from link_batches(found())


def class_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of clustered rows with their digests, as in ``point_rows``."""
    for part in slices(batches, "text"):
        rows, tokens = shingle_sets(part.column("text"))
        n = part.num_rows
        sizes = np.bincount(rows, minlength=n)
        ends = np.cumsum(sizes) * 8
        raw = tokens.tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc"),
                part.column("cluster"),
                pa.array(sizes.astype(np.int64)),
                pa.array(row_sums(rows, mix(tokens), n).view(np.int64)),
                pa.array(row_sums(rows, mix(tokens * multipliers(1, 23)[0]), n).view(np.int64)),
                pa.array([raw[b:e] for b, e in zip(np.append(0, ends[:-1]), ends, strict=True)], pa.binary()),
            ],
            ["doc", "cluster", "n", "d1", "d2", "tokens"],
        )


def counted_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each cluster, or pair of its blocks: with how many others each set links."""
    for run in runs(batches, ["cluster", "pair"]):
        blocks = run.column("block").to_numpy()
        across = int(run.column("pair")[0].as_py()) % (1 << 31) != int(run.column("pair")[0].as_py()) >> 31
        if run.num_rows < 2 or (across and blocks.min() == blocks.max()):
            continue
        sets = [np.frombuffer(x, np.uint64) for x in run.column("tokens").to_pylist()]
        counts = link_counts(vectors_of(sets), sets, blocks if across else None)
        columns = [run.column(c).combine_chunks() for c in DIGEST]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(counts)], [*DIGEST, "links"])


def few(ids: DataFrame, stored: DataFrame) -> DataFrame:
    """``ids`` to be broadcast if ``stored``, a written table with as many rows, is counted and found small; else left to Spark."""
    return F.broadcast(ids) if stored.count() <= BROADCAST_IDS else ids


def clusters(coarse: DataFrame) -> DataFrame:
    """(doc, cluster) of all documents that ``coarse`` joins with others."""
    inner = components(coarse)
    heads = inner.select(F.col("component").alias("node"), "component").distinct()
    return written(inner.unionAll(heads).select(F.col("node").alias("doc"), F.col("component").alias("cluster")), "clusters")


def block_pairs(rows: DataFrame, last: str) -> DataFrame:
    """Each row once for every pair of blocks of its group that its block is in; ``pair`` names the two."""
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col(last))).alias("other")
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return rows.select("*", other).withColumn("pair", low * F.lit(1 << 31) + high).drop("other", last)


def block_links(lists: DataFrame, listed: DataFrame, blocks: DataFrame, spark: SparkSession) -> DataFrame:
    """Links of the shards of several blocks, block against block."""
    paired = block_pairs(lists.join(blocks, "list"), "last").where("pair % 2147483648 <> pair div 2147483648")
    return (
        paired.drop("block")
        .withColumnRenamed("pair", "block")
        .join(listed, "doc")
        .repartition(shuffle_partitions(spark), "list", "block")
        .sortWithinPartitions("list", "block")
        .mapInArrow(shard_links, "u long, v long")
    )


def all_link_counts(rows: DataFrame, found: DataFrame, classes: DataFrame, spark: SparkSession) -> DataFrame:
    """(digest, n_links) of all sets that link with others: every pair of different sets of a cluster is searched.

    Sets, one for each class of equal ones, are dealt to blocks by their digests, and counts of pairs of blocks
    are summed: pairs themselves never leave a task.
    """
    # different sets of one id alone may link too
    alone = classes.groupBy("rep").count().where("count > 1").select(F.col("rep").alias("doc"))
    alone = alone.join(found, "doc", "left_anti").select("doc", F.col("doc").alias("cluster"))
    cluster = written(found.unionAll(alone), "counted")
    sets = rows.join(few(cluster, cluster), "doc").mapInArrow(
        class_rows, "doc long, cluster long, n long, d1 long, d2 long, tokens binary"
    )
    own = classes.withColumnRenamed("rep", "doc")
    sizes = own.join(cluster, "doc").groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / CLUSTER_BLOCK).alias("blocks"))
    sets = sets.where("n > 0").join(own, ["doc", *DIGEST], "left_semi").dropDuplicates(["doc", *DIGEST])
    placed = sets.join(sizes, "cluster").select(
        "cluster",
        *DIGEST,
        "tokens",
        F.pmod(F.xxhash64("d1", "d2"), F.col("blocks")).alias("block"),
        (F.col("blocks") - 1).alias("last"),
    )
    return (
        block_pairs(placed, "last")
        .repartition(shuffle_partitions(spark), "cluster", "pair")
        .sortWithinPartitions("cluster", "pair")
        .mapInArrow(counted_links, "n long, d1 long, d2 long, links long")
        .groupBy(*DIGEST)
        .agg(F.sum("links").alias("n_links"))
    )


def verified_links(rows: DataFrame, cluster: DataFrame, spark: SparkSession) -> DataFrame:
    """Links (u, v), verified on the sets, that join all documents of each of the ``clusters`` that link.

    Clusters are the components of what the bounds let through, so no link leaves one; a document's
    set is moved once for each block of its cluster.
    """
    sizes = cluster.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / CLUSTER_BLOCK).alias("blocks"))
    placed = cluster.join(sizes, "cluster").select(
        "doc", "cluster", F.pmod(F.xxhash64("doc"), F.col("blocks")).alias("block"), (F.col("blocks") - 1).alias("last")
    )
    sets = rows.join(few(placed, cluster), "doc").mapInArrow(
        set_rows_of_cluster, "doc long, cluster long, block long, last long, tokens binary"
    )
    return (
        block_pairs(sets, "last")
        .repartition(shuffle_partitions(spark), "cluster", "pair")
        .sortWithinPartitions("cluster", "pair")
        .mapInArrow(cluster_links, "u long, v long")
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", links: bool = False) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest id reachable by links).

    With ``links`` also n_links, with how many other sets the row's set links; equal sets, of whatever id,
    count as one. All pairs that the R-trees of a cluster let through are verified then, so a group of
    n near copies costs in proportion to its n * n pairs, spread over the pairs of its blocks.
    """
    on_workers(docs.sparkSession)
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(NULL_ID)).alias("doc"), F.col(text).alias("text")
    )
    every = written(
        rows.mapInArrow(point_rows, "doc long, n long, d1 long, d2 long, keys binary, vector binary"), "points"
    )
    digest = DIGEST
    classes = written(every.where("n > 0").groupBy(*digest).agg(F.min("doc").alias("rep")), "classes")
    owners = every.select("doc", *digest).join(classes, digest, "left").withColumn("rep", F.coalesce("rep", "doc"))
    points = every.join(classes.withColumnRenamed("rep", "doc"), ["doc", *digest], "left_semi").dropDuplicates(
        ["doc", *digest]
    )
    several = owners.groupBy("doc").agg(F.min("rep").alias("u"), F.max("rep").alias("v")).where("u <> v").drop("doc")
    lists = written(
        points.select("doc", "keys")
        .mapInArrow(key_rows, "key long, doc long")
        .repartition(shuffle_partitions(spark), "key")
        .sortWithinPartitions("key", "doc")
        .mapInArrow(member_lists, "list long, block long, doc long")
        .distinct(),
        "lists",
    )
    members = written(lists.select("doc").distinct(), "listed")
    listed = points.select("doc", "n", "vector").join(few(members, members), "doc")
    coarse = (
        lists.join(listed, "doc")
        .repartition(shuffle_partitions(spark), "list", "block")
        .sortWithinPartitions("list", "block")
        .mapInArrow(shard_links, "u long, v long")
    )
    blocks = lists.where("block > 0").groupBy("list").agg(F.max("block").alias("last"))
    if not blocks.isEmpty():
        coarse = coarse.unionAll(block_links(lists, listed, blocks, spark))
    found = clusters(written(coarse, "bounds"))
    comps = components(several.select("u", "v").unionAll(verified_links(rows, found, spark)))
    out = owners.join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    back = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    more = []
    if links:
        out = out.join(written(all_link_counts(rows, found, classes, spark), "links"), DIGEST, "left")
        more = [F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")]
    return out.withColumn("component_id", F.coalesce("component", "rep")).select(
        back("doc").alias("doc_id"), F.col("n").alias("n_shingles"), back("component_id").alias("component_id"), *more
    )
