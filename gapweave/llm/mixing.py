"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source is a stream of words: its documents in the order of a seeded hash, cut into blocks of
``block_words`` words. What the mix takes of a source is exact: every block once for each whole pass,
then blocks in a seeded permutation until the target is met, the last one cut. These draws,
numbered from 0, are the quotas of the root node of a tree. Each node splits its shards in halves and its draws
by a multivariate hypergeometric sample, so that every output shard gets its number of draws, of each source
as many as a random deal would give, and all draws are given out once. A shard's draws of a
source are consecutive numbers, hence disjoint blocks; the permutation says which blocks they are.
A shard is shuffled by itself.

A node's random numbers depend on the seed and its shards alone, a block's place on the seed, source and pass
alone: any run gives the same mix, on any machine.

Skew: word counts are summed along a source by ranges (see ``places``), so a source of any size spreads over all
tasks; documents meet draws by block, which holds at most ``block_words`` documents and two draws. Nodes are split in
Spark, 64 shards a pass. The sources themselves, names and sizes, are one row: what grows with
the data is not the number of sources. For tables of more than ``MOST_DRAWS`` blocks, blocks are longer.

Targets: the words of the mix (``share`` times all words) are shared by weight; a source's target stops at ``most``
times its words, and what is above is shared again among the others until none is above.

Defined cases: null and empty texts have no words and are never taken; a null source is a source, the last; rows
that repeat are documents each; ties in the hash are broken by the key, then by the words, then by the place in
the written table; a very long text is counted where it is read, and spans several blocks; an empty table gives
no rows; further columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapweave.llm.places import running_totals
from gapweave.llm.shared import on_workers, shuffle_partitions, written
from gapweave.llm.words import Words, mix, slices

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
BLOCK_WORDS = 4096
SHARD_BLOCKS = 1024
#: numpy draws hypergeometric samples from less than 10^9 items
MOST_DRAWS = 500_000_000
#: levels of the tree that a task splits a node by
SPLITS = 6

PLAN = (
    "src int, grp string, total long, target double, take long, blocks long, draws long, cut long, block_words long"
)
NODE = "low long, high long, src array<int>, first array<long>, many array<long>"
DRAW = "shard long, src int, pass long, block long, allowed long"
GOLDEN = 0x9E3779B97F4A7C15


def targets(sizes: list[int], weights: tuple[float, ...], share: float, most: float) -> list[float]:
    """Words to take of each source; weights are given in turn."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    found: list[float] = [0.0] * len(sizes)
    rest, open_ = share * sum(sizes), list(range(len(sizes)))
    while open_:
        each = rest / sum(weight[i] for i in open_)
        full = [i for i in open_ if weight[i] * each > most * sizes[i]]
        for i in full or open_:
            found[i] = most * sizes[i] if full else weight[i] * each
        if not full:
            break
        rest -= sum(found[i] for i in full)
        open_ = [i for i in open_ if weight[i] * each <= most * sizes[i]]
    return found


def rounds(left: np.ndarray, right: np.ndarray, half: np.ndarray, key: np.ndarray, order) -> np.ndarray:
    """Four Feistel rounds on numbers of two halves."""
    mask = (np.uint64(1) << half) - np.uint64(1)
    for i in order:
        salt = mix(key + np.uint64((i + 1) * GOLDEN % (1 << 64)))
        left, right = right, left ^ (mix(right + salt) & mask)
    return (right << half) | left if order[0] else (left << half) | right


def permuted(x: np.ndarray, n: np.ndarray, key: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Where a permutation of 0 .. n - 1 named by ``key`` puts x, or what it puts at x; all are arrays."""
    x, n, key = x.astype(np.uint64), n.astype(np.uint64), key.astype(np.uint64)
    bits = np.array([max(2, int(v - 1).bit_length()) if v else 2 for v in n.tolist()], np.uint64)
    half = (bits + np.uint64(1)) // np.uint64(2)
    y, todo = x.copy(), np.arange(len(x))
    while len(todo):  # a number beyond n is permuted again until it is inside
        h = half[todo]
        high, low = y[todo] >> h, y[todo] & ((np.uint64(1) << h) - np.uint64(1))
        if inverse:
            y[todo] = rounds(low, high, h, key[todo], (3, 2, 1, 0))
        else:
            y[todo] = rounds(high, low, h, key[todo], (0, 1, 2, 3))
        todo = todo[y[todo] >= n[todo]]
    return y.astype(np.int64)


def pass_key(seed: int, source: np.ndarray, number: np.ndarray) -> np.ndarray:
    base = np.uint64(seed * GOLDEN % (1 << 64))
    return mix(mix(source.astype(np.uint64) + base) + number.astype(np.uint64))


def last_draw(rest: int, total: int, blocks: int, block_words: int, short_at: int) -> tuple[int, int]:
    """How many blocks of a pass hold ``rest`` words and how many words of the last one are taken.

    All blocks have ``block_words`` words but the last one of the source, which comes at place ``short_at``.
    """
    short = total - (blocks - 1) * block_words
    if rest <= short_at * block_words:
        many = -(-rest // block_words)
        return many, rest - (many - 1) * block_words
    rest -= short_at * block_words
    if rest <= short:
        return short_at + 1, rest
    more = -(-(rest - short) // block_words)
    return short_at + 1 + more, rest - short - (more - 1) * block_words


def plan_rows(weights, share, most, block_words, seed):
    """The plan of all sources from one row that lists them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for listed in batch.column("sources").to_pylist():
                names, sizes = [s["grp"] for s in listed], [s["total"] for s in listed]
                words = max(block_words, -(-int(most * sum(sizes)) // MOST_DRAWS))
                rows = []
                for i, (name, size, target) in enumerate(zip(names, sizes, targets(sizes, weights, share, most), strict=True)):
                    take, blocks = int(target + 0.5), -(-size // words)
                    whole, rest = divmod(take, size) if size else (0, 0)
                    draws, cut = whole * blocks, words
                    if rest:
                        key = pass_key(seed, np.array([i]), np.array([whole]))
                        short_at = int(permuted(np.array([blocks - 1]), np.array([blocks]), key, inverse=True)[0])
                        many, cut = last_draw(rest, size, blocks, words, short_at)
                        draws += many
                    rows.append((i, name, size, target, take, blocks, draws, cut, words))
                columns = zip(*rows, strict=True) if rows else [()] * 9
                kinds = [pa.int32(), pa.string(), pa.int64(), pa.float64(), *[pa.int64()] * 5]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    [f.split()[0] for f in PLAN.split(", ")],
                )

    return run


def halves(node, draws: int, shards: int, seed: int):
    """The two halves of a node (low, high, src, first, many); shards hold as equal numbers of draws as can be."""
    low, high, src, first, many = node
    middle = (low + high) // 2
    sample = draws * middle // shards - draws * low // shards
    random = np.random.default_rng([seed, low, high])
    left = random.multivariate_hypergeometric(many, sample, method="marginals")
    for a, b, f, m in ((low, middle, first, left), (middle, high, first + left, many - left)):
        some = m > 0
        yield a, b, src[some], f[some], m[some]


def split_nodes(draws: int, shards: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes = [(row["low"], row["high"], *(np.array(row[c], np.int64) for c in ("src", "first", "many")))]
                for _ in range(SPLITS):
                    nodes = [
                        half
                        for node in nodes
                        for half in (halves(node, draws, shards, seed) if node[1] - node[0] > 1 else [node])
                    ]
                kinds = [pa.int64(), pa.int64(), *(pa.list_(k) for k in (pa.int32(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n[i].tolist() if i > 1 else n[i] for n in nodes], k) for i, k in enumerate(kinds)],
                    ["low", "high", "src", "first", "many"],
                )

    return run


def draw_rows(seed: int):
    """(shard, src, pass, block, allowed) of numbered draws: the block and how many of its words may be taken."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            src, number, blocks, draws, cut, words = (
                np.asarray(batch.column(c)) for c in ("src", "number", "blocks", "draws", "cut", "block_words")
            )
            passes = number // blocks
            block = permuted(number % blocks, blocks, pass_key(seed, src, passes))
            allowed = np.where(number == draws - 1, cut, words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("src"), pa.array(passes), pa.array(block), pa.array(allowed)],
                ["shard", "src", "pass", "block", "allowed"],
            )

    return run


def size_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        counts = pa.array(Words(part.column("text")).counts.astype(np.int64))
        yield pa.RecordBatch.from_arrays([part.column("grp"), part.column("id"), counts], ["grp", "id", "amount"])


class Mix:
    """A mix of the documents of all sources: its plan, the documents' places and the draws of all shards."""

    def __init__(
        self,
        docs: DataFrame,
        key: str = "doc_id",
        source: str = "source",
        text: str = "text",
        weights: tuple[float, ...] = WEIGHTS,
        share: float = SHARE,
        most: float = MOST,
        block_words: int = BLOCK_WORDS,
        shard_blocks: int = SHARD_BLOCKS,
        seed: int = 7,
    ):
        if share > most:
            raise ValueError("a mix can't take more of all sources than of each")
        self.seed = seed
        self.spark = docs.sparkSession
        on_workers(self.spark)
        sized = docs.select(
            F.col(f"`{source}`").cast("string").alias("grp"),
            F.col(f"`{key}`").cast("long").alias("id"),
            F.col(f"`{text}`").alias("text"),
        ).mapInArrow(size_rows, "grp string, id long, amount long")
        sized = sized.withColumn("hash", F.xxhash64(F.lit(seed), "id"))
        stream = running_totals(sized, ["hash", "id", "amount"], "sizes")
        listed = stream.groupBy("grp").agg(F.max("total").alias("total"))
        order = F.struct(F.col("grp").isNull().alias("last"), "grp", "total")
        one_row = listed.agg(F.sort_array(F.collect_list(order)).alias("sources"))
        plan = one_row.mapInArrow(plan_rows(weights, share, most, block_words, seed), PLAN)
        #: one row a source: its words, target, words to take, blocks, draws and the words of the last draw
        self.plan = written(plan, "plan")
        of_source = self.plan.withColumnsRenamed({"grp": "_grp", "total": "_total"})
        #: one row a document: key, words, the source's number, and where its words stand in the source
        self.documents = stream.join(of_source, F.col("grp").eqNullSafe(F.col("_grp"))).select(
            "id", F.col("amount").alias("size"), "src", "start", "total", "target", "block_words"
        )
        self.draws = self._draws(shard_blocks)

    def _draws(self, shard_blocks: int) -> DataFrame:
        """(shard, src, pass, block, allowed): the blocks that each shard draws."""
        total = self.plan.agg(F.sum("draws")).first()[0] or 0
        shards = max(1, -(-total // shard_blocks))
        quota = F.struct("src", F.col("draws").alias("many"))
        root = self.plan.where("draws > 0").agg(F.sort_array(F.collect_list(quota)).alias("q"))
        nodes = root.select(
            F.lit(0).cast("long").alias("low"),
            F.lit(shards).cast("long").alias("high"),
            F.col("q.src").alias("src"),
            F.transform("q", lambda q: F.lit(0).cast("long")).alias("first"),
            F.col("q.many").alias("many"),
        )
        for done in range(0, (shards - 1).bit_length(), SPLITS):
            if done:
                nodes = written(nodes, "nodes").repartition(shuffle_partitions(self.spark), "low")
            nodes = nodes.mapInArrow(split_nodes(total, shards, self.seed), NODE)
        quotas = nodes.select(F.col("low").alias("shard"), F.inline(F.arrays_zip("src", "first", "many")))
        numbers = quotas.select("shard", "src", F.explode(F.expr("sequence(first, first + many - 1)")).alias("number"))
        known = self.plan.select("src", "blocks", "draws", "cut", "block_words")
        return written(numbers.join(known, "src").mapInArrow(draw_rows(self.seed), DRAW), "draws")

    def pieces(self) -> DataFrame:
        """(shard, place, id, src, start, pass, first, words): spans of words in the order that a shard has them.

        ``first`` is the span's first word in its document, ``start`` the document's place in its source.
        """
        spread = self.documents.where("size > 0").select(
            "id", "src", "start", "size", "block_words",
            F.explode(F.expr("sequence(start div block_words, (start + size - 1) div block_words)")).alias("block"),
        )
        met = spread.join(self.draws, ["src", "block"]).selectExpr(
            *("shard", "id", "src", "start", "pass"),
            "greatest(0L, block * block_words - start) AS first",
            "least(start + size, block * block_words + allowed) - greatest(start, block * block_words) AS words",
        )
        shuffled = Window.partitionBy("shard").orderBy(
            F.xxhash64(F.lit(self.seed), "src", "start", "pass", "first"), "src", "start", "pass", "first"
        )
        taken = met.where("words > 0").withColumn("place", F.row_number().over(shuffled) - 1)
        return taken.select("shard", "place", "id", "src", "start", "pass", "first", "words")

    def taken(self) -> DataFrame:
        """(id, size, total, target, taken) of every document: the words that the mix takes, repeats counted."""
        summed = self.pieces().groupBy("src", "start").agg(F.sum("words").alias("words"))
        summed = summed.withColumnsRenamed({"src": "_src", "start": "_start"})
        # where a document has words, no other one stands at its place
        same = (F.col("src") == F.col("_src")) & (F.col("start") == F.col("_start")) & (F.col("size") > 0)
        return self.documents.join(summed, same, "left").select(
            "id", "size", "total", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken")
        )
