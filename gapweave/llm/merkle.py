"""Merkle manifest of a table by nested rollup of rank digits.

Every row is a leaf. Leaves of a group (a source) are ranked by key, and the ranks' digits to the
base ``FAN`` are columns. Within a block of ``FAN ** DEPTH`` consecutive ranks, grouping away one
digit after the other nests up to ``FAN`` child structs into their parent, with its digest; one
shuffle by block serves all levels. The roots of the blocks are the nodes of the next tier, which
is nested the same way, until a group is one block. The groups' roots form a tree of the same kind.

Proofs come back down: a block's struct is unfolded level by level, ``transform`` giving each child
the digests on its left and right and ``explode`` its row. Inside a block there is no join; the path
above a block is attached to the block as a whole, one row for ``FAN ** DEPTH`` leaves.

A digest H is the lower-case hex SHA-256 of its inputs put together. While a level has several
nodes, every ``FAN`` consecutive ones, the last run being shorter or a single node, become their H;
a level of one node is the root.

Skew: ranks come from ranges (see ``places``), so a group of any size spreads over all tasks; a block
holds a bounded number of digests and no text.

Defined cases: null fields count as ``-``; a null group is a group, the first; a null key comes first
in its group; rows that repeat a key stand in the order of their digests, equal rows are leaves each; a
very long text is hashed where it is read and not moved; an empty table gives no rows; further
columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapweave.llm.places import running_totals
from gapweave.llm.shared import written

FAN = 3
DEPTH = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(fields: list[Column]) -> Column:
    """H of the fields, each as ``-`` or as its length in bytes, a colon and the value."""
    parts = [f.cast("string") for f in fields]
    framed = [F.coalesce(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return digest(F.concat(*framed))


def joined_digests(digests: Column) -> Column:
    return F.array_join(digests, "")


def nested(nodes: DataFrame) -> DataFrame:
    """(grp, total, block, digest, kids) of nodes (grp, place, total, digest, below)."""
    digits = [f"d{i}" for i in range(DEPTH)]
    rows = nodes.select(
        "grp",
        "total",
        F.expr(f"place div {FAN**DEPTH}").alias("block"),
        *[F.expr(f"CAST(place div {FAN**i} % {FAN} AS TINYINT)").alias(d) for i, d in enumerate(digits)],
        "digest",
        "below",
    ).repartition("grp", "block")
    for level, d in enumerate(digits):
        node = F.struct(F.col(d).alias("digit"), "digest", "below")
        rows = rows.groupBy("grp", "total", "block", *digits[level + 1 :]).agg(
            F.sort_array(F.collect_list(node)).alias("below")
        )
        # a level of one node is handed on as it is
        own = F.when(F.col("total") > FAN**level, digest(joined_digests(F.col("below.digest"))))
        rows = rows.withColumn("digest", F.coalesce(own, F.col("below")[0]["digest"]))
    return rows.withColumnRenamed("below", "kids")


def unfolded(blocks: DataFrame) -> DataFrame:
    """(grp, top, path, digest, below) of every node of ``nested`` blocks that carry ``top`` and ``path``."""
    rows = blocks.select("grp", "total", "top", "path", "kids")
    digests = F.col("kids.digest")
    for level in range(DEPTH - 1, -1, -1):
        kids = F.transform(
            "kids",
            lambda kid, i: F.struct(
                kid["digest"].alias("digest"),
                kid["below"].alias("below"),
                joined_digests(F.slice(digests, F.lit(1), i)).alias("left"),
                joined_digests(F.slice(digests, i + 2, F.lit(FAN))).alias("right"),
            ),
        )
        rows = rows.select("grp", "total", "top", "path", F.explode(kids).alias("kid"))
        step = F.concat(F.array(F.struct("kid.left", "kid.right")), F.col("path"))
        rows = rows.select(
            "grp",
            "total",
            "top",
            F.when(F.col("total") > FAN**level, step).otherwise(F.col("path")).alias("path"),
            F.col("kid.digest").alias("digest"),
            F.col("kid.below").alias("kids"),
        )
    return rows.withColumnRenamed("kids", "below").drop("total")


def tiers(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of nodes, blocks of their roots and so on; the last has one block a group."""
    most = nodes.agg(F.max("total")).first()[0] or 0
    found = [written(nested(nodes), "blocks")]
    while most > FAN**DEPTH:
        most = -(-most // FAN**DEPTH)
        roots = found[-1].select(
            "grp",
            F.col("block").alias("place"),
            F.expr(f"(total + {FAN**DEPTH - 1}) div {FAN**DEPTH}").alias("total"),
            "digest",
            F.col("block").alias("below"),
        )
        found.append(written(nested(roots), "blocks"))
    return found


def with_paths(found: list[DataFrame], tops: DataFrame) -> DataFrame:
    """All nodes of the first tier with ``top`` and ``path``, which ``tops`` gives for each group (grp, top, path)."""
    above = tops.select(F.col("grp").alias("_grp"), "top", "path", F.lit(0).cast("long").alias("_block"))
    nodes = None
    for blocks in reversed(found):
        if nodes is not None:
            above = written(
                nodes.select(F.col("grp").alias("_grp"), "top", "path", F.col("below").alias("_block")), "paths"
            )
        same = F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("block") == F.col("_block"))
        nodes = unfolded(blocks.join(above, same).drop("_grp", "_block"))
    return nodes


def manifest(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "source",
    fields: tuple[str, ...] = FIELDS,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per document: key, leaf, subroot (of its group), root, path, and the columns ``carry``.

    ``path`` lists (left, right), the digests beside the node on each level, from the leaf up to the root, each
    side put together; ``fold`` computes the root from it.
    """
    leaf = leaf_digest([F.col(f"`{c}`") for c in fields])
    carry = carry or {}
    rows = docs.select(
        F.col(f"`{group}`").alias("grp"),
        F.col(f"`{key}`").alias("id"),
        leaf.alias("digest"),
        F.struct(F.col(f"`{key}`").alias("key"), *[c.alias(n) for n, c in carry.items()]).alias("below"),
        F.lit(1).cast("long").alias("amount"),
    )
    ranked = running_totals(rows, ["id", "digest"], "leaves").withColumnRenamed("start", "place")
    in_group = tiers(ranked.select("grp", "place", "total", "digest", "below"))

    subroots = in_group[-1].select(
        F.lit(0).alias("grp"), F.col("grp").alias("id"), "digest", F.struct(F.col("grp").alias("key")).alias("below"),
        F.lit(1).cast("long").alias("amount"),
    )
    ranked = running_totals(subroots, ["id"], "subroots").withColumnRenamed("start", "place")
    of_groups = tiers(ranked.select("grp", "place", "total", "digest", "below"))

    no_path = F.array().cast("array<struct<left: string, right: string>>")
    root = of_groups[-1].select("grp", F.col("digest").alias("top"), no_path.alias("path"))
    groups = written(with_paths(of_groups, root), "groups")
    tops = groups.select(
        F.col("below.key").alias("grp"), F.struct(F.col("digest").alias("subroot"), F.col("top").alias("root")).alias("top"), "path"
    )
    return with_paths(in_group, tops).select(
        F.col("below.key").alias(key),
        F.col("digest").alias("leaf"),
        F.col("top.subroot").alias("subroot"),
        F.col("top.root").alias("root"),
        "path",
        *[F.col(f"below.{n}").alias(n) for n in carry],
    )


def siblings(path: Column) -> Column:
    """The digests beside the nodes of a path, put together from the leaf up."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the digests beside its path give."""
    return F.aggregate(path, leaf, lambda h, p: digest(F.concat(p["left"], h, p["right"])))
