"""The Merkle manifest against a plain tree over a small table of odd rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from gapweave.llm import merkle
from gapweave.llm.merkle import fold, manifest, siblings
from gapweave.llm.merkle_queries import tampered_leaf

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
ROWS = (
    [(i, "big", "en", 10 + i, f"text {i}\nmore") for i in range(800)]
    + [(None, "big", None, None, None), (None, "big", None, None, "no\nid"), (7, "big", "de", 1, "same id")]
    + [(9000, "big", "en", 3, "same\nrow")] * 5
    + [(2000 + i, "exact 243", "en", i, "x" * i) for i in range(243)]
    + [(3000 + i, "exact 244", "en", i, "") for i in range(244)]
    + [(1, "one", "ä", 5, "ñandú \U0001f600\n" * 3), (2, None, "en", 5, "null source"), (3, None, None, 0, "")]
    + [(4, "", "en", 5, "empty source"), (5, "two", "en", 1, "y" * 300_000), (6, "two", "", 1, "\n\n\n")]
    + [(5000 + i, f"s{i:03}", "en", 1, "many sources") for i in range(250)]
)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(digests):
    """The root and, per digest, the (left, right) beside it on each level."""
    paths, owners = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        up, up_owners = [], []
        for b in range(0, len(digests), 3):
            run = digests[b : b + 3]
            for i in range(len(run)):
                for owner in owners[b + i]:
                    paths[owner].append(("".join(run[:i]), "".join(run[i + 1 :])))
            up.append(h(*run))
            up_owners.append([o for x in owners[b : b + 3] for o in x])
        digests, owners = up, up_owners
    return digests[0] if digests else None, paths


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    within = {}
    for name in names:
        own = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        within[name] = (own, *tree([leaf(r) for r in own]))
    root, above = tree([within[n][1] for n in names])
    found = []
    for name, up in zip(names, above, strict=True):
        own, subroot, paths = within[name]
        for row, path in zip(own, paths, strict=True):
            path = path + up
            f = leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                f = leaf((*row[:4], None if row[4] is None else row[4].replace("\n", "")))
            for left, right in path:
                f = h(left, f, right)
            found.append((row[0], leaf(row), subroot, root, "".join(a + b for a, b in path), f))
    return found


def answer(docs):
    path, leaf, tampered = F.col("path"), F.col("leaf"), F.coalesce("tampered", "leaf")
    found = manifest(docs, carry={"tampered": tampered_leaf()})
    return found.select("doc_id", "leaf", "subroot", "root", siblings(path), fold(tampered, path)).collect()


@pytest.fixture(scope="module")
def found(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    names = ["id", "grp", "place", "total", "digest", "below", "start", "part", "before", "amount", "kids", "path", "top"]
    return answer(frame.withColumns({n: F.lit(f"other {n}") for n in names}))


def test_manifest_equals_plain_tree(found):
    want = brute(ROWS)
    assert len(want) == len(ROWS)
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))


def test_tampering_shows(found):
    """The folded root is the root unless line feeds went."""
    changed = {r[0] for r in ROWS if r[0] is not None and "\n" in (r[4] or "") and zlib.crc32(str(r[0]).encode()) % 2 == 0}
    assert len(changed) > 100
    assert {r[0] for r in found if r[5] != r[3]} == changed


@pytest.mark.parametrize("rows", [[], ROWS[:1], [(None, None, None, None, None)] * 4])
def test_small_tables(spark, rows):
    found = answer(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute(rows)))


def test_a_hot_source_spreads_over_blocks(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("grp"),
        F.col("id").alias("place"),
        F.lit(20_000).cast("long").alias("total"),
        F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("digest"),
        F.struct("id").alias("below"),
    )
    blocks = merkle.nested(rows.where("grp = 'hot'"))
    sizes = blocks.select(F.size("kids"), F.length(F.to_json("kids")).alias("chars")).agg(F.max("chars"), F.count("*")).first()
    assert sizes[1] > 50  # blocks of at most 243 ranks, whatever the group
    assert sizes[0] < 243 * 200
