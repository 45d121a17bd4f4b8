"""The query of the Merkle manifest and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.llm.merkle import FIELDS, fold, leaf_digest, manifest, siblings

#: levels that the SQL spells out: 3^13 documents of a source, 3^7 sources
LEVELS, SOURCE_LEVELS = 13, 7


def tampered_leaf():
    """The leaf without the line feeds of the text, where 2 divides the CRC-32 of the id."""
    fields = [F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in FIELDS]
    even = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    return F.when(even, leaf_digest(fields))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = manifest(docs, carry={"tampered": tampered_leaf()})
    folded = found.select(
        *("doc_id", "leaf", "subroot", "root"),
        F.sha2(siblings(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def tree_sql(name: str, levels: int) -> str:
    """Levels name0 (g, i, n, h) to name<levels> and, for each, the digests beside each node."""
    beside = "coalesce(string_agg(h, '' ORDER BY i) OVER (PARTITION BY g, i // 3 ORDER BY i ROWS BETWEEN {} ), '')"
    left, right = beside.format("UNBOUNDED PRECEDING AND 1 PRECEDING"), beside.format("1 FOLLOWING AND UNBOUNDED FOLLOWING")
    parts = []
    for k in range(levels):
        parts.append(
            f"{name}{k + 1} AS (SELECT g, i // 3 AS i, any_value(n) AS n, CASE WHEN any_value(n) > {3**k}"
            f" THEN sha256(string_agg(h, '' ORDER BY i)) ELSE min(h) END AS h FROM {name}{k} GROUP BY g, i // 3)"
        )
        parts.append(f"{name}_beside{k} AS (SELECT g, i, n, {left} AS l, {right} AS r FROM {name}{k})")
    return ",\n".join(parts)


def fold_sql(name: str, start: str, levels: int, tree: str) -> str:
    """name<levels>: rows of ``start`` (d, g, i, f, p), with the digest ``f`` folded up and the siblings ``p`` put together."""
    parts, before = [], start
    for k in range(levels):
        parts.append(
            f"{name}{k + 1} AS (SELECT d, x.g, x.i // 3 AS i, CASE WHEN n > {3**k} THEN sha256(l || f || r) ELSE f END AS f,"
            f" CASE WHEN n > {3**k} THEN p || l || r ELSE p END AS p"
            f" FROM {before} x JOIN {tree}_beside{k} b ON x.g = b.g AND x.i = b.i)"
        )
        before = f"{name}{k + 1}"
    return ",\n".join(parts)


def framed_sql(field: str) -> str:
    return f"coalesce(octet_length(encode(({field})::VARCHAR)) || ':' || ({field})::VARCHAR, '-')"


def leaf_sql(text: str) -> str:
    return f"sha256({' || '.join(framed_sql(text if c == 'text' else c) for c in FIELDS)})"


CRC_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)), 4294967295::BIGINT)"""

OP11_SQL = f"""WITH docs AS (
  SELECT doc_id AS d, {leaf_sql("text")} AS h, dense_rank() OVER (ORDER BY source NULLS FIRST) AS g,
         CASE WHEN {CRC_SQL} % 2 = 0 THEN {leaf_sql("replace(text, chr(10), '')")} ELSE {leaf_sql("text")} END AS f
  FROM documents),
a0 AS (SELECT d, g, f, h, row_number() OVER (PARTITION BY g ORDER BY d NULLS FIRST, h) - 1 AS i,
              count(*) OVER (PARTITION BY g) AS n FROM docs),
{tree_sql("a", LEVELS)},
b0 AS (SELECT 0 AS g, g - 1 AS i, count(*) OVER () AS n, h FROM a{LEVELS}),
{tree_sql("b", SOURCE_LEVELS)},
x0 AS (SELECT d, g, i, f, '' AS p FROM a0),
{fold_sql("x", "x0", LEVELS, "a")},
y0 AS (SELECT d, 0 AS g, g - 1 AS i, f, p FROM x{LEVELS}),
{fold_sql("y", "y0", SOURCE_LEVELS, "b")}
SELECT a0.d AS doc_id, a0.h AS leaf, s.h AS subroot, t.h AS root, sha256(y.p) AS proof_sha256,
       y.f AS folded_root, y.f = t.h AS verified
FROM a0 JOIN a{LEVELS} s ON a0.g = s.g CROSS JOIN b{SOURCE_LEVELS} t JOIN y{SOURCE_LEVELS} y ON a0.d = y.d"""
