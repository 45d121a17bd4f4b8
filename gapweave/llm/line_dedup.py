"""Line deduplication over levelled sorted runs of line hashes.

``LineRuns`` keeps what is known of lines: a run is a Parquet table, sorted by line hash, with a row for each line of a
batch: how many of the batch's documents hold it, and its keeper, the document that may keep it. Batches are added from the
largest document ids to the smallest. A new batch's lines are merge-anti-joined with the runs: what no run holds is new,
and the largest document of the batch that holds it is its keeper; a line that a run holds has its keeper there, and
only adds a count. So a line has one keeper in all runs, and the anti-joins decide which it is. The batch becomes a run
at level 0; once ``fanout`` runs stand at a level, they are compacted into one run of the next level. ``totals`` compacts
what stands. Batches may be added over time, each document once.

Batches are cut at quantiles of the ids; ids that aren't numbers, or are all one, come as one batch.

The key of a line is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z in lower case. It is held as two 64-bit
hashes with different seeds. A key of at least ``min_chars`` code points found in at least
``min_docs`` documents loses its lines except in the largest document id that holds it.

Skew: equal lines of one document count once before anything is moved; hashes are counted by
partial aggregation; the join that finds which documents lose a line is an ordinary join, whose
large partitions Spark splits.

Defined cases: a null or empty text is one empty line; a null id is one document, smaller than
all; rows that repeat an id are one document for counting and cleaned row by row; further columns
are kept, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapweave.llm.shared import written
from gapweave.session import scratch_path

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
CUT_ACCURACY = 1000
FANOUT = 3
HASHES = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def line_hash(line: Column, min_chars: int) -> Column:
    """Both hashes of a line's key; null if the key is short."""
    key = line_key(line)
    pair = F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))
    return F.when(F.length(key) >= min_chars, pair)


def line_rows(docs: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """(doc, h1, h2) of the long lines, each once in a row."""
    hashes = F.array_distinct(F.array_compact(F.transform(lines_of(F.col(text)), lambda x: line_hash(x, min_chars))))
    return docs.select(F.col(key).alias("doc"), F.explode(hashes).alias("h")).select("doc", "h.h1", "h.h2")


class LineRuns:
    """Levelled sorted runs in the shared folder: (h1, h2, n_docs, found, keeper).

    Of all rows of a line, just one is ``found``, and only it has a keeper.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.path = scratch_path(spark, "runs")
        self.levels: list[list[DataFrame]] = []
        self.written = 0

    def store(self, rows: DataFrame, level: int) -> None:
        """Write a sorted run; a full level moves up as one run."""
        while len(self.levels) <= level:
            self.levels.append([])
        path = f"{self.path}/level-{level}-run-{self.written}"
        self.written += 1
        rows.sortWithinPartitions(*HASHES).write.parquet(path)
        self.levels[level].append(self.spark.read.schema(rows.schema).parquet(path))
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self.store(compacted(full), level + 1)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> None:
        """Add a batch of (doc, h1, h2), whose documents are all smaller than those of earlier batches."""
        own = lines.distinct().groupBy(*HASHES).agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("keeper"))
        runs = self.runs()
        if runs:
            held = union(runs).where("found").select(*HASHES)
            new = own.join(held, HASHES, "left_anti").withColumn("found", F.lit(True))
            more = own.join(held, HASHES, "left_semi").withColumns(
                {"found": F.lit(False), "keeper": F.lit(None).cast(own.schema["keeper"].dataType)}
            )
            own = new.unionByName(more)
        else:
            own = own.withColumn("found", F.lit(True))
        self.store(own, 0)

    def totals(self) -> DataFrame:
        runs = self.runs()
        return compacted(runs) if runs else None


def union(runs: list[DataFrame]) -> DataFrame:
    whole = runs[0]
    for run in runs[1:]:
        whole = whole.unionByName(run)
    return whole


def compacted(runs: list[DataFrame]) -> DataFrame:
    """One row a line. Nothing is compared: there is one keeper at most (a null id's is null)."""
    return union(runs).groupBy(*HASHES).agg(
        F.sum("n_docs").alias("n_docs"), F.any_value("keeper", ignoreNulls=True).alias("keeper"), F.bool_or("found").alias("found")
    )


def batch_of(lines: DataFrame, batches: int) -> Column:
    """The number of a document's batch: 0 has the largest ids, the last one also the null id."""
    if batches < 2 or not isinstance(lines.schema["doc"].dataType, T.NumericType):
        return F.lit(0)
    shares = [1 - i / batches for i in range(1, batches)]
    cuts = lines.agg(F.percentile_approx("doc", shares, CUT_ACCURACY)).first()[0] or []
    smaller = [F.when(F.col("doc") >= cut, 0).otherwise(1) for cut in cuts]
    return sum(smaller, F.lit(0))


def dedup_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """``docs`` with ``text`` cleaned, and two columns more: ``n_lines`` (before) and ``n_dropped``.

    If ``docs`` has columns of these names, they are replaced.
    """
    lines = written(line_rows(docs, key, text, min_chars), "lines")
    batch = batch_of(lines, batches)
    runs = LineRuns(docs.sparkSession, fanout)
    for number in range(batches):
        runs.add(lines.where(batch == number))
    # written, so that both sides of the join are plain shuffles, of which Spark splits large partitions
    common = written(runs.totals().where(F.col("n_docs") >= min_docs).select(*HASHES, "keeper"), "common")
    losing = (
        lines.join(common, HASHES)
        .where(~F.col("doc").eqNullSafe(F.col("keeper")))
        .groupBy("doc")
        .agg(F.collect_set(F.struct(*HASHES)).alias("_drops"))
        .withColumnRenamed("doc", "_drop_doc")
    )
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"))
    joined = packed.join(losing, F.col(f"_row.`{key}`").eqNullSafe(F.col("_drop_doc")), "left")
    lines_in = lines_of(F.col(f"_row.`{text}`"))
    kept = F.when(F.col("_drops").isNull(), lines_in).otherwise(
        F.filter(
            lines_in,
            lambda x: ~F.coalesce(F.array_contains("_drops", line_hash(x, min_chars)), F.lit(False)),
        )
    )
    cleaned = joined.select("_row", F.size(lines_in).alias("_n"), kept.alias("_kept"))
    return cleaned.select(
        *[
            (F.array_join("_kept", "\n") if c == text else F.col(f"_row.`{c}`")).alias(c)
            for c in own
        ],
        F.col("_n").cast("long").alias("n_lines"),
        (F.col("_n") - F.size("_kept")).cast("long").alias("n_dropped"),
    )
