"""Benchmark decontamination by SimHash of item-sized windows, in DataFrame expressions only.

A document holds a benchmark item of w words if one of its windows of w words has a weighted
shingle similarity of ``SIMILARITY`` or more with it: the sum of the smaller over the sum of the
larger counts of each GRAM-word shingle (of the whole item, if it has fewer words). A document with fewer than w words has
one window, the whole document, compared by the same measure. Words are compared with A-Z in lower case.

1. A window that is similar enough misses at most a ninth of the item's shingles, so it holds at
   least one of a few anchors: words of the item, at least GRAM words apart, that together carry
   more shingles than may be missing. Of the choices, the anchors rarest in all documents are taken.
   A document shorter than the item may miss a fifth of them, so it has anchors of its own, which carry more.
2. Around each anchor found in a document, all windows of w words that also hold a word of the item's
   head and one of its tail (chosen by the same count) get a 64-bit SimHash of their shingles. A shorter
   document gets one of all its shingles.
3. Fingerprints meet in a multi-index: BLOCKS blocks, each probed with all values that differ in
   up to PROBE bits. Two fingerprints within RADIUS bits agree that far in some block, so none within
   the radius is missed. At similarity 0.8 a fingerprint lies outside it with a probability below 1e-7.
4. Candidates within the radius are verified by the exact similarity.

Tables made from the benchmark are broadcast after they have been counted; larger ones are joined
as Spark decides. Only hits are moved, never the words of all texts.

Defined cases: null or empty texts and items have no words and are never similar, nor are documents with fewer words than a shingle; null and
repeated document ids are kept as they are: a hit names the id; rows that repeat an item id are
items of their own, and the best hit is reported; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gapweave.llm.quality_rules import bound
from gapweave.llm.shared import written

GRAM = 5
SIMILARITY = 0.8
BLOCKS = 9
PROBE = 2
RADIUS = BLOCKS * (PROBE + 1) - 1
BROADCAST_ROWS = 500_000
WHOLE = -1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LANES = 32  # longs of a SimHash in the making, with two counters each


def few(df: DataFrame) -> DataFrame:
    """``df`` to be broadcast if it has been counted and found small; else left to Spark."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def raw_words(text: Column) -> Column:
    """Words as they stand; there may be an empty one at either end."""
    return F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1)


def lowered(word: Column) -> Column:
    """A-Z in lower case; in plain ASCII that is what the faster ``lower`` does."""
    plain = F.octet_length(word) == F.length(word)
    return F.when(plain, F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def lower_words(raw: Column) -> Column:
    return F.transform(F.array_remove(raw, ""), lowered)


def grams(words: Column, size: Column) -> Column:
    """Hashes of each ``size`` (at most GRAM) consecutive words; the list has at least one."""

    def hashed(h: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(h) - size)
        return F.transform(
            places,
            lambda i: F.xxhash64(*[F.when(F.lit(j) < size, F.get(h, i + j)) for j in range(GRAM)]),
        )

    return bound(F.transform(words, lambda w: F.xxhash64(w)), hashed)


def simhash(hashes: Column) -> Column:
    """Bit b is set if more than half of the hashes have it."""
    low = (1 << 32) + 1  # bits 0 and 32
    zero = F.struct(*[F.lit(0).cast("long").alias(f"c{k}") for k in range(LANES)])
    counts = F.aggregate(
        hashes,
        zero,
        lambda a, x: F.struct(
            *[(a[f"c{k}"] + F.shiftrightunsigned(x, k).bitwiseAND(low)).alias(f"c{k}") for k in range(LANES)]
        ),
    )

    def bits(c: Column) -> Column:
        n = F.size(hashes)
        out = F.lit(0).cast("long")
        for k in range(LANES):
            lane = c[f"c{k}"]
            few_low = F.when(lane.bitwiseAND((1 << 32) - 1) * 2 > n, F.lit(1 << k)).otherwise(F.lit(0))
            high_bit = (1 << (k + 32)) - (1 << 64 if k == 31 else 0)
            few_high = F.when(F.shiftrightunsigned(lane, 32) * 2 > n, F.lit(high_bit)).otherwise(F.lit(0))
            out = out.bitwiseOR(few_low.cast("long")).bitwiseOR(few_high.cast("long"))
        return out

    return bound(counts, bits)


def block_bits() -> list[tuple[int, int]]:
    """(shift, width) of the blocks, which share out 64 bits."""
    cuts = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def blocks_of(fingerprint: Column) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("block"),
                F.shiftrightunsigned(fingerprint, shift).bitwiseAND((1 << width) - 1).alias("value"),
            )
            for i, (shift, width) in enumerate(block_bits())
        ]
    )


def probes() -> Column:
    """What a block's value is changed by: all patterns of up to PROBE bits."""
    widest = max(width for _, width in block_bits())
    return F.array(*[F.lit(x).cast("long") for x in range(1 << widest) if x.bit_count() <= PROBE])


def item_table(items: DataFrame, key: str, text: str) -> DataFrame:
    rows = items.select(
        F.xxhash64(F.col(key), F.col(text)).alias("item"), F.col(key).alias("item_id"), lower_words(raw_words(F.col(text))).alias("words")
    )
    sized = rows.where(F.size("words") > 0).dropDuplicates(["item"]).withColumn("w", F.size("words"))
    sized = sized.withColumn("g", F.least(F.lit(GRAM), F.col("w"))).withColumn("m", F.col("w") - F.col("g") + 1)
    full = sized.withColumn("grams", grams(F.col("words"), F.col("g")))
    full = full.withColumn("plain", F.size(F.array_distinct("grams")) == F.col("m"))
    # words GRAM apart near the start and near the end that carry more shingles than may be missing
    some = F.sequence(F.lit(0), F.floor(F.floor(F.col("m") / 9) / F.col("g")).cast("int"))
    full = full.withColumns(
        {
            "head": F.transform(some, lambda i: F.get("words", F.col("g") - 1 + i * F.col("g"))),
            "tail": F.transform(some, lambda i: F.get("words", F.col("m") - 1 - i * F.col("g"))),
        }
    )
    return written(full.withColumn("fingerprint", simhash(F.col("grams"))), "items")


def least_words() -> Column:
    """Words of the shortest document that can be similar to an item: four fifths of its shingles."""
    return (F.ceil(F.col("m") * 4 / 5) + F.col("g") - 1).cast("int")


def anchor_table(items: DataFrame, texts: DataFrame) -> DataFrame:
    """(word, item, whole, least, most) of the anchors of each item and of the sizes of the documents they are sought in.

    ``whole`` ones are for documents shorter than the item, which may miss a fifth of its shingles and no more.
    """
    places = items.select("item", "w", "g", "m", F.posexplode("words").alias("place", "word"))
    known = few(places.select("word").distinct())
    spoken = texts.select(F.explode("raw").alias("raw")).select(lowered(F.col("raw")).alias("word"))
    counts = spoken.join(known, "word").groupBy("word").count()
    # shingles that hold the word at this place
    carried = F.least("place", F.col("m") - 1) - F.greatest(F.lit(0), F.col("place") - F.col("g") + 1) + 1
    kinds = F.array(
        F.struct(
            F.lit(False).alias("whole"),
            F.floor(F.col("m") / 9).alias("missing"),
            F.col("w").alias("least"),
            F.lit((1 << 31) - 1).alias("most"),
        ),
        F.struct(
            F.lit(True).alias("whole"),
            F.floor(F.col("m") / 5).alias("missing"),
            least_words().alias("least"),
            (F.col("w") - 1).alias("most"),
        ),
    )
    kinds = F.filter(kinds, lambda k: k["least"] <= k["most"])
    rated = (
        places.join(counts, "word", "left")
        .withColumn("n", F.coalesce("count", F.lit(0)))
        .withColumn("carried", carried)
        .withColumn("residue", F.pmod("place", F.lit(GRAM)))
        .withColumn("kind", F.explode(kinds))
        .select("item", "word", "place", "n", "carried", "residue", "kind.*")
    )
    rarest = Window.partitionBy("item", "whole", "residue").orderBy("n", F.desc("carried"), "place")
    before = F.coalesce(F.sum("carried").over(rarest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    picked = rated.withColumn("before", before).where(F.col("before") <= F.col("missing"))
    choice = Window.partitionBy("item", "whole", "residue")
    costs = picked.withColumns({"cost": F.sum("n").over(choice), "all": F.sum("carried").over(choice)})
    best = (
        costs.where(F.col("all") > F.col("missing"))
        .groupBy("item", "whole")
        .agg(F.min(F.struct("cost", "residue")).alias("b"))
        .select("item", "whole", F.col("b.residue").alias("residue"))
    )
    anchors = picked.join(best, ["item", "whole", "residue"]).select("word", "item", "whole", "least", "most")
    return written(anchors.distinct(), "anchors")


def anchor_hits(texts: DataFrame, anchors: DataFrame) -> DataFrame:
    """Per document, where which item's anchors are; WHOLE as the place if the document is shorter than the item."""
    empty = [F.when(F.get("raw", i) == "", 1).otherwise(0) for i in (F.lit(0), F.size("raw") - 1)]
    # beside the explode, the size would be found anew for each word
    sized = texts.select("doc", "raw", (F.size("raw") - empty[0] - empty[1]).alias("size"))
    places = sized.select("doc", "size", F.posexplode("raw").alias("place", "raw")).select(
        "doc", "size", "place", lowered(F.col("raw")).alias("spoken")
    )
    sought = (F.col("spoken") == F.col("word")) & F.col("size").between(F.col("least"), F.col("most"))
    place = F.when(F.col("whole"), F.lit(WHOLE)).otherwise(F.col("place")).alias("place")
    hits = places.join(few(anchors), sought).groupBy("doc").agg(F.collect_set(F.struct(place, "item")).alias("hits"))
    return written(hits.withColumnRenamed("doc", "hit_doc"), "hits")


def windows(texts: DataFrame, hits: DataFrame, items: DataFrame) -> DataFrame:
    """(doc, w, start, own) of the windows around the anchors that hold some word of the item's head and tail.

    A document shorter than the item is a window.
    """
    sizes = few(items.select("item", "w", "g", "m", "head", "tail"))
    near = texts.join(few(hits), F.col("doc").eqNullSafe(F.col("hit_doc"))).select(
        "doc",
        lower_words(F.col("raw")).alias("words"),
        F.when(F.get("raw", F.lit(0)) == "", 1).otherwise(0).alias("before"),
        "hits",
    )
    each = near.select("doc", "words", "before", F.explode("hits").alias("h")).select(
        "doc",
        "words",
        F.size("words").alias("size"),
        (F.col("h.place") == WHOLE).alias("whole"),
        (F.col("h.place") - F.col("before")).alias("place"),
        "h.item",
    )
    low = F.greatest(F.lit(0), F.col("place") - F.col("w") + 1)
    # rows that repeat an id have each other's hits
    shorter = F.col("size").between(least_words(), F.col("w") - 1)
    own_hits = F.when(F.col("whole"), shorter).otherwise(F.col("size") >= F.col("w"))
    region = each.join(sizes, "item").where(own_hits).select(
        "doc",
        "item",
        "w",
        "m",
        "g",
        "head",
        "tail",
        "whole",
        low.alias("low"),
        F.when(F.col("whole"), F.col("words"))
        .otherwise(F.slice("words", low + 1, F.col("place") + F.col("w") - low))
        .alias("region"),
    )
    fit = region.where(F.col("whole") | (F.size("region") >= F.col("w")))
    fit = fit.withColumn("grams", grams(F.col("region"), F.col("g")))
    around = F.filter(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("region") - F.col("w"))),
        lambda i: bound(
            F.slice("region", i + 1, F.col("w")),
            lambda own: F.arrays_overlap(own, F.col("head")) & F.arrays_overlap(own, F.col("tail")),
        ),
    )
    steps = F.when(F.col("whole"), F.array(F.lit(0))).otherwise(around)
    return fit.select("doc", "w", "m", "low", "grams", F.explode(steps).alias("step")).select(
        "doc",
        "w",
        (F.col("low") + F.col("step")).alias("start"),
        F.slice("grams", F.col("step") + 1, F.col("m")).alias("own"),
    )


def first_block(difference: Column) -> Column:
    """The first block in which two fingerprints of this XOR agree but for PROBE bits."""
    return F.coalesce(
        *[
            F.when(F.bit_count(F.shiftrightunsigned(difference, shift).bitwiseAND((1 << width) - 1)) <= PROBE, i)
            for i, (shift, width) in enumerate(block_bits())
        ]
    )


def common(a: Column, b: Column) -> Column:
    """Sum of the smaller counts of each element."""
    count = lambda xs, x: F.size(F.filter(xs, lambda y: y == x))
    return F.aggregate(
        F.array_intersect(a, b), F.lit(0), lambda s, x: s + F.least(count(a, x), count(b, x))
    )


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """(doc_id, item_id, start, similarity): the best window of each document and item that it holds."""
    if similarity < SIMILARITY:
        raise ValueError(f"anchors and radius are made for similarities from {SIMILARITY}")
    known = item_table(items, item_key, item_text)
    texts = docs.select(F.col(key).alias("doc"), raw_words(F.col(text)).alias("raw"))
    hits = anchor_hits(texts, anchor_table(known, texts))
    marked = windows(texts, hits, known).withColumn("print", simhash(F.col("own")))
    probed = marked.withColumn("b", F.explode(blocks_of(F.col("print")))).select(
        "doc", "start", "w", "own", "print", "b.block", "b.value"
    )
    index = known.select(
        "item_id", "w", "grams", "plain", "fingerprint", F.explode(blocks_of(F.col("fingerprint"))).alias("b")
    ).select("item_id", "w", "grams", "plain", "fingerprint", "b.block", F.col("b.value").alias("v"), F.explode(probes()).alias("x"))
    index = written(index.withColumn("value", F.col("v").bitwiseXOR(F.col("x"))).drop("v", "x"), "multi-index")
    # a pair that meets in several blocks counts in the first
    difference = F.col("print").bitwiseXOR(F.col("fingerprint"))
    near = probed.join(few(index), ["w", "block", "value"]).where(
        (F.bit_count(difference) <= RADIUS) & (F.col("block") == first_block(difference))
    )
    # an item without repeated shingles has each once
    overlap = F.when(F.col("plain"), F.size(F.array_intersect("own", "grams"))).otherwise(
        common(F.col("own"), F.col("grams"))
    )
    scored = near.withColumn("both", overlap).withColumn(
        "similarity", F.col("both") / (F.size("own") + F.size("grams") - F.col("both"))
    )
    best = (
        scored.where(F.col("similarity") >= similarity)
        .groupBy("doc", "item_id")
        .agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("x"))
    )
    return best.select(
        F.col("doc").alias("doc_id"),
        "item_id",
        (-F.col("x.back")).cast("long").alias("start"),
        F.col("x.similarity").alias("similarity"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that hold no item; all their columns, whatever the names."""
    bad = written(contaminated(docs, items, key, text).select(F.col("doc_id").alias("_bad")).distinct(), "leaks")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    clean = rows.join(few(bad), F.col(f"_row.`{key}`").eqNullSafe(F.col("_bad")), "left_anti")
    return clean.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
