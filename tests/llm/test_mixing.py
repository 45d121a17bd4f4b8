"""The source mix: targets, permutations, splits and what is taken of each document."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gapweave.llm import mixing
from gapweave.llm.mix_queries import op12_source_mix
from gapweave.llm.mixing import Mix, last_draw, permuted, targets

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, text string"
ROWS = (
    [(i, "a", "w " * (i % 9)) for i in range(300)]
    + [(1000 + i, "b", "x\ty\n" * 40) for i in range(60)]
    + [(2000 + i, None, "z " * 5) for i in range(30)]
    + [(3000, "long", "v " * 5000), (3001, "c", None), (3002, "c", ""), (3003, "", "one")]
    + [(None, "d", "no id"), (None, "d", "no id"), (4000, "d", "same row")]
    + [(4000, "d", "same row"), (4000, "d", "same id, more words")]
)


def plain_targets(sizes, weights, share, most):
    """Give every open source a little more, in proportion, until all is given (by bisection on the level)."""
    low, high = 0.0, 1e12
    for _ in range(300):
        level = (low + high) / 2
        if sum(min(most * s, weights[i % len(weights)] * level) for i, s in enumerate(sizes)) < share * sum(sizes):
            low = level
        else:
            high = level
    return [min(most * s, weights[i % len(weights)] * high) for i, s in enumerate(sizes)]


def test_targets():
    pick = random.Random(1)
    for _ in range(200):
        sizes = [pick.choice([0, 1, 10, 1000, 10**6]) for _ in range(pick.randint(0, 9))]
        found = targets(sizes, (5.0, 2.0, 1.0), 1.5, 2.0)
        assert found == pytest.approx(plain_targets(sizes, (5.0, 2.0, 1.0), 1.5, 2.0), rel=1e-6, abs=1e-6)
        assert sum(found) == pytest.approx(1.5 * sum(sizes))
        assert all(t <= 2 * s for t, s in zip(found, sizes, strict=True))


def test_permutation_and_inverse():
    for n in (1, 2, 3, 5, 17, 1000, 4096, 4097):
        x, of = np.arange(n), np.full(n, n)
        key = np.full(n, 99 + n)
        there = permuted(x, of, key)
        assert sorted(there) == list(range(n))
        assert (permuted(there, of, key, inverse=True) == x).all()


def test_last_draw():
    pick = random.Random(2)
    for _ in range(2000):
        words, total = pick.randint(1, 9), pick.randint(1, 60)
        blocks = -(-total // words)
        order = pick.sample(range(blocks), blocks)
        sizes = [total - (blocks - 1) * words if b == blocks - 1 else words for b in order]
        rest = pick.randint(1, total)
        many, cut = last_draw(rest, total, blocks, words, order.index(blocks - 1))
        assert sum(sizes[: many - 1]) + cut == rest
        assert 0 < cut <= sizes[many - 1]


def spread(rows):
    sizes = {}
    for _, source, text in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    found = plain_targets([sizes[n] for n in names], (5.0, 2.0, 1.0), 1.5, 2.0)
    return {n: (sizes[n], t) for n, t in zip(names, found, strict=True)}


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    names = ["grp", "id", "amount", "hash", "src", "start", "total", "size", "block", "words", "shard", "many"]
    return frame.withColumns({n: F.lit(f"other {n}") for n in names})


@pytest.mark.parametrize("options", [{}, {"block_words": 7, "shard_blocks": 3}, {"block_words": 1, "shard_blocks": 50}])
def test_mix_of_odd_rows(docs, options):
    mix = Mix(docs, **options)
    taken = mix.taken().collect()
    assert sorted((r["id"] or -1, r["size"]) for r in taken) == sorted((i or -1, len((t or "").split())) for i, _, t in ROWS)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in taken)
    plan = {r["grp"]: r for r in mix.plan.collect()}
    want = spread(ROWS)
    assert {n: r["total"] for n, r in plan.items()} == {n: s for n, (s, _) in want.items()}
    for name, (_, target) in want.items():
        assert plan[name]["target"] == pytest.approx(target, rel=1e-6)
    pieces = mix.pieces().collect()
    per_source = Counter()
    for p in pieces:
        per_source[p["src"]] += p["words"]
    assert {r["src"]: r["take"] for r in plan.values() if r["take"]} == dict(per_source)
    assert all(abs(r["take"] - r["target"]) <= 0.5 for r in plan.values())
    # within a pass, no word is drawn twice
    words = Counter((p["src"], p["pass"], p["start"] + k) for p in pieces for k in range(p["first"], p["first"] + p["words"]))
    assert max(words.values()) == 1
    # shards hold as many draws as the others and number their spans from 0
    draws = Counter(r["shard"] for r in mix.draws.collect())
    assert max(draws.values()) - min(draws.values()) <= 1
    places = {}
    for p in pieces:
        places.setdefault(p["shard"], []).append(p["place"])
    assert all(sorted(x) == list(range(len(x))) for x in places.values())


def test_draws_are_all_given_out_once(docs):
    mix = Mix(docs, block_words=3, shard_blocks=2)
    drawn = Counter((r["src"], r["pass"], r["block"]) for r in mix.draws.collect())
    assert set(drawn.values()) == {1}
    per_source = Counter(key[0] for key in drawn.elements())
    assert dict(per_source) == {r["src"]: r["draws"] for r in mix.plan.collect() if r["draws"]}


def test_splits_are_hypergeometric():
    """Halves of a node with 30 and 10 draws: the mean and variance of the sample."""
    node = (0, 2, np.array([0, 1]), np.array([0, 0]), np.array([30, 10]))
    left = [dict(zip(*[x.tolist() for x in (h[2], h[4])], strict=True)).get(1, 0)
            for seed in range(4000) for h in list(mixing.halves(node, 40, 2, seed))[:1]]
    assert np.mean(left) == pytest.approx(5, abs=0.1)
    assert np.var(left) == pytest.approx(20 * 0.25 * 0.75 * 20 / 39, rel=0.1)


def test_reruns_agree_whatever_the_partitions(docs):
    first = Mix(docs, block_words=7).taken().collect()
    again = Mix(docs.repartition(9), block_words=7).taken().collect()
    assert sorted(map(repr, first)) == sorted(map(repr, again))
    other = Mix(docs, block_words=7, seed=8).taken().collect()
    assert sorted(map(repr, first)) != sorted(map(repr, other))


def test_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert Mix(empty).taken().collect() == []
    blank = spark.createDataFrame([(1, "a", None), (2, None, " ")], SCHEMA)
    assert [(r["size"], r["target"], r["taken"]) for r in Mix(blank).taken().collect()] == [(0, 0.0, 0)] * 2
    with pytest.raises(ValueError, match="can't take more"):
        Mix(blank, share=3.0)


def test_query(spark):
    found = op12_source_mix(spark, FOLDER).collect()
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    want = spread([(r["doc_id"], r["source"], r["text"]) for r in documents])
    source = {r["doc_id"]: r["source"] for r in documents}
    assert len(found) == len(documents)
    sums = Counter()
    for r in found:
        assert r["source_size"] == want[source[r["doc_id"]]][0]
        assert r["target"] == pytest.approx(want[source[r["doc_id"]]][1], rel=1e-6)
        assert r["taken"] <= 2 * r["size"]
        sums[source[r["doc_id"]]] += r["taken"]
    assert all(abs(sums[s] - t) <= 0.5 for s, (_, t) in want.items())
