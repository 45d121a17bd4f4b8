"""The pipeline's stages, each on what the one before kept, against brute force."""

import os
from collections import Counter

import text_brute as brute
import pytest
from test_operators import packed_well

import corpus_pipeline
from gapweave.llm.quality_rules import learn_rules
from gapweave.llm.shared import written

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not there")


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    rules = learn_rules(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert len(rules.rules) == 1 and rules.rules[0][0].statistic == "symbols_per_word"
    cut = rules.rules[0][0].cut
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)

    docs = written(stages["quality rules"](spark, docs, FOLDER), "stage")
    judged = {d: brute.quality(t) for d, t in rows}
    rows = [(d, t) for d, t in rows if not judged[d][5] and judged[d][2] / judged[d][0] < cut]
    assert Counter((r.doc_id, r.text) for r in docs.collect()) == Counter(rows)
    assert all(labels.get(d) != 0 for d, _ in rows)

    docs = written(stages["line dedup"](spark, docs, FOLDER), "stage")
    rows = [(d, t) for d, _, _, t in brute.dedup_lines(rows)]
    assert Counter((r.doc_id, r.text, r.n_chars) for r in docs.collect()) == Counter((d, t, len(t)) for d, t in rows)

    docs = written(stages["n-gram Jaccard join"](spark, docs, FOLDER), "stage")
    component = {d: c for d, _, c in brute.near_duplicates(rows)}
    rows = [(d, t) for d, t in rows if component[d] == d]
    assert Counter((r.doc_id, r.text) for r in docs.collect()) == Counter(rows)

    docs = written(stages["benchmark decontamination"](spark, docs, FOLDER), "stage")
    bad = {d for d, _ in brute.contaminated(rows, items)}
    rows = [(d, t) for d, t in rows if d not in bad]
    assert Counter((r.doc_id, r.text) for r in docs.collect()) == Counter(rows)
    assert docs.columns == columns

    packed = stages["best-fit packing"](spark, docs, FOLDER).collect()
    assert {r.doc_id for r in packed} == {d for d, _ in rows}
    assert packed_well(packed, 4096) <= -(-sum(r.length for r in packed) // 4096) * 1.02 + 1

    whole = corpus_pipeline.run(spark, FOLDER).collect()
    pick = lambda rs: Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rs)
    assert pick(whole) == pick(packed)
