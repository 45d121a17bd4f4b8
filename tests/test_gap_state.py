"""Gaps kept up to date by batches, against gap detection over all readings."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import gapweave as gw
from gapweave.plans.gap_state import GapState

BEGIN = datetime(2024, 1, 1)


def found(df):
    return sorted(map(str, (tuple(r) for r in df.select("wban", "current_datetime", "previous_datetime").collect())))


def batches(pick, many):
    rows = []
    for key in ("a", "b", None):
        at = BEGIN
        for _ in range(60):
            at += timedelta(seconds=pick.choice([1, 600, 3599, 3600, 3601, 40_000, 200_000]))
            rows.append((key, at, 1.0))
    pick.shuffle(rows)
    rows += rows[:5] + [("a", None, 1.0)]
    return [rows[i::many] for i in range(many)]


@pytest.mark.parametrize("threshold", [3600, 0])
def test_batches_in_any_order_give_the_gaps_of_all(spark, readings, tmp_path, threshold):
    state = GapState(spark, str(tmp_path), threshold, fan=3)
    so_far = []
    for batch in batches(random.Random(threshold), 3):
        before = set(found(state.gaps())) if so_far else set()
        changes = state.add(readings(batch))
        so_far += batch
        want = set(found(gw.find_gaps(readings(so_far), threshold)))
        assert set(found(state.gaps())) == want
        assert set(found(changes.where("change = 1"))) == want - before
        assert set(found(changes.where("change = -1"))) == before - want


def test_a_batch_twice_and_an_empty_one_change_nothing(spark, readings, tmp_path):
    state = GapState(spark, str(tmp_path))
    rows = readings([("a", BEGIN, 1), ("a", BEGIN + timedelta(hours=5), 1)])
    assert state.add(rows).count() == 1
    assert state.add(rows).count() == 0
    assert state.add(rows.limit(0)).count() == 0
    late = state.add(readings([("a", BEGIN + timedelta(hours=2), 1)]))
    assert sorted(r["change"] for r in late.collect()) == [-1, 1, 1]
    with pytest.raises(ValueError, match="negative"):
        GapState(spark, str(tmp_path), -1)


def test_a_day_reads_its_own_block_only(spark, readings, tmp_path):
    state = GapState(spark, str(tmp_path))
    history = [(k, BEGIN + timedelta(hours=6 * i), 1) for k in "abc" for i in range(4 * 60)]
    state.add(readings(history))
    day = readings([("b", BEGIN + timedelta(days=30, hours=2), 1)])
    (block,) = [r[0] for r in state._buckets(day).select("block").collect()]
    stored = state.table.read().where((F.col("kind") == "bucket") & F.col("part").isin([block]))
    assert "PartitionFilters: [isnotnull(kind" in stored._jdf.queryExecution().executedPlan().toString()
    files = stored.select(F.col("_metadata.file_path")).distinct().collect()
    assert files and all(f"part={block}" in r[0] for r in files)
    assert state.table.read().where("kind = 'bucket'").select("part").distinct().count() > 50
    assert state.add(day).count() == 3  # one gap of six hours becomes two
