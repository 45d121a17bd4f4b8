"""Filled summaries kept up to date by batches, against a full run over all readings."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import gapweave as gw

BEGIN, END = datetime(2024, 1, 1), datetime(2024, 1, 2, 23)
HOUR = timedelta(hours=1)
AGGS = {"lo": "min", "hi": "max", "mean": "avg", "total": "sum", "n": "count"}


def found(df):
    names = ["r_wban", "r_slice", *AGGS]
    return {
        (r[0], r[1]): tuple(x if x is None else round(x, 6) for x in r[2:]) for r in df.select(*names).collect()
    }


def some(pick, number):
    rows = []
    for key in ("a", "b", "c"):
        for _ in range(number):
            at = BEGIN + timedelta(seconds=pick.randrange(-7200, 50 * 3600, 300))
            rows.append((key, at, pick.choice([None, 1.0, 2.5, -4.0, 8.0])))
    # one slice with known readings, values that differ at one instant, and readings without a value between
    rows += [("a", BEGIN + timedelta(hours=9, seconds=s), v) for s in range(0, 900, 60) for v in (None, float(s), 3.0)]
    rows += [(None, BEGIN, 1.0), ("a", None, 1.0), ("d", BEGIN + timedelta(hours=30), None)]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("method, block", [("linear", 7), ("forward", 7), ("backward", 100)])
def test_batches_in_any_order_give_what_a_full_run_gives(spark, readings, tmp_path, method, block):
    how = {"aggs": AGGS, "method": method, "on_degenerate": "null"}
    state = gw.ResampleState(spark, str(tmp_path), BEGIN, END, HOUR, **how, block_slices=block)
    rows, so_far, have = some(random.Random(block), 12), [], {}
    for part in range(3):
        so_far += rows[part::3]
        changed = found(state.add(readings(rows[part::3])))
        full = gw.interpolate_series(readings(so_far), BEGIN, END, HOUR, "range", **how)
        want = found(full)
        assert found(state.result()) == want
        # whatever differs from before is among the rows of the batch
        assert {k: v for k, v in want.items() if have.get(k, "none") != v}.items() <= changed.items()
        have = want
    assert state.result().dtypes == full.dtypes


def test_a_late_reading_unfolds_the_blocks_up_to_its_neighbours_only(spark, readings, tmp_path):
    state = gw.ResampleState(spark, str(tmp_path), BEGIN, END, HOUR, aggs=AGGS, block_slices=4)
    at = [BEGIN + timedelta(hours=h) for h in (1, 13, 22, 40)]
    assert state.add(readings([(k, t, 1.0) for k in "ab" for t in at])).count() == 2 * 48
    late = state.add(readings([("a", BEGIN + timedelta(hours=17), 9.0)]))
    # blocks of hours 12, 16 and 20: from the reading before to the one after
    assert sorted({(r["r_wban"], r["r_slice"].hour) for r in late.collect()}) == [("a", h) for h in range(12, 24)]
    assert found(state.result())["a", BEGIN + timedelta(hours=15)][0] == 5.0
    # a reading without a value moves no anchor, but its blocks' neighbours are looked at
    none = state.add(readings([("b", BEGIN + timedelta(hours=30), None)]))
    assert {r["r_wban"] for r in none.collect()} == {"b"}
    read = state.table.read().where((F.col("kind") == "state") & F.col("part").isin([3, 4]))
    assert "PartitionFilters: [isnotnull(kind" in read._jdf.queryExecution().executedPlan().toString()


def test_an_empty_batch_other_choices_and_another_writer(spark, readings, tmp_path):
    state = gw.ResampleState(spark, str(tmp_path), BEGIN, END, HOUR, aggs=AGGS)
    rows = readings([("a", BEGIN, 1.0), ("a", END, 48.0)])
    assert state.add(rows.limit(0)).count() == 0 and state.result().count() == 0
    # another writer commits between reading the version and committing the next one
    commit, other = state.table.commit, gw.ResampleState(spark, str(tmp_path), BEGIN, END, HOUR, aggs=AGGS)

    def late(base, folder, **properties):
        state.table.commit = commit
        other.add(readings([("a", BEGIN + 10 * HOUR, 30.0)]))
        return commit(base, folder, **properties)

    state.table.commit = late
    state.add(rows)
    assert found(state.result())["a", BEGIN + 5 * HOUR][0] == 15.5
    with pytest.raises(ValueError, match="other choices"):
        gw.ResampleState(spark, str(tmp_path), BEGIN, END, 2 * HOUR).add(rows)
    with pytest.raises(ValueError, match="names of"):
        gw.ResampleState(spark, str(tmp_path), BEGIN, END, HOUR, aggs={"m": gw.quantile(0.5)})


def test_empty_slices_are_not_written(spark, readings, tmp_path):
    """A row for each slice would be written again by each batch, and compared by version when they are read."""
    state = gw.ResampleState(spark, str(tmp_path), BEGIN, BEGIN + timedelta(days=300), HOUR, aggs=AGGS, block_slices=1_000)
    for hours in (1, 7_000):
        state.add(readings([(k, BEGIN + timedelta(hours=hours), 1.0) for k in "ab"]))
    assert state.result().count() == 2 * (300 * 24 + 1)
    # 2 versions of 2 series, each with 8 blocks and a few states
    assert spark.read.parquet(str(tmp_path)).count() <= 2 * 2 * (8 + 2 * 4)
    assert state.result().rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    tiny = gw.ResampleState(spark, str(tmp_path), BEGIN, END, HOUR)
    with pytest.raises(ValueError, match="other choices"):
        tiny.result()
