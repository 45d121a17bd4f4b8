"""Tables that several writers change, and ingest that takes each file once."""

import glob
import os
import shutil
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_pipeline import HOURLY_HEADER, hourly, weather

import gapweave as gw
from gapweave.plans import standins
from gapweave.sources import versions
from gapweave.sources.versions import Files, VersionedTable, canonical
from gapweave.streaming.ledger import FILE_COLUMNS, file_columns

ROWS = T.StructType([T.StructField("n", T.LongType())])
STATIONS = T.StructType(
    [T.StructField("station_id", T.IntegerType()), T.StructField("wban", T.StringType()), T.StructField("name", T.StringType())]
)


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], ROWS)


def test_a_commit_to_an_old_version_is_refused(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path), ROWS)
    assert table.read().count() == 0
    base = table.latest()
    mine, theirs = table.write(numbers(spark, 1)), table.write(numbers(spark, 2))
    assert table.commit(base, theirs, counter=5).number == 1
    assert table.commit(base, mine) is None
    assert [r["n"] for r in table.read().collect()] == [2]
    again = table.commit(table.latest(), mine)
    assert (again.number, again.properties) == (2, {"counter": 5})
    assert sorted(r["n"] for r in table.read().collect()) == [1, 2]


def test_put_if_absent_keeps_the_first(spark, tmp_path):
    files = Files(spark, str(tmp_path))
    assert files.put_if_absent("a/b.json", "first")
    assert not files.put_if_absent("a/b.json", "second")
    assert files.text("a/b.json") == "first"
    assert files.names("a") == ["b.json"]


def test_folders_are_merged_by_levels_and_old_ones_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "FANOUT", 3)
    monkeypatch.setattr(versions, "KEPT_VERSIONS", 2)
    table = VersionedTable(spark, str(tmp_path), ROWS)
    for n in range(10):
        base = table.latest()
        assert table.commit(base, table.write(numbers(spark, n)))
    last = table.latest()
    assert [level for _, level in last.parts] == [2, 0]
    assert sorted(r["n"] for r in table.read().collect()) == list(range(10))
    table.write(numbers(spark, 99))  # of a writer that failed
    assert len(table.files.names("_commits")) == 2
    assert len(table.vacuum()) > 5
    assert sorted(r["n"] for r in table.read().collect()) == list(range(10))


def test_upserts_that_meet(spark, tmp_path):
    def candidates(*rows):
        return spark.createDataFrame(rows, "wban string, name string, position int")

    table = gw.StationTable(spark, str(tmp_path), STATIONS)
    early = table.prepare(candidates(("a", "early", 1), ("b", "early", 2), (None, "no key", 3)), "position")
    assert table.upsert(candidates(("b", "second", 2), ("b", "first", 1), ("c", "first", 1)), "position") == 2
    assert not table.commit(early)
    assert table.upsert(candidates(("a", "early", 1), ("b", "early", 2)), "position") == 1
    assert table.upsert(candidates(("a", "late", 1)), "position") == 0
    found = sorted((r["wban"], r["name"], r["station_id"]) for r in table.read().collect())
    assert [f[:2] for f in found] == [("a", "early"), ("b", "first"), ("c", "first")]
    assert found[0][2] == 3 and sorted(f[2] for f in found) == [1, 2, 3]


def test_writers_at_the_same_time(spark, tmp_path):
    failed = []

    def write(who):
        try:
            rows = [(f"w{i}", who, i) for i in range(who * 10, who * 10 + 20)]
            rows = spark.createDataFrame(rows, "wban string, name int, position int")
            gw.StationTable(spark, str(tmp_path), STATIONS).upsert(rows.withColumn("name", F.col("name").cast("string")), "position")
        except Exception as error:  # shown by the assertion below
            failed.append(error)

    writers = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert not failed
    rows = gw.StationTable(spark, str(tmp_path), STATIONS).read().collect()
    assert sorted(r["wban"] for r in rows) == sorted(f"w{i}" for i in range(50))
    assert sorted(r["station_id"] for r in rows) == list(range(1, 51))


def minutes(first, many, wban="1"):
    return [hourly(wban, "20150323", f"{i // 60:02}{i % 60:02}", temperature=str(i)) for i in range(first, first + many)]


@pytest.fixture
def source(spark, tmp_path):
    folder = tmp_path / "in" / "hourly"
    folder.mkdir(parents=True)
    for name, lines in (("a.txt", minutes(0, 250)), ("b.txt", minutes(300, 30) + minutes(0, 5, "unknown"))):
        (folder / name).write_text("\n".join([HOURLY_HEADER, *lines]) + "\n")
    return folder


@pytest.fixture
def stations(spark):
    return spark.createDataFrame([("1",)], "wban string")


def take(spark, folder, stations, target, **options):
    gw.stream_ingest(spark, str(folder), stations, str(target), every=None, **options).awaitTermination()
    return weather(gw.read_weather(spark, str(target)))


def test_a_folder_of_many_names_is_taken_once(spark, source, stations, tmp_path):
    target = tmp_path / "table"
    first = take(spark, source, stations, target)
    assert len(first) == 280
    os.symlink(source, tmp_path / "link")
    names = [f"file:{source}", f"file://{source}/", f"{source}/*.txt", f"{source}/../hourly", f"{source.parent}/*", tmp_path / "link"]
    for name in names:
        assert take(spark, name, stations, target) == first
    (source / "c.txt").write_text("\n".join([HOURLY_HEADER, *minutes(400, 2)]) + "\n")
    assert len(take(spark, f"{source}/*.txt", stations, target)) == 282
    assert len(take(spark, source, stations, target)) == 282


def test_canonical(spark, tmp_path):
    (tmp_path / "x").mkdir()
    os.symlink(tmp_path / "x", tmp_path / "y")
    spelled = [f"{tmp_path}/x", f"file:{tmp_path}/x/", f"{tmp_path}/y/../x", f"{tmp_path}/y"]
    assert {canonical(spark, p) for p in spelled} == {f"file://{os.path.realpath(tmp_path)}/x"}


def test_batches_hold_no_more_than_asked_for(spark, source, stations, tmp_path):
    target = tmp_path / "table"
    assert len(take(spark, source, stations, target, batch_rows=100)) == 280
    sizes = spark.read.parquet(str(target)).groupBy("query", "batch", "split").count().collect()
    assert sorted(r["count"] for r in sizes) == [80, 100, 100]
    ledger = gw.TakenFiles(spark, str(target)).read()
    found = sorted((os.path.basename(r["path"]), r["split"], r["first_record"], r["records"]) for r in ledger.collect())
    assert found == [
        ("a.txt", 0, 0, 100), ("a.txt", 1, 100, 100), ("a.txt", 2, 200, 50), ("b.txt", 2, 0, 35)
    ]
    # the first folder holds the first records of the first file
    zero = spark.read.parquet(str(target)).where("split = 0")
    assert sorted(r["temperature"] for r in zero.collect()) == [float(i) for i in range(100)]


def test_small_batches_make_no_small_files(spark, source, stations, tmp_path):
    target = tmp_path / "table"
    assert len(take(spark, source, stations, target, batch_rows=5)) == 280
    sizes = spark.read.parquet(str(target)).groupBy("query", "batch", "split").count().collect()
    assert sorted(r["count"] for r in sizes) == [5] * 56
    assert len(list(target.glob("query=*/**/*.parquet"))) <= 4  # there are 57 batches


def test_a_micro_batch_takes_few_jobs(spark, source, stations, tmp_path):
    (source / "c.txt").write_text("\n".join([HOURLY_HEADER, *minutes(600, 20)]) + "\n")
    target = str(tmp_path / "table")
    query = gw.stream_ingest(spark, str(source), stations, target, every=None, max_files=1)
    query.awaitTermination()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(str(query.runId))
    assert 3 <= len(jobs) <= 3 * 10  # there were 17 a micro-batch
    seen = spark.read.text(str(source)).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    ledger = gw.TakenFiles(spark, target).read().select("path", "bytes", "modified")
    assert sorted(ledger.collect()) == sorted(seen.distinct().collect())


@pytest.mark.parametrize("listed", [0, 1_000])
def test_files_are_found_in_the_ledger_by_name_or_by_join(spark, source, stations, tmp_path, monkeypatch, listed):
    monkeypatch.setattr("gapweave.streaming.ledger.LISTED", listed)
    first = take(spark, source, stations, tmp_path / "table")
    assert take(spark, f"{source}/*", stations, tmp_path / "table") == first and len(first) == 280


def test_hourly_files_are_sized_by_their_rows(spark):
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        folder = standins.write_hourly_files(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert len(glob.glob(f"{folder}/*.csv")) <= standins.FEW_FILES
    assert spark.read.option("header", True).csv(folder).count() == 1000


def test_a_table_with_a_folder_for_each_batch_goes_on(spark, source, stations, tmp_path):
    target = tmp_path / "table"
    row = "SELECT '1' AS wban, TIMESTAMP_NTZ'2015-03-01' AS datetime, 1F AS temperature, 2F AS windspeed"
    old = spark.sql(f"{row}, 3F AS stationpressure, 'CLR' AS skycondition, 'x' AS query, 0 AS batch, 0 AS split")
    old.write.partitionBy("query", "batch", "split").parquet(str(target))
    found = take(spark, source, stations, target, batch_rows=100)
    assert len(found) == 281
    splits = spark.read.parquet(str(target)).where("query <> 'x'").groupBy("split").count().collect()
    assert sorted(r["count"] for r in splits) == [80, 100, 100]


@pytest.mark.parametrize("by_day", [False, True])
def test_a_batch_that_failed_after_its_claim_is_made_again(spark, source, stations, tmp_path, by_day):
    target = tmp_path / "table"
    first = take(spark, source, stations, target, batch_rows=100, by_day=by_day)
    (checkpoint,) = (target / "_checkpoint").iterdir()
    (batch,) = target.glob("query=*/batch=0")
    before = sorted(str(p.parent) for p in batch.rglob("*.parquet"))
    for name in ("0", ".0.crc"):
        (checkpoint / "commits" / name).unlink(missing_ok=True)
    shutil.rmtree(batch)
    assert take(spark, source, stations, target, batch_rows=100, by_day=by_day) == first
    assert set(before) == {str(p.parent) for p in batch.rglob("*.parquet")}
    assert gw.TakenFiles(spark, str(target)).read().count() == 4


def test_a_file_that_another_stream_claimed_is_left_to_it(spark, source, stations, tmp_path):
    target = tmp_path / "table"
    read = spark.read.text(str(source / "a.txt")).select(*file_columns())
    pieces = read.groupBy(*FILE_COLUMNS).agg((F.count("*") - 1).alias("records"))
    ledger = gw.TakenFiles(spark, str(target))
    assert ledger.claim(pieces, "other", 3, 100).count() == 1
    assert ledger.claim(pieces, "other", 3, 100).count() == 1  # the same batch again
    assert ledger.claim(pieces, "third", 0, 100).count() == 0
    assert len(take(spark, source, stations, target)) == 30
    assert ledger.read().where("query = 'other'").agg(F.sum("records")).first()[0] == 250


def test_a_file_that_changed_fails_the_stream(spark, source, stations, tmp_path):
    target = tmp_path / "table"
    first = take(spark, f"{source}/a.t*", stations, target)
    with open(source / "a.txt", "a") as f:
        f.write("\n".join(minutes(500, 1)) + "\n")
    with pytest.raises(Exception, match="has changed since it was taken"):
        take(spark, source, stations, target)
    assert weather(gw.read_weather(spark, str(target))) == first


def test_a_batch_keeps_the_stations_it_joined(spark, source, tmp_path):
    """Stations that come between batches are seen; a batch that is made again joins those of its first time."""
    target = tmp_path / "table"
    table = gw.StationTable(spark, str(tmp_path / "stations"), STATIONS)
    rows = spark.createDataFrame([("1", "first", 0), ("unknown", "later", 0)], "wban string, name string, position int")
    table.upsert(rows.where("wban = '1'"), "position")
    first = take(spark, source, table, target)
    assert len(first) == 280
    table.upsert(rows, "position")
    (checkpoint,) = (target / "_checkpoint").iterdir()
    (batch,) = target.glob("query=*/batch=0")
    for name in ("0", ".0.crc"):
        (checkpoint / "commits" / name).unlink(missing_ok=True)
    shutil.rmtree(batch)
    assert take(spark, source, table, target) == first
    (source / "c.txt").write_text("\n".join([HOURLY_HEADER, *minutes(600, 2, "unknown")]) + "\n")
    assert len(take(spark, source, table, target)) == 282
