"""The typed table's commits: readers see all of a download or nothing of it."""

import os
import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarrymill.functions.types import DType
from quarrymill.plans import engine
from quarrymill.plans.spec import ColumnSpec, DatasetSpec, ReportSpec
from quarrymill.sources import commits, readers, store

TEXT, LONG = DType(301, size=20), DType(107)
WEB = DatasetSpec("web", (ColumnSpec("who", TEXT, groupable=True), ColumnSpec("n", LONG, statistical=True)), header=("who", "n"), ignore_missing_datafile=True)
DAY = datetime(2024, 1, 1)


def rows(spark, hours, n=3):
    return spark.createDataFrame([(f"u{i}", str(i), DAY + timedelta(hours=h), i) for h in hours for i in range(n)], "who string, n string, interval_start timestamp_ntz, row_no bigint")


def hours(df):
    return {r.interval_start.hour: r["count"] for r in df.groupBy("interval_start").count().collect()}


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    at = str(tmp_path / "t")
    store.materialise(rows(spark, [0, 1]), WEB, at)
    broken = rows(spark, [1, 2], 5).withColumn("who", F.when(F.hour("interval_start") == 2, F.raise_error(F.lit("cut off")).cast("string")).otherwise(F.col("who")))
    with pytest.raises(Exception, match="cut off"):
        store.materialise(broken.repartition(2), WEB, at)
    assert hours(store.load(spark, at)) == {0: 3, 1: 3} and commits.latest(spark, at).number == 1
    # What a dead writer leaves is deleted a day later, not before.
    dead = "data-dead"
    os.makedirs(f"{at}/{dead}/day=2024-01-01/slot=t202401010000")
    store.materialise(rows(spark, [3]), WEB, at)
    assert dead in os.listdir(at)
    os.utime(f"{at}/{dead}", (0, 0))
    store.materialise(rows(spark, [4]), WEB, at)
    assert dead not in os.listdir(at) and hours(store.load(spark, at)) == {0: 3, 1: 3, 3: 3, 4: 3}


def test_a_writer_that_dies_before_its_commit(spark, tmp_path, monkeypatch):
    at = str(tmp_path / "t")
    store.materialise(rows(spark, [0]), WEB, at)
    monkeypatch.setattr(commits, "_put", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        store.materialise(rows(spark, [0, 1], 9), WEB, at)
    assert hours(store.load(spark, at)) == {0: 3}


def test_readers_go_on_with_what_they_opened(spark, tmp_path):
    at = str(tmp_path / "t")
    store.materialise(rows(spark, [0, 1]), WEB, at)
    opened = store.load(spark, at)
    store.materialise(rows(spark, [1, 2], 5), WEB, at)
    assert hours(opened) == {0: 3, 1: 3} and hours(store.load(spark, at)) == {0: 3, 1: 5, 2: 5}
    store.materialise(rows(spark, [2], 1), WEB, at)  # the first write's hour 1 goes, its hour 0 stays
    assert hours(store.load(spark, at)) == {0: 3, 1: 5, 2: 1}
    assert len(list((tmp_path / "t").glob("data-*/day=*/slot=t202401010100"))) == 1 and len(list((tmp_path / "t" / "_commits").glob("[0-9]*.json"))) == 2


def test_two_writers_keep_each_others_intervals(spark, tmp_path):
    at, errors = str(tmp_path / "t"), []

    def write(h):
        try:
            store.materialise(rows(spark, [h], h + 1), WEB, at)
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=write, args=(h,)) for h in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and hours(store.load(spark, at)) == {h: h + 1 for h in range(6)} and commits.latest(spark, at).number == 6


def test_a_taken_number_is_not_overwritten(spark, tmp_path):
    at = str(tmp_path / "t")
    store.materialise(rows(spark, [0]), WEB, at)
    first = commits.latest(spark, at)
    assert not commits._put(spark, at, commits.Commit(1)) and commits.latest(spark, at) == first
    assert [f for f in os.listdir(f"{at}/_commits") if f.endswith(".json")] == ["000000000001.json"]


def test_an_empty_interval_is_fetched_once(spark, tmp_path):
    home = tmp_path / "logs"
    home.mkdir()
    for h, text in ((0, "a,1\n"), (1, ""), (2, "b,2\n")):
        (home / f"20240101{h:02d}.csv").write_text(text)
    origin, at, end = readers.source("localfs", home=str(home)), str(tmp_path / "t"), DAY + timedelta(hours=4)
    assert store.download(spark, WEB, origin, at, DAY, end) == ["2024010103.csv"]
    assert [f for _, _, f in store.stale(spark, at, readers.interval_files(WEB, DAY, end), None)] == ["2024010103.csv"]  # the missing one only
    number = commits.latest(spark, at).number
    assert store.download(spark, WEB, origin, at, DAY, DAY + timedelta(hours=3), only_stale=True) == [] and commits.latest(spark, at).number == number
    assert {s: e.rows for s, e in commits.latest(spark, at).intervals.items()} == {"t202401010000": 1, "t202401010100": 0, "t202401010200": 1}


def test_reports_on_a_table_without_rows(spark, tmp_path):
    home = tmp_path / "logs"
    home.mkdir()
    (home / "2024010100.csv").write_text("")
    at = str(tmp_path / "t")
    store.download(spark, WEB, readers.source("localfs", home=str(home)), at, DAY, DAY + timedelta(hours=1))
    table = store.load(spark, at)
    assert dict(table.dtypes)["n"] == "bigint" and table.count() == 0
    report = lambda **kw: [tuple(r) for r in engine.run_statistics(spark, ReportSpec("r", "web", resultset=(("*", "count", "rows"), ("n", "sum", "total")), **kw), WEB, table)[0].collect()]
    assert report() == [(0, 0)] and report(group_by=("who",)) == []
    assert [r[1:] for r in report(rtype="Hourly", start=DAY, end=DAY + timedelta(hours=2))] == [(0, 0), (0, 0)]
    with pytest.raises(FileNotFoundError):
        store.load(spark, str(tmp_path / "nothing"))


def test_columns_that_come_later(spark, tmp_path):
    at = str(tmp_path / "t")
    store.materialise(rows(spark, [0]), WEB, at)
    more = DatasetSpec("web", (*WEB.columns, ColumnSpec("size", LONG, statistical=True)), header=("who", "n", "size"))
    store.materialise(rows(spark, [1]).withColumn("size", F.lit("7")), more, at)
    table = store.load(spark, at)
    assert {(r.interval_start.hour, r["size"]) for r in table.collect()} == {(0, None), (1, 7)}
    other = DatasetSpec("web", (WEB.columns[0], ColumnSpec("n", DType(203), statistical=True)), header=("who", "n"))
    store.materialise(rows(spark, [2]), other, at)
    with pytest.raises(ValueError, match="column n has the types"):
        store.load(spark, at)
    assert store.load(spark, at, low=DAY + timedelta(hours=2)).count() == 3


def test_only_wanted_intervals_are_opened(spark, tmp_path):
    at = str(tmp_path / "t")
    store.materialise(rows(spark, range(6)), WEB, at)
    some = store.load(spark, at, DAY + timedelta(hours=2), DAY + timedelta(hours=4))
    assert hours(some) == {2: 3, 3: 3} and all("0300" in f or "0200" in f for f in some.inputFiles())
