"""Days, hours, ranges and files by the wall clock of a dataset's zone."""

from collections import Counter
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from quarrymill.functions.types import DType
from quarrymill.operators.intervals import interval, to_utc, to_wall, zoned_intervals
from quarrymill.plans import engine, partials
from quarrymill.plans.spec import ColumnSpec, DatasetSpec, ReportSpec
from quarrymill.sources import readers, store
from quarrymill.streaming.reports import stream_statistics

ZONES = ["America/New_York", "Australia/Perth", "Asia/Kolkata", "Australia/Lord_Howe", "Africa/Cairo"]  # Cairo's clock changes at midnight
N = (("*", "count", "n"),)


def spec(zone, **kw):
    return DatasetSpec("log", (ColumnSpec("who", DType(107), groupable=True),), time_column=kw.pop("time", "at"), timezone=zone, **kw)


def wall(at, zone):
    return at.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(zone)).replace(tzinfo=None)


@pytest.fixture(scope="module")
def times():
    return [datetime(2024, m, 1, 0, 7) + timedelta(minutes=53 * i) for m in (3, 4, 10, 11) for i in range(800)]


def instants(spark, times, zoned):
    df = spark.createDataFrame([(t,) for t in times], "at timestamp_ntz").withColumn("who", F.lit(1).cast("bigint"))
    return df.withColumn("at", F.to_timestamp_ltz(F.date_format("at", "yyyy-MM-dd HH:mm:ss"))) if zoned else df


@pytest.mark.parametrize("zoned", [False, True])
@pytest.mark.parametrize("zone", ZONES)
@pytest.mark.parametrize("kind", ["Daily", "MondayBasedWeekly", "Monthly", "Hourly", "SundayBasedFourWeekly"])
def test_buckets(spark, times, zone, kind, zoned):
    if zoned and kind not in ("Daily", "Hourly"):
        pytest.skip("the same floors")
    low, high = datetime(2024, 3, 1), datetime(2024, 11, 24)
    report = ReportSpec("r", "log", low, high, kind, resultset=N)
    got = {r.request_time: r.n for r in engine.run_statistics(spark, report, spec(zone), instants(spark, times, zoned))[0].collect()}
    i, anchor = interval(kind), interval(kind).floor(low)
    floor = (lambda t: anchor + timedelta(days=28 * ((t - anchor).days // 28))) if "Four" in kind else i.floor
    want = Counter(floor(w) for t in times if anchor <= (w := wall(t, zone)) < i.floor(high))
    assert {k: v for k, v in got.items() if v} == want
    if kind == "Daily":
        assert len(got) == (high - low).days
    if kind == "Hourly":  # an hour that the clock skips isn't there, one that it shows twice is one bucket
        clock = {wall(to_utc(low, zone) + timedelta(hours=k), zone).replace(minute=0) for k in range(24 * 268 + 1)}
        assert set(got) == {c for c in clock if low <= c < high}


@pytest.mark.parametrize("zone", ZONES)
def test_the_range_is_pushed_down(spark, times, zone, tmp_path):
    instants(spark, times, False).write.parquet(str(tmp_path / "t"))
    report = ReportSpec("r", "log", datetime(2024, 3, 10), datetime(2024, 3, 11), "Daily", resultset=N)
    final, _ = engine.run_statistics(spark, report, spec(zone), spark.read.parquet(str(tmp_path / "t")))
    assert final.first().n == sum(wall(t, zone).date() == datetime(2024, 3, 10).date() for t in times)
    plan = final._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at," in plan.split("PushedFilters:")[1].split("]")[0]


def test_clock_times():
    zone = "America/New_York"
    assert to_utc(datetime(2024, 3, 10, 2, 30), zone) == datetime(2024, 3, 10, 7, 30) and to_wall(datetime(2024, 3, 10, 7, 30), zone) == datetime(2024, 3, 10, 3, 30)
    assert to_utc(datetime(2024, 11, 3, 1, 30), zone) == datetime(2024, 11, 3, 5, 30)
    assert to_utc(datetime(2024, 4, 26), "Africa/Cairo") == datetime(2024, 4, 25, 22)  # the day begins at 01:00
    days = [b - a for _, a, b in zoned_intervals(interval("Daily"), datetime(2024, 3, 9), datetime(2024, 3, 12), datetime(2024, 4, 1), zone=zone)]
    assert [d.total_seconds() / 3600 for d in days] == [24, 23, 24]
    for day, n in ((datetime(2024, 3, 10), 23), (datetime(2024, 11, 3), 25), (datetime(2024, 5, 1), 24)):
        hours = list(zoned_intervals(interval("Hourly"), day, day + timedelta(days=1), day + timedelta(days=9), zone=zone))
        assert len(hours) == n and all(b - a == timedelta(hours=1) for _, a, b in hours) and all(x[2] == y[1] for x, y in zip(hours, hours[1:]))


def test_files_tables_and_states_by_local_days(spark, times, tmp_path):
    zone, home = "America/New_York", tmp_path / "logs"
    home.mkdir()
    web = spec(zone, data_interval="Daily", header=("who",), filename="%Y%m%d.csv", time="interval_start")
    low, high = datetime(2024, 3, 8), datetime(2024, 3, 14)
    for d in range(8, 14):
        (home / f"202403{d:02d}.csv").write_text("1\n" * d)
    at = str(tmp_path / "typed")
    assert store.download(spark, web, readers.source("localfs", home=str(home)), at, low, high) == []
    starts = sorted({r.interval_start for r in store.load(spark, at).collect()})
    assert starts[:4] == [datetime(2024, 3, 8, 5), datetime(2024, 3, 9, 5), datetime(2024, 3, 10, 5), datetime(2024, 3, 11, 4)]
    report = ReportSpec("r", "log", low, high, "Daily", resultset=N)
    want = {datetime(2024, 3, d): d for d in range(8, 14)}
    assert {r.request_time: r.n for r in engine.run_statistics(spark, report, web, store.load(spark, at))[0].collect()} == want
    assert {r.request_time: r.n for r in partials.run_statistics(spark, report, web, at, str(tmp_path / "states"))[0].collect()} == want
    # Two hours of one name are one file, the hour that is skipped has none.
    hourly = spec(zone, header=("who",), filename="%Y%m%d%H.csv")
    names = [f for _, _, f in readers.interval_files(hourly, datetime(2024, 11, 3), datetime(2024, 11, 4))]
    assert len(names) == 24 and "2024110301.csv" in names
    assert "2024031002.csv" not in [f for _, _, f in readers.interval_files(hourly, datetime(2024, 3, 10), datetime(2024, 3, 11))]


def test_streams_refuse_other_zones(spark, times):
    with pytest.raises(ValueError, match="UTC"):
        stream_statistics(ReportSpec("r", "log", rtype="Hourly", resultset=N), spec("Asia/Kolkata"), instants(spark, times[:2], True))
