"""Operators of the report engine on small frames."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarrymill.functions import network, transforms
from quarrymill.functions.types import DType, parse, wider
from quarrymill.operators import dictionary as enums
from quarrymill.operators import prepare
from quarrymill.operators.intervals import INTERVALS, interval, report_range, whole_intervals
from quarrymill.operators.predicates import UnsupportedOperator, predicate
from quarrymill.plans import engine
from quarrymill.plans.planner import InvalidReport, bind
from quarrymill.plans.spec import ColumnSpec, DatasetSpec, ReportSpec, Transform
from quarrymill.sources import audit, readers, store
from quarrymill.streaming.reports import stream_statistics

LONG, DOUBLE, TEXT = DType(107), DType(203), DType(301, size=20)


@pytest.fixture(scope="module")
def log(spark):
    rows = [(datetime(2024, 1, 1, h, m), u, t, v) for h, m, u, t, v in [(0, 5, 1, "a", 1.0), (0, 40, 2, "b", 5.0), (2, 0, 1, "a", 10.0), (2, 30, 0, "b", -4.0), (25 - 24, 0, 3, "c", 10.0)]]
    return spark.createDataFrame(rows, "ts timestamp_ntz, user bigint, kind string, value double")


SPEC = DatasetSpec("log", (ColumnSpec("user", LONG, statistical=True, groupable=True, distinctable=True), ColumnSpec("kind", TEXT, groupable=True, distinctable=True), ColumnSpec("value", DOUBLE, statistical=True)), time_column="ts")


def stats(spark, df, **kw):
    return engine.run_statistics(spark, ReportSpec("r", "log", **kw), SPEC, df)[0]


def values(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("op,value,want", [
    ("=", 5, [5]), ("<>", 5, [1, 10]), (">", 5, [10]), (">=", 5, [5, 10]), ("<", 5, [1]), ("<=", 5, [1, 5]),
    ("between", [1, 10], [1, 5]), ("in", [1, 10], [1, 10]), ("not in", [1, 10], [5]),
])
def test_number_operators(spark, op, value, want):
    df = spark.createDataFrame([(1,), (5,), (10,)], "x bigint")
    assert [r.x for r in df.where(predicate(F.col("x"), LONG, op, value)).orderBy("x").collect()] == want


@pytest.mark.parametrize("op,value,want", [
    ("==", "abc", ["abc"]), ("!=", "abc", ["", "bcd", "xyz"]), ("in", ["abc", "xyz"], ["abc", "xyz"]), ("not in", ["abc", "xyz"], ["", "bcd"]),
    ("contain", "bc", ["abc", "bcd"]), ("not contain", "bc", ["", "xyz"]), ("mcontain", ["ab", "yz"], ["abc", "xyz"]), ("not mcontain", ["ab", "yz"], ["", "bcd"]),
    ("startswith", "b", ["bcd"]), ("not startswith", "b", ["", "abc", "xyz"]), ("mstartswith", ["a", "b"], ["abc", "bcd"]), ("not mstartswith", ["a", "b"], ["", "xyz"]),
    ("endswith", "d", ["bcd"]), ("not endswith", "d", ["", "abc", "xyz"]), ("mendswith", ["c", "d"], ["abc", "bcd"]), ("not mendswith", ["c", "d"], ["", "xyz"]),
])
def test_text_operators(spark, op, value, want):
    df = spark.createDataFrame([("abc",), ("bcd",), ("xyz",), ("",)], "x string")
    assert [r.x for r in df.where(predicate(F.col("x"), TEXT, op, value)).orderBy("x").collect()] == want


@pytest.mark.parametrize("op,value,want", [
    ("==", [1, 2], [1]), ("!=", [1, 2], [2, 3]), ("in", [[1, 2]], [1]), ("in", [[1, 2], [3, 3]], [1, 2, 3]), ("not in", [[1, 2], [4, 4]], [2, 3]),
    ("range", [1, 2], [1]), ("range", [[1, 2], [3, 2.5]], [1]), ("not in range", [1, 2], [2, 3]), ("ranges", [[1, 2], [3, 3]], [1, 3]), ("not in ranges", [[1, 2], [3, 3]], [2]),
])
def test_list_operators(spark, op, value, want):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 3.0]), (3, [3.0, 3.0])], "id int, x array<double>")
    assert [r.id for r in df.where(predicate(F.col("x"), DType(1203, dimension=2), op, value)).orderBy("id").collect()] == want
    assert [r.id for r in df.where(predicate(F.col("x"), DType(1203, dimension=2), "in", [[1, 2], [3, 3]], "tuple")).orderBy("id").collect()] == [1, 3]


def test_ip_ranges(spark):
    df = spark.createDataFrame([("10.1.2.3",), ("10.200.0.1",), ("2001:db8::1",), ("no ip",), (None,), ("300.1.1.1",)], "ip string")
    hit = lambda *c: [r[0] for r in df.where(network.in_ranges(F.col("ip"), list(c))).collect()]
    assert hit("10.0.0.0/9") == ["10.1.2.3"]
    assert hit("10.0.0.0/8", "2001:db8::/32") == ["10.1.2.3", "10.200.0.1", "2001:db8::1"]
    assert df.where(predicate(F.col("ip"), TEXT, "not in ip ranges", ["10.0.0.0/8"])).count() == 4


def test_unsupported_types():
    for dtype, op in ((DType(1), "=="), (DType(1301, size=3, dimension=2), "=="), (LONG, "contain"), (TEXT, ">")):
        with pytest.raises(UnsupportedOperator):
            predicate(F.lit(1), dtype, op, 1)
    for bad in (dict(id=301), dict(id=1101), dict(id=999)):
        with pytest.raises(ValueError):
            DType(**bad)


def test_type_lattice():
    assert wider(101, 101) == 101 and wider(101, 103) == 103 and wider(101, 102) == 103 and wider(105, 106) == 107
    assert wider(107, 203) == 203 and wider(203, 301) == 301 and wider(102, 104) == 104


def test_parse_defaults(spark):
    df = spark.createDataFrame([("7",), (" 8 ",), ("x",), ("",), (None,), ("é ab cdé",)], "c string")
    got = lambda t: [r[0] for r in df.select(parse(F.col("c"), t)).collect()]
    assert got(LONG) == [7, 8, 0, 0, 0, 0]
    assert got(DOUBLE) == [7.0, 8.0, 0.0, 0.0, 0.0, 0.0]
    assert got(DType(301, size=4)) == ["7", "8", "x", "", "", "ab c"]
    assert got(DType(1)) == [True, True, True, False, False, True]
    assert got(DType(101))[0] == 7
    lists = spark.createDataFrame([([1],), (None,), ([1, 2, 3],)], "c array<int>")
    assert [r[0] for r in lists.select(parse(F.col("c"), DType(1105, dimension=2))).collect()] == [[1, 0], [0, 0], [1, 2]]


def test_aggregates(spark, log):
    out = stats(spark, log, group_by=("kind",), sort_by=(("n", "desc"), ("kind", "asc")), resultset=(("value", "count", "n"), ("value", "avg", "mean"), ("value", "min", None), ("value", "max", "top"), ("value", "sum", "s")))
    assert out.columns == ["kind", "n", "mean", "value-min", "top", "s"]
    assert [tuple(r) for r in out.collect()] == [("a", 2, 5.5, 1.0, 10.0, 11.0), ("b", 2, 0.5, -4.0, 5.0, 1.0), ("c", 1, 10.0, 10.0, 10.0, 10.0)]


def test_ungrouped_without_rows(spark, log):
    spec = dict(conditions=(("value", ">", 1000),), resultset=(("*", "count", "n"), ("value", "sum", "s"), ("value", "min", "m"), ("value", "avg", "a")))
    assert values(stats(spark, log, **spec)) == [(0, 0.0, None, 0.0)]
    assert values(stats(spark, log, **spec, options={"empty_minmax": "zero"})) == [(0, 0.0, 0.0, 0.0)]


def test_distinct(spark, log):
    assert values(stats(spark, log, resultset=(("user", "distinct", "d"), ("kind", "distinct", None), ("value", "sum", "s")))) == [(4, 22.0)]
    assert values(stats(spark, log, resultset=(("user", "distinct_exclude_null", "d"),))) == [(3,)]
    assert values(stats(spark, log, resultset=(("user", "distinct_exclude_null", "d"), ("kind", "distinct", None)))) == [(4,)]
    assert stats(spark, log, resultset=(("user", "distinct", None),)).columns == ["count(distinct user)"]


def test_having(spark, log):
    kw = dict(group_by=("kind",), resultset=(("*", "count", "n"), ("value", "avg", "m"), ("user", "distinct", "d")))
    assert values(stats(spark, log, having=(("n", ">", 1), ("unknown", "=", 5)), **kw)) == [("a", 1, 2, 5.5), ("b", 2, 2, 0.5)]
    assert values(stats(spark, log, having=(("distinct", "=", 2),), **kw)) == [("b", 2, 2, 0.5)]
    assert values(stats(spark, log, having=(("m", "between", [5, 10]),), **kw)) == [("a", 1, 2, 5.5)]


def test_physical_list(spark, log):
    final, raw = engine.run_statistics(spark, ReportSpec("r", "log", group_by=("kind",), resultset=(("value", "avg", "m"), ("value", "sum", "s"), ("user", "count", "n"), ("user", "count", "n2"))), SPEC, log)
    assert raw.columns == ["kind", "count", "value_sum"] and final.columns == ["kind", "m", "s", "n", "n2"]
    for r in final.collect():
        assert r.m * r.n == pytest.approx(r.s)


def test_buckets_and_zero_fill(spark, log):
    kw = dict(start=datetime(2024, 1, 1), end=datetime(2024, 1, 1, 3), rtype="Hourly", resultset=(("*", "count", "n"),))
    got = stats(spark, log, **kw).collect()
    assert [(r.request_time.hour, r.n) for r in got] == [(0, 2), (1, 1), (2, 2)]
    got = stats(spark, log, conditions=(("kind", "=", "b"),), **kw).collect()
    assert [(r.request_time.hour, r.n) for r in got] == [(0, 1), (1, 0), (2, 1)]
    assert stats(spark, log, group_by=("kind",), **kw).count() == 5
    total = sum(r.n for r in stats(spark, log, **kw).collect())
    assert values(stats(spark, log, resultset=(("*", "count", "n"),))) == [(total,)]
    label = stats(spark, log, rtype="Monthly", options={"bucket_mode": "label"}, resultset=(("*", "count", "n"),))
    assert values(label) == [("2024-01", 5)]


def test_every_interval_floors_alike(spark):
    times = [datetime(2023, 12, 28, 23, 59, 59) + timedelta(hours=17 * i, minutes=7 * i) for i in range(60)]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    for kind in INTERVALS:
        if kind.kind == "weeks" and kind.n > 1:
            start = kind.floor(times[0])
            want = [start + timedelta(days=(t - start).days // 28 * 28) for t in times]
        else:
            want = [kind.floor(t) for t in times]
        assert [r[0] for r in df.select(kind.column(F.col("ts"), times[0])).collect()] == want, kind.name


def test_interval_iteration():
    day, now = interval("Daily"), datetime(2024, 3, 5, 12)
    assert list(whole_intervals(day, datetime(2024, 3, 1), None, now))[-1] == (datetime(2024, 3, 4), datetime(2024, 3, 5))
    assert list(whole_intervals(day, None, None, now)) == [(datetime(2024, 3, 4), datetime(2024, 3, 5))]
    assert list(whole_intervals(day, None, None, now, timedelta(days=1))) == [(datetime(2024, 3, 3), datetime(2024, 3, 4))]
    assert list(whole_intervals(interval(601), datetime(2024, 1, 31), datetime(2024, 3, 1), now)) == [(datetime(2024, 1, 1), datetime(2024, 2, 1)), (datetime(2024, 2, 1), datetime(2024, 3, 1))]
    assert report_range(day, datetime(2024, 1, 1, 5), datetime(2024, 1, 2, 5), True) == (datetime(2024, 1, 1), datetime(2024, 1, 2))
    assert report_range(day, datetime(2024, 1, 1, 5), datetime(2024, 1, 2, 5), False)[1] == datetime(2024, 1, 3)
    with pytest.raises(ValueError):
        interval("Yearly")


def test_planner_rejects():
    spec = DatasetSpec("log", (*SPEC.columns, ColumnSpec("hidden", LONG, filterable=False)), data_interval="Daily", time_column="ts")
    for kw in (
        dict(rtype="Hourly", resultset=(("*", "count", "n"),)), dict(group_by=("value",), resultset=(("*", "count", "n"),)), dict(group_by=("user",), resultset=(("user", "sum", "s"),)),
        dict(resultset=(("kind", "sum", "s"),)), dict(resultset=(("value", "", "s"),)), dict(resultset=(("value", "median", "s"),)), dict(conditions=(("hidden", "=", 1),), resultset=(("*", "count", "n"),)),
    ):
        with pytest.raises((InvalidReport, UnsupportedOperator)):
            bind(ReportSpec("r", "log", **kw), spec)
    bind(ReportSpec("r", "log", conditions=(("hidden", "=", 1),), resultset=(("*", "count", "n"),), options={"strict": False}), spec)


def test_dictionary(spark):
    df = spark.createDataFrame([(1, " b"), (2, "a"), (3, None), (4, "bad!"), (5, "b")], "id int, word string")
    first, words = enums.encode(df.where("id < 3"), "w", "word", enums.empty(spark), F.col("word").rlike("^ ?[a-z]+$"), "none")
    assert {r.id: r.w for r in first.collect()} == {1: 2, 2: 1}
    more = spark.createDataFrame([(6, "aa")], "id int, word string").union(df)
    second, grown = enums.encode(more, "w", "word", words, F.col("word").rlike("^ ?[a-z]+$"), "none")
    assert {r.id: r.w for r in second.collect()} == {1: 2, 2: 1, 3: 0, 4: 0, 5: 2, 6: 3}
    assert enums.lookup(grown, "w", ["a", "zz"]) == {"a": 1} and sorted(r.id for r in enums.search(grown, "w", "a*").collect()) == [1, 3]
    back = enums.decode(second.withColumn("w", F.when(F.col("id") == 6, 99).otherwise(F.col("w"))), "w", grown)
    assert {r.id: r.w for r in back.collect()} == {1: "b", 2: "a", 3: "none", 4: "none", 5: "b", 6: "99"}


def test_invalid_keys_without_a_default_are_an_error(spark):
    df = spark.createDataFrame([("a",), (None,)], "word string")
    out, _ = enums.encode(df, "w", "word", enums.empty(spark))
    with pytest.raises(Exception, match="no valid key for w"):
        out.collect()


def test_unknown_labels(spark):
    df, words = enums.encode(spark.createDataFrame([("a",), ("b",)], "word string"), "w", "word", enums.empty(spark))
    spec = DatasetSpec("d", (ColumnSpec("w", LONG, enum="w", groupable=True),))
    n = lambda *c: engine.run_statistics(spark, ReportSpec("r", "d", conditions=(c,), resultset=(("*", "count", "n"),)), spec, df, words)[0].first().n
    assert (n("w", "=", "a"), n("w", "!=", "a"), n("w", "!=", "zz"), n("w", "in", '["a", "zz"]'), n("w", "in", ["zz"]), n("w", "pattern", "*"), n("w", "pattern", "z*")) == (1, 1, 0, 1, 0, 2, 0)


def test_domain_and_location(spark):
    rows = spark.createDataFrame([("x.org", 404), ("x.org", 200), ("y.org", 404), ("bad domain", 200)], "domain string, status int")
    out, _ = enums.domain2enum(rows, "d", "domain", F.col("status") == 404, r"^[a-z.]+$", enums.empty(spark))
    assert sorted(map(tuple, out.select("domain", "d").collect())) == [("bad domain", 0), ("x.org", 1), ("x.org", 1), ("y.org", 0)]
    ips = spark.createDataFrame([("1.2.3.4",), ("9.9.9.9",), ("",), (None,)], "ip string")
    ranges = spark.createDataFrame([(1 << 24, (2 << 24) - 1, "NEW zealand", "wellington")], "start_ip bigint, end_ip bigint, country string, city string")
    got = enums.locate(ips, F.col("ip"), ranges, ["country", "city"]).select("ip", enums.country_label(F.col("ip"), F.col("country")), enums.city_label(F.col("ip"), F.col("country"), F.col("city")))
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == {"1.2.3.4": ("New Zealand", "New Zealand Wellington"), "9.9.9.9": ("Internal", "Internal"), "": ("Unknown", "Unknown"), None: ("Unknown", "Unknown")}


def test_transformers(spark):
    df = spark.createDataFrame([("2024-05-06T07:08:09+0200", "12", "Mozilla Bot")], "t string, n string, agent string")
    one = lambda c: df.select(c).first()[0]
    unix = lambda cut: one(transforms.apply("str2unixtime", F.col("t"), pattern="%Y-%m-%dT%H:%M:%S%z", truncate_to=cut))
    assert unix(None) == 1714972089 and unix("hour") == 1714971600 and unix("day") == 1714953600 and unix("month") == 1714521600
    assert one(transforms.apply("str2datetime", F.lit("2024-01-01 00:00"), pattern="%Y-%m-%d %H:%M", srctimezone="UTC", targettimezone="Australia/Perth")) == datetime(2024, 1, 1, 8)
    assert one(transforms.apply("number2group", F.col("n"), rules=[("few", "<", 10), ("some", "between", [10, 20])], otherwise="many")) == "some"
    assert one(transforms.apply("number2group", F.lit("x"), rules=[("none", "null", None)], otherwise="many")) == "none"
    assert one(transforms.apply("str2group", F.col("agent"), rules=[("robot", "bot"), ("browser", "mozilla")])) == "robot"
    with pytest.raises(Exception, match="no group"):
        one(transforms.apply("str2group", F.col("agent"), rules=[("x", "zzz")]))
    key = transforms.apply("resourcekey", F.lit("d"), {"path": F.lit("/a%20b/c"), "q": F.lit("id=7&x=1")}, query="q", configs={"d": ("query", "id"), "e": ("path", 0)}, default="none")
    assert one(key) == "7"
    transforms.register("doubled", lambda v, times=2: v * times, "int")
    assert one(transforms.apply("doubled", F.lit(4))) == 8
    with pytest.raises(KeyError):
        transforms.apply("missing", F.lit(1))


def test_prepare(spark):
    raw = spark.createDataFrame([("A", "1"), ("b", "x"), ("noise", "3"), ("c", None)], "kind string, n string")
    transforms.register("shout", lambda c: F.upper(c))
    spec = DatasetSpec("d", (ColumnSpec("kind", TEXT, normalize="lower(kind)", exclude=("kind = 'noise'",)), ColumnSpec("loud", TEXT, source="kind", transformer=Transform("shout"), computed="new"), ColumnSpec("n", LONG)))
    assert values(prepare.prepare(raw, spec)) == [("a", "A", 1), ("b", "B", 0), ("c", "C", 0)]
    _, issues = prepare.with_issues(raw, spec)
    assert values(issues) == [("n", "x", "can't be read")]


def test_formats(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,"say ""hi"""\n\ny\n')
    assert [tuple(r) for r in readers.read_csv(spark, str(tmp_path / "a.csv"), ("p", "q")).collect()] == [("x", 'say "hi"'), ("y", None)]
    (tmp_path / "b.csv").write_text('1,"two\nlines, one ""cell"""\n2,z\n')
    assert values(readers.read_csv(spark, str(tmp_path / "b.csv"), ("p", "q"))) == [("1", 'two\nlines, one "cell"'), ("2", "z")]
    (tmp_path / "a.jsonl").write_text('{"q": "2", "p": "1"}\n{"p": "3"}\n')
    out = readers.read_jsonline(spark, str(tmp_path / "a.jsonl"))
    assert out.columns == ["p", "q"] and [tuple(r) for r in out.collect()] == [("1", "2"), ("3", None)]
    df = spark.createDataFrame([("1", None), ("3", "4")], "p string, q string")
    store.write_jsonlistline(df, str(tmp_path / "lists"))
    back = readers.read_jsonlistline(spark, str(tmp_path / "lists"))
    assert back.columns == ["p", "q"] and values(back.fillna("")) == [("1", ""), ("3", "4")]
    (tmp_path / "heads").mkdir()
    for i in range(3):  # a row like the header stays, each file's first line goes
        (tmp_path / "heads" / f"{i}.jsonl").write_text('["p", "q"]\n["p", "q"]\n["%d"]\n' % i)
    assert values(readers.read_jsonlistline(spark, str(tmp_path / "heads")).fillna("")) == [("0", ""), ("1", ""), ("2", ""), *[("p", "q")] * 3]
    store.write_csv(df, str(tmp_path / "one.csv"), single=True)
    assert (tmp_path / "one.csv").read_text().splitlines()[0] == "p,q" and len((tmp_path / "one.csv").read_text().splitlines()) == 3
    timed = spark.sql("select timestamp_ntz'2024-01-02 03:04:05' t, date'2024-01-02' d, interval '1' day i, 1.5 x")
    store.write_jsonline(timed, str(tmp_path / "timed"))
    assert readers.read_jsonline(spark, str(tmp_path / "timed"), ("t", "d", "x")).first() == ("2024-01-02T03:04:05", "2024-01-02", "1.5")
    store.write_jsonline(df, str(tmp_path / "objects"))
    assert values(readers.read_jsonline(spark, str(tmp_path / "objects"), ("p", "q")).fillna("")) == [("1", ""), ("3", "4")]


def test_audit_records(spark):
    record = '{"id": "1", "category": "c", "initiatedBy": {"app": {"displayName": "job"}, "user": null}, "additionalDetails": [{"key": "k", "value": "v"}, {"key": "odd", "value": "w"}], "targetResources": [{"type": "User", "id": "u", "modifiedProperties": [{"displayName": "n", "oldValue": "1", "newValue": "2"}]}]}'
    out, names = audit.flatten(spark.createDataFrame([(record,)], "value string"), known=("id", "category", "additionalDetails.k"))
    r = out.first()
    assert r["id"] == "1" and r["initiatedBy.app.displayName"] == "job" and r["additionalDetails.odd"] == "w" and r["targetResource.User.id"] == "u"
    assert r["targetResource.User.modifiedProperties"] == "(n.old=1,n.new=2)" and names[:3] == ("id", "category", "additionalDetails.k")


def test_download_and_report(spark, tmp_path):
    home = tmp_path / "logs"
    home.mkdir()
    for h in (0, 1):
        (home / f"20240101{h:02d}.csv").write_text("".join(f"u{i % 2},{i}\n" for i in range(4 + h)))
    spec = DatasetSpec("web", (ColumnSpec("who", TEXT, groupable=True), ColumnSpec("n", LONG, statistical=True)), header=("who", "n"), ignore_missing_datafile=True, cache_timeout=1)
    origin = readers.source("localfs", home=str(home))
    missing = store.download(spark, spec, origin, str(tmp_path / "table"), datetime(2024, 1, 1), datetime(2024, 1, 1, 3))
    assert missing == ["2024010102.csv"]
    table = store.load(spark, str(tmp_path / "table"))
    catalog = store.Catalog(datasets={"web": spec})
    report = ReportSpec("by who", "web", rtype="Hourly", group_by=("who",), resultset=(("n", "sum", "total"),), id=7)
    status = store.run_report(spark, catalog, report, table, str(tmp_path / "out"), missing=missing)
    assert status["status"] == "Succeed" and "2024010102.csv" in status["message"] and status["file"].endswith("by_who-7-all-all-Hourly.csv")
    assert [tuple(r) for r in spark.read.csv(status["file"], header=True).orderBy("request_time", "who").select("who", "total").collect()] == [("u0", "2"), ("u1", "4"), ("u0", "6"), ("u1", "4")]
    assert store.run_report(spark, catalog, report, table, "/nowhere") is status
    details = store.run_report(spark, catalog, ReportSpec("rows", "web", conditions=(("n", ">", 2),), raw_conditions=(("who", "=", "u1"),), id=8), table, str(tmp_path / "out"))
    assert spark.read.csv(details["file"], header=True).count() == 2
    failed = store.run_report(spark, catalog, ReportSpec("bad", "web", resultset=(("who", "sum", "x"),), id=9), table, str(tmp_path / "out"))
    assert failed["status"] == "Failed" and failed["message"]
    with pytest.raises(readers.ResourceNotFound):
        origin.read(spark, DatasetSpec("web", spec.columns, header=("who", "n")), [(datetime(2024, 1, 1), datetime(2024, 1, 2), "none.csv")])


def hourly_files(home, hours):
    home.mkdir(exist_ok=True)
    for h in hours:
        (home / f"20240101{h:02d}.csv").write_text("".join(f"u{i % 2},{i}\n" for i in range(4 + h)))


WEB = DatasetSpec("web", (ColumnSpec("who", TEXT, groupable=True), ColumnSpec("n", LONG, statistical=True)), header=("who", "n"), ignore_missing_datafile=True)


def test_hours_of_a_day_stay_when_others_come(spark, tmp_path):
    """One by one, repeated and out of order is the same as one download of the range."""
    hourly_files(tmp_path / "logs", range(4))
    origin, day = readers.source("localfs", home=str(tmp_path / "logs")), datetime(2024, 1, 1)
    for h in (2, 0, 3, 0, 1):
        store.download(spark, WEB, origin, str(tmp_path / "parts"), day + timedelta(hours=h), day + timedelta(hours=h + 1))
    store.download(spark, WEB, origin, str(tmp_path / "whole"), day, day + timedelta(hours=4))
    own = lambda at: values(store.load(spark, str(tmp_path / at)).select("interval_start", "who", "n"))
    assert own("parts") == own("whole") and len(own("parts")) == 4 + 5 + 6 + 7
    # An hour whose file has become empty has no rows any more.
    (tmp_path / "logs" / "2024010102.csv").write_text("")
    store.download(spark, WEB, origin, str(tmp_path / "parts"), day + timedelta(hours=2), day + timedelta(hours=3))
    assert len(own("parts")) == 4 + 5 + 7


def test_stale_intervals_are_made_again(spark, tmp_path):
    hourly_files(tmp_path / "logs", range(3))
    origin, day, at = readers.source("localfs", home=str(tmp_path / "logs")), datetime(2024, 1, 1), str(tmp_path / "table")
    store.download(spark, WEB, origin, at, day, day + timedelta(hours=2))
    files = readers.interval_files(WEB, day, day + timedelta(hours=3))
    assert store.stale(spark, at, files, None) == files[2:]
    assert store.stale(spark, at, files, datetime.now() + timedelta(hours=1)) == files
    (tmp_path / "logs" / "2024010100.csv").write_text("new,100\n")
    store.download(spark, WEB, origin, at, day, day + timedelta(hours=3), only_stale=True)
    assert "new" not in {r.who for r in store.load(spark, at).collect()} and store.load(spark, at).count() == 4 + 5 + 6
    store.download(spark, WEB, origin, at, day, day + timedelta(hours=3), requested=datetime.now() + timedelta(hours=1), only_stale=True)
    assert "new" in {r.who for r in store.load(spark, at).collect()} and store.load(spark, at).count() == 1 + 5 + 6


def test_eviction_deletes_old_days(spark, tmp_path):
    rows = spark.createDataFrame([("a", "1", datetime(2024, 1, d), 0) for d in range(1, 6)], "who string, n string, interval_start timestamp_ntz, row_no bigint")
    store.materialise(rows, WEB, str(tmp_path / "t"))
    before = store.load(spark, str(tmp_path / "t"))
    assert store.evict(spark, str(tmp_path / "t"), 2) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert store.load(spark, str(tmp_path / "t")).count() == 2 and before.count() == 5  # who reads the table as it was goes on
    store.materialise(rows.where("day(interval_start) = 5"), WEB, str(tmp_path / "t"))
    assert store.load(spark, str(tmp_path / "t")).count() == 2 and not list((tmp_path / "t").glob("data-*/day=2024-01-02"))


def test_many_files_are_one_scan(spark, tmp_path):
    hourly_files(tmp_path / "logs", range(12))
    origin, day = readers.source("localfs", home=str(tmp_path / "logs")), datetime(2024, 1, 1)
    rows, missing = origin.read(spark, WEB, readers.interval_files(WEB, day, day + timedelta(hours=13)))
    assert missing == ["2024010112.csv"] and rows._jdf.queryExecution().optimizedPlan().toString().count("Relation ") == 1
    assert {r.interval_start.hour: r["count"] for r in rows.groupBy("interval_start").count().collect()} == {h: 4 + h for h in range(12)}


def test_catalogue_comes_back_from_its_file(spark, tmp_path):
    column = ColumnSpec("v", DType(1203, dimension=2), source="raw", transformer=Transform("str2unixtime", {"pattern": "%Y"}), include=("v > 1",), groupable=True)
    spec = DatasetSpec("d", (column, *SPEC.columns), header=("a", "b"))
    report = ReportSpec("r", "d", datetime(2024, 1, 1), None, "Daily", conditions=(("user", "in", (1, 2)),), group_by=("kind",), sort_by=(("kind", "asc"),), resultset=(("*", "count", None),), id=3, options={"limit": 5})
    catalog = store.Catalog({"d": spec}, {3: report}, {9: (3, datetime(2024, 1, 1), datetime(2024, 1, 8))}, {3: {"status": "Succeed", "size": 4}})
    catalog.save(spark, str(tmp_path / "c.json"))
    back = store.Catalog.load(spark, str(tmp_path / "c.json"))
    assert back.datasets == catalog.datasets and back.instances == catalog.instances and back.status == catalog.status
    assert back.instance(9) == catalog.instance(9).__class__(**{**catalog.instance(9).__dict__, "conditions": (("user", "in", [1, 2]),)})


def test_ipv6_in_the_jvm(spark):
    import ipaddress

    texts = ["2001:db8::1", "2001:DB8:0:0::ff", "::", "::1", "1::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::ffff:10.1.2.3", "fe80::1:2", "1:2:3", "1::2::3", ":::", ":1::2", "12345::", "g::", "1:2:3:4:5:6:7:8:9", "10.1.2.3", "::10.1.2.300", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, ip string")
    got = {r.i: r.d for r in df.select("i", network.ipv6_digits(F.col("ip")).alias("d")).collect()}
    for i, t in enumerate(texts):
        try:
            want = f"{int(ipaddress.IPv6Address(t)):032x}"
        except (ValueError, TypeError):
            want = None
        assert got[i] == want, (t, got[i], want)
    plan = df.where(network.in_ranges(F.col("ip"), ["2001:db8::/32"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_literals(spark):
    df = spark.createDataFrame([("[error] x",), ("{id}",), ('"q"',), ("[1, 2]",)], "kind string")
    n = lambda *c: stats(spark, df.selectExpr("1L as user", "kind", "1.0D as value", "timestamp_ntz'2024-01-01' as ts"), conditions=(c,), resultset=(("*", "count", "n"),)).first().n
    assert n("kind", "startswith", "[error") == 1 and n("kind", "==", "{id}") == 1 and n("kind", "==", "[1, 2]") == 1 and n("kind", "in", '["{id}", "[1, 2]"]') == 2
    assert n("kind", "==", '"{id}"') == 1 and n("kind", "mcontain", "[bad json") == 0


def test_pattern_is_a_semi_join(spark):
    df, words = enums.encode(spark.createDataFrame([("a",), ("b",)], "word string"), "w", "word", enums.empty(spark))
    spec = DatasetSpec("d", (ColumnSpec("w", LONG, enum="w"),))
    out = engine.run_statistics(spark, ReportSpec("r", "d", conditions=(("w", "pattern", "a*"),), resultset=(("*", "count", "n"),)), spec, df, words)[0]
    assert "LeftSemi" in out._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def audit_service():
    """A paged service: three records a page, newest first on /desc, and a token for one client."""
    import json
    import threading
    import urllib.parse
    from http.server import BaseHTTPRequestHandler, HTTPServer

    records = [{"id": str(i), "activityDateTime": f"2024-01-01T{i:02d}:30:00Z"} for i in range(10)]
    seen, failed, asked = [], [], []

    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *a):
            pass

        def close_connection_now(self):
            self.connection.close()

        def answer(self, code, body):
            self.send_response(code)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def do_POST(self):
            form = urllib.parse.parse_qs(self.rfile.read(int(self.headers["Content-Length"])).decode())
            ok = form == {"grant_type": ["client_credentials"], "client_id": ["me"], "client_secret": ["key"], "scope": ["all"]}
            self.answer(200 if ok else 401, {"access_token": "t0"} if ok else {})

        def do_GET(self):
            url = urllib.parse.urlparse(self.path)
            query = urllib.parse.parse_qs(url.query)
            seen.append(self.headers.get("Authorization"))
            if seen[-1] != "Bearer t0":
                return self.answer(401, {})
            if url.path == "/shaky" and self.path not in failed:  # each page fails once
                failed.append(self.path)
                return self.answer(503, {}) if len(failed) % 2 else self.close_connection_now()
            asked.append(self.path)
            low, high = query["$filter"][0].replace("Z", "").split(" and ")
            own = [r for r in records if low.split()[-1] <= r["activityDateTime"] < high.split()[-1]]
            own = own[::-1] if url.path == "/desc" else own
            at = int(query.get("at", ["0"])[0])
            page = {"value": own[at : at + 3]}
            if at + 3 < len(own):
                page["@odata.nextLink"] = f"http://127.0.0.1:{self.server.server_port}{url.path}?{urllib.parse.urlencode({'$filter': query['$filter'][0], 'at': at + 3})}"
            return self.answer(200, page)

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", asked
    server.shutdown()


def test_audit_service(spark, audit_service):
    url, _ = audit_service
    spark.dataSource.register(audit.AuditLog)
    base = {"start": "2024-01-01T00:00:00", "end": "2024-01-01T09:00:00"}
    own = {"tokenurl": f"{url}/token", "clientid": "me", "clientsecret": "key", "scope": "all"}
    for path, more in (("asc", own), ("desc", {**own, "ascending": "false"}), ("asc", {"token": "t0"}), ("asc", {**own, "slices": "3"})):
        rows = audit.in_order(spark.read.format("auditlog").options(url=f"{url}/{path}", **base, **more).load()).collect()
        assert [r.time[11:13] for r in rows] == [f"{h:02d}" for h in range(9)]
    with pytest.raises(Exception, match="401"):
        spark.read.format("auditlog").options(url=f"{url}/asc", **base, token="wrong").load().collect()


def test_a_page_that_fails_is_asked_for_again(spark, audit_service):
    url, asked = audit_service
    spark.dataSource.register(audit.AuditLog)
    options = {"url": f"{url}/shaky", "token": "t0", "start": "2024-01-01T00:00:00", "end": "2024-01-01T10:00:00", "wait": "0.01"}
    rows = spark.read.format("auditlog").options(**options).load().collect()
    assert [r.time[11:13] for r in rows] == [f"{h:02d}" for h in range(10)] and len(asked) == len(set(asked)) == 4  # no page twice
    with pytest.raises(Exception, match="503|closed|reset|refused"):
        spark.read.format("auditlog").options(**{**options, "end": "2024-01-01T09:00:00"}, retries="0").load().collect()


def test_audit_stream_goes_on_where_it_was(spark, audit_service, tmp_path):
    url, asked = audit_service
    spark.dataSource.register(audit.AuditLog)

    def run(end):
        stream = spark.readStream.format("auditlog").options(url=f"{url}/shaky", token="t0", start="2024-01-01T00:00:00", end=end, slices="2", wait="0.01").load()
        query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "marks")).start(str(tmp_path / "out"))
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return sorted(r.time[11:13] for r in spark.read.schema("time string, value string").parquet(str(tmp_path / "out")).collect())

    assert run("2024-01-01T04:00:00") == [f"{h:02d}" for h in range(4)]
    before = len(asked)
    assert run("2024-01-01T04:00:00") == [f"{h:02d}" for h in range(4)] and len(asked) == before
    assert run("2024-01-01T10:00:00") == [f"{h:02d}" for h in range(10)]
    assert all("04%3A00%3A00" in a or "07%3A00%3A00" in a for a in asked[before:])  # only what is new


def test_too_many_names_are_an_error(spark):
    record = '{"additionalDetails": [{"key": "a", "value": "1"}, {"key": "b", "value": "2"}]}'
    with pytest.raises(ValueError, match="more than 5 names"):
        audit.flatten(spark.createDataFrame([(record,)], "value string"), most=5)


def test_late_rows_are_dropped_by_the_watermark(spark, tmp_path):
    schema, home = "ts timestamp, user bigint, kind string, value double", str(tmp_path / "in")
    put = lambda *rows: spark.createDataFrame([(datetime(2024, 1, 1, h, m), 1, k, 1.0) for h, m, k in rows], schema).coalesce(1).write.mode("append").parquet(home)
    put((0, 5, "a"), (1, 0, "a"), (3, 0, "a"))
    out = stream_statistics(ReportSpec("r", "log", rtype="Hourly", group_by=("kind",), resultset=(("*", "count", "n"),)), SPEC, spark.readStream.schema(schema).parquet(home), late="30 minutes")

    def run():
        out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", str(tmp_path / "marks")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
        return sorted((r.request_time.hour, r["count"]) for r in spark.read.schema(out.schema).parquet(str(tmp_path / "out")).collect())

    assert run() == [(0, 1), (1, 1)]  # the watermark is 02:30
    put((0, 50, "a"), (2, 10, "a"), (2, 40, "a"), (5, 0, "a"))  # too late, still in its bucket's time, in time, later
    assert run() == [(0, 1), (1, 1), (2, 2), (3, 1)]


def test_stream(spark, log, tmp_path):
    log.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, user bigint, kind string, value double").parquet(str(tmp_path / "in"))
    out = stream_statistics(ReportSpec("r", "log", rtype="Hourly", group_by=("kind",), resultset=(("value", "sum", "s"), ("*", "count", "n"))), SPEC, stream)
    q = out.writeStream.format("memory").queryName("stream_out").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.request_time.hour, r.kind, r["count"], r.value_sum) for r in spark.table("stream_out").collect()) == [(0, "a", 1, 1.0), (0, "b", 1, 5.0), (1, "c", 1, 10.0), (2, "a", 1, 10.0), (2, "b", 1, -4.0)]


def test_pushdown(spark, tmp_path):
    spark.range(100).selectExpr("id as user", "cast(id as double) value", "'x' kind", "timestamp_ntz'2024-01-01' ts").write.parquet(str(tmp_path / "t"))
    out = stats(spark, spark.read.parquet(str(tmp_path / "t")), conditions=(("user", ">", 50),), resultset=(("value", "sum", "s"),))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(user,50)" in plan and "kind" not in plan.split("ReadSchema")[1]
