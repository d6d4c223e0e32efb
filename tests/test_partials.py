"""Reports from stored states equal reports over the rows, and read no rows."""

from datetime import datetime, timedelta

import pytest

from quarrymill.functions.types import DType
from quarrymill.operators import dictionary as enums
from quarrymill.plans import engine, partials
from quarrymill.plans.planner import InvalidReport
from quarrymill.plans.spec import ColumnSpec, DatasetSpec, ReportSpec
from quarrymill.sources import commits, store

DAY = datetime(2024, 1, 1)
USES = {"statistical": True, "groupable": True, "distinctable": True}
SPEC = DatasetSpec(
    "log", (ColumnSpec("who", DType(107), **USES), ColumnSpec("kind", DType(301, size=9), groupable=True, distinctable=True), ColumnSpec("n", DType(107), **USES), ColumnSpec("w", DType(107), groupable=True, distinctable=True, enum="w")),
    data_interval="Daily", header=("who", "kind", "n", "w"), time_column="interval_start",
)


def rows(spark, days, seed=0):
    data = [(str((i * 7 + d + seed) % 5), "abc"[(i + d) % 3] if i % 4 else "", str((i * d) % 11 - 3), str(i % 3), DAY + timedelta(days=d), i) for d in days for i in range(12 + d % 5)]
    return spark.createDataFrame(data, "who string, kind string, n string, w string, interval_start timestamp_ntz, row_no bigint")


REPORTS = {
    "weeks": {"rtype": "MondayBasedWeekly", "group_by": ("kind",), "resultset": (("*", "count", "c"), ("n", "sum", "s"), ("n", "avg", "a"), ("n", "min", "lo"), ("n", "max", "hi"))},
    "months": {"rtype": "Monthly", "group_by": ("kind",), "resultset": (("who", "distinct", "users"), ("n", "sum", "s"))},
    "tuples": {"rtype": "SaturdayBasedWeekly", "resultset": (("who", "distinct_exclude_null", "pairs"), ("kind", "distinct_exclude_null", None), ("*", "count", "c"))},
    "key in tuple": {"group_by": ("kind",), "resultset": (("kind", "distinct", "pairs"), ("who", "distinct", None))},
    "all": {"conditions": (("n", ">", 0),), "resultset": (("n", "sum", "s"), ("n", "max", "hi"), ("*", "count", "c"))},
    "none": {"conditions": (("n", ">", 1000),), "resultset": (("n", "sum", "s"), ("n", "max", "hi"), ("*", "count", "c"))},
    "four weeks": {"rtype": "SundayBasedFourWeekly", "resultset": (("*", "count", "c"),), "having": (("c", ">", 3),)},
    "days": {"rtype": "Daily", "resultset": (("*", "count", "c"), ("n", "sum", "s"))},
    "labels": {"conditions": (("w", "pattern", "l*"), ("w", "!=", "l1")), "group_by": ("w",), "sort_by": (("w", "desc"),), "resultset": (("*", "count", "c"),)},
}
RANGE = {"start": DAY + timedelta(days=2), "end": DAY + timedelta(days=66)}


def got(df):
    return df.dtypes, sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame([("w", "l0", 0, None), ("w", "l1", 1, None), ("w", "m2", 2, None)], enums.SCHEMA)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("typed"))
    store.materialise(rows(spark, range(70)), SPEC, at, [DAY + timedelta(days=d) for d in range(75)])  # the last five are empty
    return at


@pytest.mark.parametrize("name", REPORTS)
def test_equal_to_the_direct_report(spark, table, words, tmp_path, name):
    for times in (RANGE, {}):
        if not times and name == "four weeks":
            continue  # counts from the range's start
        spec = ReportSpec("r", "log", **REPORTS[name], **times)
        final, raw = partials.run_statistics(spark, spec, SPEC, table, str(tmp_path), words)
        want = engine.run_statistics(spark, spec, SPEC, store.load(spark, table), words)
        assert got(final) == got(want[0]) and got(raw) == got(want[1])
        assert bool(raw.inputFiles()) == (name != "none") and all(str(tmp_path) in f for f in raw.inputFiles())  # states only


def test_states_are_shared_and_made_once(spark, table, tmp_path, monkeypatch):
    """Another range, type, filter and order is the same kind; only days that no report has asked for are made."""
    made, write = [], commits.write
    monkeypatch.setattr(commits, "write", lambda df, at, days, of: made.append(len(days)) or write(df, at, days, of))
    run = lambda **kw: partials.run_statistics(spark, ReportSpec("r", "log", group_by=("kind",), resultset=(("n", "sum", "s"),), **kw), SPEC, table, str(tmp_path))[0].count()
    run(rtype="MondayBasedWeekly", start=DAY, end=DAY + timedelta(days=14))
    run(rtype="Daily", start=DAY + timedelta(days=3), end=DAY + timedelta(days=9), having=(("s", ">", 1),))
    run(rtype="Monthly", start=DAY, end=DAY + timedelta(days=31), sort_by=(("kind", "desc"),))
    run(conditions=(("who", "=", 1),), start=DAY, end=DAY + timedelta(days=2))
    assert made == [14, 17, 2]


def test_a_late_day_is_made_again_alone(spark, tmp_path):
    at, root, spec = str(tmp_path / "typed"), str(tmp_path / "states"), ReportSpec("r", "log", rtype="Monthly", group_by=("kind",), resultset=(("n", "sum", "s"), ("who", "distinct", "u")))
    store.materialise(rows(spark, range(40)), SPEC, at)
    partials.run_statistics(spark, spec, SPEC, at, root)
    place = next((tmp_path / "states").iterdir())
    before = commits.latest(spark, str(place)).intervals
    store.materialise(rows(spark, [33, 41], seed=3), SPEC, at)
    final, _ = partials.run_statistics(spark, spec, SPEC, at, root)
    after = commits.latest(spark, str(place)).intervals
    assert {s for s in after if before.get(s) != after[s]} == {"t202402030000", "t202402110000"}
    assert got(final) == got(engine.run_statistics(spark, spec, SPEC, store.load(spark, at))[0])
    # A day that retention took is in no report, whatever states there are.
    store.evict(spark, at, 10)
    final, _ = partials.run_statistics(spark, spec, SPEC, at, root)
    assert got(final) == got(engine.run_statistics(spark, spec, SPEC, store.load(spark, at))[0])


def test_a_label_that_the_dictionary_gets_later(spark, table, words, tmp_path):
    spec = ReportSpec("r", "log", conditions=(("w", "in", ["m2", "later"]),), resultset=(("*", "count", "c"),))
    n = lambda w: partials.run_statistics(spark, spec, SPEC, table, str(tmp_path), w)[0].first().c
    more = words.where("id <> 1").union(spark.createDataFrame([("w", "later", 1, None)], enums.SCHEMA))
    rows_ = store.load(spark, table)
    assert (n(words), n(more)) == (rows_.where("w = 2").count(), rows_.where("w in (1, 2)").count())


def test_other_times_are_refused(spark, table, tmp_path):
    other = DatasetSpec(**{**SPEC.__dict__, "time_column": "ts"})
    with pytest.raises(InvalidReport, match="states are by"):
        partials.run_statistics(spark, ReportSpec("r", "log", resultset=(("*", "count", "c"),)), other, table, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        partials.run_statistics(spark, ReportSpec("r", "log", resultset=(("*", "count", "c"),)), SPEC, str(tmp_path / "none"), str(tmp_path))
