"""What the driver decides of specifications: refusals, names, intervals."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quarrymill.functions import transforms
from quarrymill.functions.types import DType
from quarrymill.operators.intervals import interval, report_range, whole_intervals
from quarrymill.operators.predicates import UnsupportedOperator, predicate
from quarrymill.plans.catalogue import END, EVENTS, LONG, START
from quarrymill.plans.planner import InvalidReport, bind
from quarrymill.plans.spec import ColumnSpec, DatasetSpec, ReportSpec
from quarrymill.sources import audit, readers, store

_N = (("*", "count", "n"),)
HOURLY = DatasetSpec("events", (*EVENTS.columns, ColumnSpec("hidden", LONG, filterable=False)), time_column="ts")


@pytest.mark.parametrize("error,report", [
    (InvalidReport, {"resultset": (("value", "median", None),)}), (InvalidReport, {"group_by": ("user_id",), "resultset": (("user_id", "max", None),)}), (InvalidReport, {"resultset": (("value", None, None),)}),
    (UnsupportedOperator, {"resultset": (("event_type", "sum", None),)}), (InvalidReport, {"group_by": ("value",), "resultset": _N}), (InvalidReport, {"conditions": (("hidden", "==", 1),), "resultset": _N}),
    (KeyError, {"group_by": ("nothing",), "resultset": _N}), (InvalidReport, {"rtype": "Minutely", "resultset": _N}), (InvalidReport, {"start": END, "end": START, "rtype": "Daily", "resultset": _N}), (ValueError, {"rtype": "Yearly", "resultset": _N}),
])
def test_refused_reports(spark, error, report):
    with pytest.raises((error, InvalidReport) if error is UnsupportedOperator else error):
        bind(ReportSpec("q", "events", **report), HOURLY)
    bind(ReportSpec("q", "events", resultset=_N), HOURLY)


@pytest.mark.parametrize("kind,op,value", [(DType(1301, size=5, dimension=2), "==", ["a", "b"]), (DType(1), "==", True), (DType(1001, dimension=2), "in", [True]), (LONG, "contain", 1)])
def test_refused_conditions(spark, kind, op, value):
    with pytest.raises(UnsupportedOperator):
        predicate(F.col("x"), kind, op, value)


def test_refused_types_and_functions(spark):
    for kind in (1101, 301):  # a list without dimension, a text without size
        with pytest.raises(ValueError):
            DType(kind)
    for name, f in (("f0", lambda: None), ("f2", lambda a, b: a)):
        with pytest.raises(ValueError):
            transforms.register(name, f)
    with pytest.raises(ValueError):
        transforms.apply("urldecode", F.col("x"), depth=2)
    with pytest.raises(KeyError):
        transforms.apply("no such", F.col("x"))
    transforms.register("f1", lambda a, b=1: a)


def test_names_and_places():
    report = ReportSpec("by type", "e", START, END, "Daily", resultset=_N, id=4)
    assert store.report_filename(report) == "by_type-4-202401010000-202401310000-Daily.csv" and store.report_filename(report, raw=True).endswith("-Daily-raw.csv")
    assert store.report_filename(ReportSpec("some rows", "e", id=5)) == "5-some_rows-all-all.csv"
    blob = readers.source("blobstorage", container="logs", account="store", home="web")
    assert blob.path("2024.csv") == "abfss://logs@store.dfs.core.windows.net/web/2024.csv" and not blob.is_local
    slices = [p.value for p in audit.AuditPages({"start": "2024-01-01", "end": "2024-01-01T12:00:00", "slices": "2"}).partitions()]
    assert slices == [("2024-01-01T00:00:00", "2024-01-01T06:00:00"), ("2024-01-01T06:00:00", "2024-01-01T12:00:00")]


@pytest.mark.parametrize("kind,low,high", [("Hourly", "2024-03-05 09:00", "2024-03-05 10:00"), ("Daily", "2024-03-04 00:00", "2024-03-05 00:00"), ("SundayBasedWeekly", "2024-02-25 00:00", "2024-03-03 00:00"), ("Monthly", "2024-02-01 00:00", "2024-03-01 00:00")])
def test_default_start(kind, low, high):
    got = list(whole_intervals(interval(kind), None, None, datetime(2024, 3, 5, 10, 17)))
    assert [(f"{a:%Y-%m-%d %H:%M}", f"{b:%Y-%m-%d %H:%M}") for a, b in got] == [(low, high)]


@pytest.mark.parametrize("kind,periodic,low,high", [("Daily", True, "2024-01-30", "2024-04-02"), ("Daily", False, "2024-01-30", "2024-04-03"), ("Monthly", True, "2024-01-01", "2024-04-01"), ("Monthly", False, "2024-01-01", "2024-05-01"), ("MondayBasedWeekly", False, "2024-01-29", "2024-04-08")])
def test_report_ranges(kind, periodic, low, high):
    assert [f"{t:%Y-%m-%d}" for t in report_range(interval(kind), datetime(2024, 1, 30, 5, 10), datetime(2024, 4, 2, 7, 45), periodic)] == [low, high]
