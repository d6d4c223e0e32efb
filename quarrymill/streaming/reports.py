"""The same aggregates on a stream: event-time buckets with a watermark for late rows.

Counts, sums and extremes by buckets of a fixed length are one windowed aggregation. Distinct tuples take two: the first keeps a state for each bucket, key and tuple,
the second counts the tuples that a closed bucket had; both are Spark's own. Months have no fixed length: days are aggregated as above, and closed
days are aggregated again by a span of their month, which has the mark of the days' event time, so that it is closed when the watermark passes the month's end. Each
state is of one tuple (of one key, without distinct counts), so that no task holds a month's tuples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.operators.intervals import UTC
from quarrymill.plans import engine
from quarrymill.plans.planner import BUCKET, BoundReport, bind
from quarrymill.plans.spec import DatasetSpec, ReportSpec

#: Spans that a tumbling window has; calendar months have none.
SPANS = {"minutes": "minutes", "hours": "hours", "days": "days", "weeks": "weeks"}
#: States of a stream by months are kept in this store, on disk, since a month's tuples may exceed the memory; it must be the session's.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def _window(bound: BoundReport) -> Column:
    kind, time = bound.rtype, bound.dataset.time_column
    if kind.kind == "months":
        return F.window(time, "1 day")
    # Windows count from Thursday 1970-01-01; Monday is four days later.
    span = f"{kind.n} {SPANS[kind.kind]}"
    return F.window(time, span, startTime=f"{(4 + kind.first_day) % 7} days") if kind.kind == "weeks" else F.window(time, span)


def stream_statistics(spec: ReportSpec, dataset: DatasetSpec, stream: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Raw aggregates by bucket and keys; a bucket is final once the watermark has passed its end.

    Distinct counts and months end in append mode only; months need the session's state store to be ``STORE``.
    """
    bound = bind(spec, dataset)
    if bound.rtype is None:
        raise ValueError("a stream needs a report type")
    if dataset.timezone != UTC:
        raise ValueError("a stream's windows are of UTC")
    if stream.schema[dataset.time_column].dataType.typeName() == "timestamp_ntz":  # watermarks are of instants
        stream = stream.withColumn(dataset.time_column, F.col(dataset.time_column).cast("timestamp"))
    rows = engine.selected(bound, stream.withWatermark(dataset.time_column, late))
    span, keys, months = _window(bound), [c.name for c in bound.keys], bound.rtype.kind == "months"
    own = [F.col(f"`{k}`") for k in keys]
    if not bound.distinct and not months:
        return rows.groupBy(span, *own).agg(*engine.physical_columns(bound)).withColumn(BUCKET, F.col("window.start")).drop("window")
    tuples = [n for n, _ in bound.distinct if n not in keys]
    plain = engine.physical_columns(BoundReport(**{**bound.__dict__, "distinct": []})) or [F.count(F.lit(1)).alias("_rows")]
    first = rows.groupBy(span, *own, *(F.col(f"`{t}`") for t in tuples)).agg(*plain)
    names = [(engine.physical_name(n, a), a) for n, a in bound.physical]
    merged = [_MERGE[a](F.col(f"`{n}`")).cast(first.schema[n].dataType).alias(n) for n, a in names]
    if months:
        _check_store(stream)
        first = first.select(_month(first), *(F.col(f"`{c}`") for c in first.columns if c != "window"))
        if bound.distinct:
            first = first.groupBy("window", *own, *(F.col(f"`{t}`") for t in tuples)).agg(*(merged or [F.count(F.lit(1)).alias("_rows")]))
    count = [F.count(F.when(engine.counted(bound), True)).alias("distinct")] if bound.distinct else []  # each tuple is a row
    return first.groupBy("window", *own).agg(*count, *merged).withColumn(BUCKET, F.col("window.start")).drop("window")


def _check_store(stream: DataFrame) -> None:
    if stream.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass", "") != STORE:
        raise ValueError(f"set spark.sql.streaming.stateStore.providerClass to {STORE}")


def _month(days: DataFrame) -> Column:
    """The span of each day's month, as a window of the same event time."""
    start = F.date_trunc("month", F.col("window.start"))
    end = start + F.make_ym_interval(months=F.lit(1))
    return F.struct(start.alias("start"), end.alias("end")).alias("window", metadata=days.schema["window"].metadata)
