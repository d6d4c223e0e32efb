"""Stored partial aggregates of statistics reports, by interval of the data.

The first report of a kind (its conditions, keys, physical aggregates and distinct tuples) reads the typed table and keeps, for each of the data's intervals,
the state of every key: counts, sums, extremes, and each distinct tuple as a row. Every later report of that kind, of an equal or coarser type and any
range, merges these states and reads no rows of the data. Each interval's states know which folder of the typed table they are of: an interval that was
downloaded again is made again, no other. States are a table by commits like the typed table, so a report that dies leaves them as they were.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.plans import engine
from quarrymill.plans.planner import BoundReport, InvalidReport, bind
from quarrymill.plans.spec import DatasetSpec, ReportSpec
from quarrymill.sources import commits, readers, store

_TUPLE = "is_tuple"
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def kind_of(bound: BoundReport) -> str:
    """A name for all reports that share their states."""
    used = {n for n, *_ in bound.spec.conditions} | {c.name for c in bound.keys} | {n for n, _ in bound.physical if n != "*"} | {n for n, _ in bound.distinct}
    semi = [(n, *ids.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("_id").cast("decimal(38,0)")), F.lit(0))).first()) for n, ids in bound.semi]
    parts = {
        "columns": [asdict(bound.dataset.column(n)) for n in sorted(used)], "keys": [c.name for c in bound.keys], "physical": bound.physical, "distinct": bound.distinct,
        # As bound, so that ids of labels that the dictionary has got since count as another condition.
        "where": sorted(c._jc.toString() for c in bound.where), "semi": sorted(semi), "empty": bound.empty, "interval": bound.dataset.data_interval,
    }
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:32]


def _needed(bound: BoundReport, source: commits.Commit) -> dict[str, commits.Entry]:
    """The typed table's intervals in the report's range."""
    low, high = (t and store.slot_of(t) for t in bound.utc_range)
    return {s: e for s, e in source.intervals.items() if (not low or s >= low) and (not high or s < high)}


def _states(bound: BoundReport, rows: DataFrame) -> DataFrame:
    """A row for each interval and key with the physical aggregates, and one for each interval, key and distinct tuple without them."""
    own = replace(bound, low=None, high=None)  # whole intervals
    rows = engine.selected(own, rows)
    keys = [readers.INTERVAL, *(c.name for c in bound.keys)]
    tuples = [n for n, _ in bound.distinct]
    ticked = [F.col(f"`{k}`") for k in keys]
    out = rows.groupBy(*ticked).agg(*engine.physical_columns(replace(own, distinct=[])), F.lit(False).alias(_TUPLE)) if bound.physical else None
    if tuples:
        alone = rows.groupBy(*ticked, *(F.col(f"`{t}`").alias(f"distinct_{t}") for t in tuples)).agg(F.lit(True).alias(_TUPLE))
        out = alone if out is None else out.unionByName(alone, allowMissingColumns=True)
    return out


def refresh(spark: SparkSession, bound: BoundReport, table: str, root: str) -> tuple[str, dict[str, commits.Entry]]:
    """Makes the states of the range that are missing or of rows that were replaced; returns where they are, and the typed table's intervals in the range."""
    source = commits.latest(spark, table)
    if source is None:
        raise FileNotFoundError(f"no table at {table}")
    at, needed = f"{root.rstrip('/')}/{kind_of(bound)}", _needed(bound, source)
    have = commits.latest(spark, at)
    stale = {s: e for s, e in needed.items() if have is None or s not in have.intervals or have.intervals[s].of != e.data}
    if stale or have is None:
        rows = commits.read(spark, table, lambda s, e: s in stale)
        commits.write(store.by_slot(_states(bound, rows)), at, {s: e.day for s, e in stale.items()}, {s: e.data for s, e in stale.items()})
    return at, needed


def _merging(bound: BoundReport, states: DataFrame) -> list[Column]:
    names = [(engine.physical_name(n, a), a) for n, a in bound.physical]
    out = [_MERGE[a](F.col(f"`{n}`")).cast(states.schema[n].dataType).alias(n) for n, a in names]
    return [engine.distinct(bound, F.col(_TUPLE)).alias("distinct"), *out] if bound.distinct else out


def run_statistics(spark: SparkSession, spec: ReportSpec, dataset: DatasetSpec, table: str, root: str, words: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(final, raw) of a statistics report over the typed table at ``table``, by the states under ``root``."""
    if dataset.time_column != readers.INTERVAL:
        raise InvalidReport(f"states are by {readers.INTERVAL}; the dataset's time is {dataset.time_column}")
    bound = bind(spec, dataset, words)
    at, needed = refresh(spark, bound, table, root)
    states = commits.read(spark, at, lambda s, e: s in needed and e.of == needed[s].data)
    keys = [c.name for c in bound.keys]
    tuples = {f"distinct_{n}": n for n, _ in bound.distinct if n not in keys}
    for n, _ in bound.distinct:
        if n in keys:
            states = states.drop(f"distinct_{n}")
    states = states.withColumnsRenamed(tuples)
    raw = engine.grouped(bound, states, _merging(bound, states))
    return engine.final(bound, raw, words), raw
