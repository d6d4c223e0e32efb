"""What surrounds reports: typed tables on disk, result files, names, retention, catalogue and status."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions.types import DType
from quarrymill.operators import prepare
from quarrymill.plans import engine
from quarrymill.plans.spec import ColumnSpec, DatasetSpec, ReportSpec, Transform
from quarrymill.sources import commits, readers
from quarrymill.sources.commits import DAY, SLOT
from quarrymill.sources.work import file_system as _fs
from quarrymill.sources.work import work_folder  # noqa: F401  (also under this name)

_SLOT_FORMAT = "%Y%m%d%H%M"


# --- the typed table -----------------------------------------------------------------------------------------------


def slot_of(at: datetime) -> str:
    return f"t{at.strftime(_SLOT_FORMAT)}"


def by_slot(df: DataFrame) -> DataFrame:
    """With the day and slot of each row's interval."""
    return df.withColumns({DAY: F.to_date(readers.INTERVAL), SLOT: F.concat(F.lit("t"), F.date_format(readers.INTERVAL, "yyyyMMddHHmm"))})


def materialise(raw: DataFrame, dataset: DatasetSpec, path: str, intervals: Iterable[datetime] = ()) -> None:
    """Writes the typed table. The intervals in ``raw`` are replaced, all at once.

    intervals: those that ``raw`` is of; of these, the ones without rows are kept as empty ones.
    """
    typed = prepare.prepare(raw, dataset, readers.INTERVAL, readers.ROW)
    commits.write(by_slot(typed), path, {slot_of(a): f"{a:%Y-%m-%d}" for a in intervals})


def slots(spark: SparkSession, path: str) -> list[tuple[str, str, int]]:
    """(day, slot, time of writing in milliseconds) of every interval that the table has, empty ones too."""
    commit = commits.latest(spark, path)
    return sorted((e.day, s, e.at) for s, e in commit.intervals.items()) if commit else []


def stale(spark: SparkSession, path: str, files: list[tuple[datetime, datetime, str]], requested: datetime | None) -> list[tuple[datetime, datetime, str]]:
    """The interval files that the table doesn't have, or has from before a refresh was asked for."""
    since = requested.timestamp() * 1000 if requested else 0
    fresh = {slot for _, slot, at in slots(spark, path) if at >= since}
    return [f for f in files if slot_of(f[0]) not in fresh]


def evict(spark: SparkSession, path: str, keep: int) -> list[str]:
    """Takes all but the newest ``keep`` days out of the table; returns those."""
    gone = sorted({d for d, _, _ in slots(spark, path)})[: -keep or None]
    if gone:
        commits.drop_days(spark, path, set(gone))
    return gone


def download(spark: SparkSession, dataset: DatasetSpec, origin, path: str, start: datetime, end: datetime, requested: datetime | None = None, only_stale: bool = False) -> list[str]:
    """Reads the interval files of a range, writes the typed table, drops old days; returns missing files.

    only_stale: leaves intervals alone that the table has, unless they are older than ``requested``. Columns of an interval are made again together.
    """
    files = readers.interval_files(dataset, start, end)
    files = stale(spark, path, files, requested) if only_stale else files
    if not files:
        return []
    raw, missing = origin.read(spark, dataset, files)
    materialise(raw, dataset, path, [a for a, _, f in files if f not in missing])
    evict(spark, path, dataset.cache_timeout)
    return missing


def load(spark: SparkSession, path: str, low: datetime | None = None, high: datetime | None = None) -> DataFrame:
    """The typed table, or its intervals from ``low`` to before ``high`` (UTC); a table without rows has its columns."""
    a, b = low and slot_of(low), high and slot_of(high)
    return commits.read(spark, path, lambda s, e: (not a or s >= a) and (not b or s < b))


# --- result files --------------------------------------------------------------------------------------------------


def write_csv(df: DataFrame, path: str, header: bool = True, single: bool = False) -> None:
    """A folder of parts; with ``single`` one file, for results that one task may hold."""
    writer = lambda d: d.write.mode("overwrite").option("header", header).option("escape", '"')
    if not single:
        writer(df).csv(path)
        return
    spark = df.sparkSession
    parts = f"{path}.parts"
    writer(df.coalesce(1)).csv(parts)
    fs, at = _fs(spark, parts)
    part = next((s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith("part-")), None)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs.delete(target, True)
    fs.rename(part, target) if part else fs.create(target).close()
    fs.delete(at, True)


def format_value(c: str, dtype: str):
    """Dates, times and durations as text for JSON."""
    if dtype.startswith("timestamp"):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    if dtype == "date":
        return F.date_format(c, "yyyy-MM-dd")
    return F.col(c).cast("string") if dtype.startswith("interval") else F.col(c)


def _formatted(df: DataFrame) -> DataFrame:
    return df.select(*(format_value(f"`{n}`", t).alias(n) for n, t in df.dtypes))


def write_jsonline(df: DataFrame, path: str) -> None:
    _formatted(df).write.mode("overwrite").option("lineSep", "\r\n").option("ignoreNullFields", False).json(path)


def _headed(batches, head: str):
    yield pa.RecordBatch.from_arrays([pa.array([head])], ["value"])
    yield from batches


def write_jsonlistline(df: DataFrame, path: str) -> None:
    """A folder of parts; each starts with the header line, as an array."""
    values = F.to_json(F.array(*(F.col(f"`{c}`").cast("string") for c in df.columns)), {"ignoreNullFields": "false"})
    head = json.dumps(df.columns, ensure_ascii=False)
    _formatted(df).select(values.alias("value")).mapInArrow(lambda batches: _headed(batches, head), "value string").write.mode("overwrite").text(path)


def report_filename(spec: ReportSpec, raw: bool = False) -> str:
    """name-id-start-end[-type].csv; a details report has its id first."""
    stamp = lambda t: t.strftime("%Y%m%d%H%M") if t else "all"
    parts = [str(spec.id), spec.name] if spec.is_details else [spec.name, str(spec.id)]
    parts += [stamp(spec.start), stamp(spec.end)]
    if spec.rtype is not None:
        parts.append(str(spec.rtype))
    return "-".join(parts).replace(" ", "_") + ("-raw.csv" if raw else ".csv")


def _column(d: dict) -> ColumnSpec:
    made = {"dtype": DType(**d["dtype"]), "transformer": Transform(**d["transformer"]) if d["transformer"] else None, "include": tuple(d["include"]), "exclude": tuple(d["exclude"])}
    return ColumnSpec(**(d | made))


def _dataset(d: dict) -> DatasetSpec:
    return DatasetSpec(**(d | {"columns": tuple(map(_column, d["columns"])), "header": tuple(d["header"])}))


def _report(d: dict) -> ReportSpec:
    time = lambda t: datetime.fromisoformat(t) if t else None
    lists = {k: tuple(tuple(x) for x in d[k]) for k in ("conditions", "raw_conditions", "having", "sort_by", "resultset")}
    return ReportSpec(**(d | lists | {"group_by": tuple(d["group_by"]), "start": time(d["start"]), "end": time(d["end"])}))


@dataclass
class Catalog:
    """Datasets, reports, periodic instances and their status; kept in memory, or in a JSON file on any file system that Spark has."""

    datasets: dict[str, DatasetSpec] = field(default_factory=dict)
    reports: dict[int, ReportSpec] = field(default_factory=dict)
    instances: dict[int, tuple[int, datetime, datetime]] = field(default_factory=dict)
    status: dict[int, dict] = field(default_factory=dict)

    def instance(self, key: int) -> ReportSpec:
        """A periodic instance: its report with the instance's range."""
        report, start, end = self.instances[key]
        return replace(self.reports[report], start=start, end=end, id=key, periodic=True)

    def finished(self, key: int) -> bool:
        return self.status.get(key, {}).get("status") == "Succeed"

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps({
            "datasets": {k: asdict(v) for k, v in self.datasets.items()},
            "reports": {k: asdict(v) for k, v in self.reports.items()},
            "instances": self.instances,
            "status": self.status,
        }, default=lambda v: v.isoformat() if hasattr(v, "isoformat") else str(v))
        fs, at = _fs(spark, path)
        out = fs.create(at, True)
        out.write(bytearray(text.encode()))
        out.close()

    @staticmethod
    def load(spark: SparkSession, path: str) -> Catalog:
        d = json.loads(spark.read.text(path, wholetext=True).first()[0])
        by_id = lambda m, f: {int(k): f(v) for k, v in m.items()}
        time = datetime.fromisoformat
        return Catalog({k: _dataset(v) for k, v in d["datasets"].items()}, by_id(d["reports"], _report), by_id(d["instances"], lambda v: (v[0], time(v[1]), time(v[2]))), by_id(d["status"], dict))


def run_report(spark: SparkSession, catalog: Catalog, spec: ReportSpec, table: DataFrame, folder: str, words: DataFrame | None = None, missing: list[str] = ()) -> dict:
    """Runs a report to files and returns its status; a finished one isn't run again."""
    if catalog.finished(spec.id):
        return catalog.status[spec.id]
    single = bool(spec.options.get("single_file"))
    status = catalog.status[spec.id] = {"status": "Running", "file": None, "raw_file": None, "message": ""}
    dataset = catalog.datasets[spec.dataset]
    try:
        if spec.is_details:
            out = engine.run_details(spark, spec, dataset, table, words, tuple(c for c in (readers.INTERVAL, readers.ROW) if c in table.columns))
        else:
            out, raw = engine.run_statistics(spark, spec, dataset, table, words)
            status["raw_file"] = f"{folder}/{report_filename(spec, raw=True)}"
            write_csv(raw, status["raw_file"], single=single)
        status["file"] = f"{folder}/{report_filename(spec)}"
        write_csv(out, status["file"], single=single)
        status["size"] = sum(f.getLen() for f in _fs(spark, status["file"])[0].listStatus(_fs(spark, status["file"])[1]))
        status["status"] = "Succeed"
        if missing:
            status["message"] = "missing files: " + ", ".join(missing)
    except Exception as e:
        status["status"] = "Failed"
        status["message"] = base64.b64encode(str(e).encode()).decode()
    return status
