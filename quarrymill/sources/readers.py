"""Sources and file formats. Every reader yields raw columns of text and the interval that a file is of."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.operators.intervals import interval, zoned_intervals
from quarrymill.plans.spec import DatasetSpec
from quarrymill.sources import csv_blocks
from quarrymill.sources.work import work_folder, written

INTERVAL = "interval_start"
ROW = "row_no"


class ResourceNotFound(FileNotFoundError):
    """An interval's file isn't there."""


def text_schema(header: list[str] | tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(h, T.StringType()) for h in header])


#: The column that names a row's file, where a reader is asked for it.
FILE = "_file"


def _with_file(df: DataFrame, name: str | None) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias(name)) if name else df


def by_name(rows: DataFrame, heads: DataFrame, path: str, wanted: tuple[str, ...], others: list[str] = ()) -> DataFrame:
    """Columns of arrays of values, by the header of each row's file.

    rows: path and ``_r``; heads: path and ``names``, a row a file. Without ``wanted`` all names of all files are columns. A file whose header lacks a wanted name
    has other names for them: its values go by place.
    """
    heads = written(heads, f"{work_folder(rows.sparkSession)}/heads")
    if not wanted:
        names = heads.select(F.posexplode("names").alias("i", "name")).groupBy("name").agg(F.min("i").alias("i")).orderBy("i", "name")
        wanted, all_named = tuple(r["name"] for r in names.collect()), F.lit(True)  # a row a column
    else:
        all_named = F.forall(F.array(*map(F.lit, wanted)), lambda w: F.array_contains("names", w))
    place = F.array(*(F.when(all_named, F.array_position("names", F.lit(w)).cast("int")).otherwise(i + 1) for i, w in enumerate(wanted)))
    places = heads.select(path, (place if wanted else F.array().cast("array<int>")).alias("_places"))
    kinds = places.select("_places").distinct().limit(2).collect()
    if len(kinds) < 2:  # no join where all files are alike
        rows, at = rows, (lambda i: F.lit(kinds[0][0][i] if kinds else i + 1))
    else:
        rows, at = rows.join(places, path), (lambda i: F.col("_places")[i])
    return rows.select(*(F.when(at(i) > 0, F.try_element_at("_r", F.when(at(i) > 0, at(i)))).alias(w) for i, w in enumerate(wanted)), *others)


def _csv_names(record: Column) -> Column:
    """The names in a header, an array; there are at most as many as commas allow."""
    return F.filter(F.split(F.regexp_replace(record, '^\ufeff', ""), r',(?=(?:[^"]*"[^"]*")*[^"]*$)'), lambda x: x.isNotNull())


def _unquoted(names: Column) -> Column:
    return F.transform(names, lambda x: F.replace(F.regexp_replace(x, r'^"(.*)"$', "$1"), F.lit('""'), F.lit('"')))


def _first_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The first line of each file: path and names."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start")).where("_start = 0")
    return lines.mapInArrow(lambda b: _heads(b, True), "value string, _path string")


def _largest(spark: SparkSession, df: DataFrame, paths: str | list[str]) -> int:
    """The size of the largest file; the size of all, where that is no more than a task reads."""
    total = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if total <= _task_bytes(spark):
        return total
    files = spark.read.format("binaryFile").load(paths)
    return files.agg(F.max("length")).first()[0] or 0  # no content is read


def _task_bytes(spark: SparkSession) -> int:
    return int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())


def _read_blocks(spark: SparkSession, paths: str | list[str], header: tuple[str, ...], has_header: bool, file: str | None) -> DataFrame:
    records = csv_blocks.split_records(spark, paths)
    if not has_header:
        first = records.select(F.size(_csv_names(F.col(csv_blocks.RECORD))).alias("n")).first() if not header else None
        n = len(header) or (first["n"] if first else 0)
        rows = csv_blocks.values(records, n)
        return _with_name(rows.select(csv_blocks.PATH, *(F.col("_r")[i].alias(h) for i, h in enumerate(header or [f"_c{i}" for i in range(n)]))), file)
    heads = written(csv_blocks.heads(records), f"{work_folder(spark)}/heads")
    named = heads.select(csv_blocks.PATH, _unquoted(_csv_names(F.col(csv_blocks.RECORD))).alias("names"))
    n = max(len(header), named.agg(F.max(F.size("names"))).first()[0] or 0)
    body = records.join(heads.select(csv_blocks.PATH, csv_blocks.PLACE), [csv_blocks.PATH, csv_blocks.PLACE], "left_anti")
    out = by_name(csv_blocks.values(body, n), named, csv_blocks.PATH, header, [csv_blocks.PATH])
    return _with_name(out, file)


def _with_name(df: DataFrame, name: str | None) -> DataFrame:
    return df.withColumnRenamed(csv_blocks.PATH, name) if name else df.drop(csv_blocks.PATH)


def read_csv(spark: SparkSession, paths: str | list[str], header: tuple[str, ...] = (), has_header: bool = False, multi_line: bool = True, file: str | None = None, blocks: bool = False) -> DataFrame:
    """Quotes inside quoted values are doubled; short rows are filled with nulls, blank lines skipped.

    multi_line: quoted values may hold line breaks. Files that one task may read are read so; where one is larger, all are cut into records by blocks, which gives the
    same rows. blocks: does so in any case. Where files have headers, columns go by name if a header has all the names of ``header``, else by place; without ``header``, all names of all files are columns.
    """
    reader = spark.read.option("header", has_header).option("escape", '"').option("multiLine", multi_line).option("mode", "PERMISSIVE").option("enforceSchema", True)
    plain = (reader.schema(text_schema(header)) if header else reader).csv(paths)
    if blocks or multi_line and _largest(spark, plain, paths) > _task_bytes(spark):
        return _read_blocks(spark, paths, header, has_header, file)
    if has_header:
        heads = _first_lines(spark, paths).select(_unquoted(_csv_names(F.col("value"))).alias("names")).distinct().limit(2).collect()
        own = [r["names"] for r in heads]
        if len(own) > 1 or own and header and tuple(own[0][: len(header)]) != tuple(header) and set(header) <= set(own[0]):
            return _read_blocks(spark, paths, header, has_header, file)
    return _with_file(plain, file)


def read_jsonline(spark: SparkSession, paths: str | list[str], header: tuple[str, ...] = (), file: str | None = None) -> DataFrame:
    """An object a line; without a header its columns are the sorted keys of the first object."""
    lines = _with_file(spark.read.text(paths), file).where(F.trim("value") != "")
    if not header:
        first = lines.limit(1).select(F.array_sort(F.json_object_keys("value")).alias("k")).first()
        header = tuple(first["k"]) if first else ()
    parsed = lines.withColumn("_r", F.from_json("value", text_schema(header)))
    return parsed.select("_r.*", *([file] if file else [])) if header else parsed.drop("_r")


def _heads(batches, wanted: bool):
    """The first line of each file, or all other lines. A file's first line is that of its block 0, whose lines come in order; blank ones before it don't count."""
    import numpy as np
    import pyarrow as pa

    last = None
    for b in batches:
        path, start, value = b.column("_path").to_pylist(), b.column("_start").to_numpy(), b.column("value").to_pylist()
        head = np.zeros(len(path), bool)
        for i in np.flatnonzero(start == 0).tolist():
            if path[i] != last and (value[i] or "").strip():
                head[i], last = True, path[i]
        yield b.select(["value", "_path"]).filter(pa.array(head == wanted))


def read_jsonlistline(spark: SparkSession, paths: str | list[str], header: tuple[str, ...] = (), file: str | None = None) -> DataFrame:
    """An array a line; the first line of each file is its header, and values go by its names (by place where it hasn't all names of ``header``)."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"))
    heads = _first_lines(spark, paths).select("_path", F.from_json("value", "array<string>").alias("names")).where("names IS NOT NULL")
    rows = lines.mapInArrow(lambda b: _heads(b, False), "value string, _path string").where(F.trim("value") != "").withColumn("_r", F.from_json("value", "array<string>"))
    return by_name(rows, heads, "_path", header, [F.col("_path").alias(file)] if file else [])


FORMATS: dict[str, Callable] = {
    "csv": lambda s, p, d, f=None: read_csv(s, p, d.header, d.has_header, d.multi_line, f),
    "jsonline": lambda s, p, d, f=None: read_jsonline(s, p, d.header, f),
    "jsonlistline": lambda s, p, d, f=None: read_jsonlistline(s, p, d.header, f),
    "parquet": lambda s, p, d, f=None: _with_file(s.read.option("mergeSchema", True).parquet(*([p] if isinstance(p, str) else p)), f),
}


def interval_files(dataset: DatasetSpec, start: datetime, end: datetime, now: datetime | None = None, offset: timedelta = timedelta(0)) -> list[tuple[datetime, datetime, str]]:
    """(start, end, file name) of each data interval in the range.

    The arguments and the names are by the wall clock of the dataset's zone, starts and ends in UTC; of two hours of one name the first has the file.
    """
    named = {}
    for wall, a, b in zoned_intervals(interval(dataset.data_interval), start, end, now or end, offset, dataset.timezone):
        named.setdefault(wall.strftime(dataset.filename), (a, b))
    return [(a, b, name) for name, (a, b) in named.items()]


def present(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The paths that exist, with their full names; one listing a parent folder."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    by_parent: dict[str, list[str]] = {}
    for p in paths:
        by_parent.setdefault(p.rsplit("/", 1)[0], []).append(p)
    out = {}
    for parent, own in by_parent.items():
        at = path_of(parent)
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        names = {s.getPath().getName() for s in fs.listStatus(at)} if fs.exists(at) else set()
        out |= {p: fs.makeQualified(path_of(p)).toUri().toString() for p in own if p.rsplit("/", 1)[1] in names}
    return out


def _plain(path: Column) -> Column:
    """A file's URI with one slash after its scheme."""
    return F.regexp_replace(path, "^([A-Za-z0-9]+):/+", "$1:/")


@dataclass
class FileSystem:
    """Files under ``home``: a local folder, or any file system that Spark has (for blob stores a URL such as abfss://)."""

    home: str
    is_local: bool = True

    def path(self, name: str) -> str:
        return f"{self.home.rstrip('/')}/{name}"

    def read(self, spark: SparkSession, dataset: DatasetSpec, files: list[tuple[datetime, datetime, str]]) -> tuple[DataFrame, list[str]]:
        """(rows with interval and row number, names of missing files). All files, or folders of files, are one scan; a row's interval is that of its file."""
        there = present(spark, [self.path(f) for _, _, f in files])
        missing = [f for _, _, f in files if self.path(f) not in there]
        if missing and not dataset.ignore_missing_datafile:
            raise ResourceNotFound(", ".join(missing))
        found = [(a, self.path(f)) for a, _, f in files if self.path(f) in there]
        if not found:
            return spark.createDataFrame([], text_schema(dataset.header).add(INTERVAL, "timestamp_ntz").add(ROW, "long")), missing
        rows = FORMATS[dataset.filetype](spark, [p for _, p in found], dataset, FILE)
        rows = rows.withColumn(ROW, F.monotonically_increasing_id()).withColumn("_at", _plain(F.col(FILE))).withColumn("_in", F.regexp_replace("_at", "/[^/]*$", ""))
        names = spark.createDataFrame([(there[p], a) for a, p in found], f"_name string, {INTERVAL} timestamp_ntz").withColumn("_name", _plain(F.col("_name")))
        # A name is that of the row's file or of its folder; there are as many as intervals were asked for.
        by = lambda c, i: F.broadcast(names.select(F.col("_name").alias(c), F.col(INTERVAL).alias(i)))
        out = rows.join(by("_at", "_i1"), "_at", "left").join(by("_in", "_i2"), "_in", "left")
        return out.withColumn(INTERVAL, F.coalesce("_i1", "_i2")).drop(FILE, "_at", "_in", "_i1", "_i2"), missing


SOURCES: dict[str, Callable] = {}


def register(name: str, make: Callable) -> None:
    SOURCES[name] = make


def source(name: str, **parameters):
    """The source of that name."""
    if name not in SOURCES:
        raise KeyError(f"no source {name!r}")
    return SOURCES[name](**parameters)


def _blob(container: str, account: str, home: str = "") -> FileSystem:
    return FileSystem(f"abfss://{container}@{account}.dfs.core.windows.net/{home}".rstrip("/"), is_local=False)


register("localfs", lambda home: FileSystem(home))
register("blobstorage", _blob)
