"""Shared pieces of the training-data operators: scratch tables and Arrow batches."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Text handled at once inside a Python worker, in bytes; bounds a worker's memory.
SLICE_BYTES = 2_000_000
SLICE_ROWS = 2_000

#: Spark deletes an execution's shuffle files at its end where this is set.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); where that is unset, a folder of the warehouse, which is shared as well."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    root = spark.conf.get("spark.sql.warehouse.dir")
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not spark.sparkContext.master.startswith("local") and str(path.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme()) == "file":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return root.rstrip("/") + "/scratch"


class Scratch:
    """Intermediate Parquet tables in the shared folder.

    A written table cuts the lineage: a lost executor repeats at most the step after it. ``drop`` deletes tables that
    the result doesn't read; those that it reads go when the driver exits.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{scratch_root(spark)}/quarrymill-{uuid.uuid4().hex}"
        atexit.register(self._delete, self.path)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        at = f"{self.path}/{name}"
        before = self.spark.conf.get(_CLEAN, None)
        self.spark.conf.set(_CLEAN, "true")  # nothing reads a write's shuffle files after it
        try:
            df.write.mode("overwrite").parquet(at)
        finally:
            self.spark.conf.set(_CLEAN, before) if before is not None else self.spark.conf.unset(_CLEAN)
        return self.spark.read.schema(df.schema).parquet(at)

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(f"{self.path}/{name}")

    def _delete(self, at: str) -> None:
        try:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the session may be over; then nobody reads the files either
            pass


_held: list = [None, None]


def in_use(owner: object, empty: Callable[[], None]) -> None:
    """Says whose cache this Python worker uses from now on; the one before is emptied, since a worker goes from one operator's tasks to another's."""
    if _held[0] is not None and _held[0] != owner:
        _held[1]()
    _held[:] = [owner, empty]


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that one slice holds about SLICE_BYTES of text (one row at least)."""
    import numpy as np

    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
        part = np.maximum(np.cumsum(sizes) // SLICE_BYTES, np.arange(len(sizes)) // SLICE_ROWS)
        starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    text = batch.column(batch.schema.get_field_index(column))
    return [x or b"" for x in text.cast(pa.binary() if pa.types.is_string(text.type) else pa.large_binary()).to_pylist()]


def map_slices(make: Callable[[pa.RecordBatch], pa.RecordBatch], column: str = "text", once: tuple[str, ...] = ()):
    """A function for mapInArrow that applies ``make`` to each text slice.

    once: of rows that are equal in these columns, a task hands only the first to ``make`` (a task's keys are as many
    as its rows, whose number the partition's size bounds).
    """

    def run(batches):
        seen: set[tuple] = set()
        for part in text_slices(batches, column):
            if once:
                keys = zip(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in once))
                fresh = [not (k in seen or seen.add(k)) for k in keys]
                part = part if all(fresh) else part.filter(pa.array(fresh))
            if part.num_rows:
                yield make(part)

    return run


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
