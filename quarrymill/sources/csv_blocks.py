"""Large CSV files, whose quoted values may hold line breaks, by many tasks.

Spark's text reader deals a file's lines over tasks by blocks of bytes; each line is in one block. A line either ends inside a quoted value or doesn't, depending
on whether it began in one; so a block, too, is a function of one bit. One pass makes these functions, a row a block; a window over a file's blocks chains them and
tells in which state each block begins. The second pass then cuts each block into records: lines up to the end of a record that began in an earlier block, whole
records, and the lines of one that goes on in the next block. The pieces of records that cross blocks, at most two a block, are put together by group.

A quote opens a value only at its beginning and closes it unless doubled, which is what Spark's own reader does; both readers give the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PATH, PLACE, RECORD = "_path", "_place", "_record"
_WHOLE, _PIECE = 0, 1

#: A line from outside or inside a quoted value that ends outside of one.
_VALUE = r'(?:"(?:[^"]|"")*+"[^,]*+|[^",][^,]*+|)'
_OUT_TO_OUT = re.compile(rf"{_VALUE}(?:,{_VALUE})*+", re.S)
_IN_TO_OUT = re.compile(rf'(?:[^"]|"")*+"[^,]*+(?:,{_VALUE})*+', re.S)


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted value, by whether it begins in one."""
    if '"' not in line:
        return inside
    return not (_IN_TO_OUT if inside else _OUT_TO_OUT).fullmatch(line)


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(paths).select("value", F.col("_metadata.file_path").alias(PATH), F.col("_metadata.file_block_start").alias("_start"))


def _runs(batches) -> Iterator[tuple[str, int, list[str]]]:
    """(file, block, some of its lines in order); the lines of a block come together."""
    for b in batches:
        path, start = b.column(PATH).to_pylist(), b.column("_start").to_numpy()
        cuts = [0, *(i for i in range(1, len(path)) if start[i] != start[i - 1] or path[i] != path[i - 1]), len(path)]
        value = b.column("value").to_pylist()
        for i, j in zip(cuts, cuts[1:]):
            if i < j:
                yield path[i], int(start[i]), value[i:j]


def _functions(batches):
    """A row a block: in which state it ends when it begins outside, and when inside."""
    now, state, out = None, [False, True], []
    for path, start, lines in _runs(batches):
        if now != (path, start):
            if now:
                out.append((*now, *state))
            now, state = (path, start), [False, True]
        for line in lines:
            if '"' in line:
                state = [ends_inside(line, s) for s in state]
    if now:
        out.append((*now, *state))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], [PATH, "_start", "_from_out", "_from_in"])


def states(lines: DataFrame) -> DataFrame:
    """(path, start, inside): whether each block of a file begins inside a quoted value."""
    blocks = lines.mapInArrow(_functions, f"{PATH} string, _start long, _from_out boolean, _from_in boolean")
    # A block keeps the state, turns it round, or has one whatever came before: the last of these before a block, and the turns since, tell its state.
    fixed, turn = F.col("_from_out") == F.col("_from_in"), (F.col("_from_out") & ~F.col("_from_in")).cast("int")
    order = Window.partitionBy(PATH).orderBy("_start")
    turns = blocks.withColumn("_turns", F.sum(turn).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(fixed, F.struct(F.col("_from_out").cast("int").alias("state"), "_turns")), ignorenulls=True).over(before)
    known = turns.select(PATH, "_start", last.alias("_last"), F.coalesce(F.last("_turns").over(before), F.lit(0)).alias("_before"))
    inside = (F.coalesce("_last.state", F.lit(0)) + F.col("_before") - F.coalesce("_last._turns", F.lit(0))) % 2 == 1
    return known.select(PATH, "_start", inside.alias("_inside"))


def _records(batches, inside):
    """Records, and pieces of those that cross blocks. A piece's part: -1 goes on from the block before, 1 is begun here."""
    now, open_, rows = None, [], []

    def closed():
        if now and open_:
            rows.append((now[0], now[1], first, _PIECE, begun, "\n".join(open_)))

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.int8(), pa.int8(), pa.string()))], [PATH, "_start", "_line", "_kind", "_part", RECORD])
        rows.clear()
        return out

    for path, start, lines in _runs(batches):
        if now != (path, start):
            closed()
            now, line, first, open_ = (path, start), 0, 0, []
            at = inside.value.get(path, ())
            state = bool(len(at)) and bool(at[min(np.searchsorted(at, start), len(at) - 1)] == start)
            begun = -1 if state else 1
        for text in lines:
            if not state:
                first, begun = line, 1
            state = ends_inside(text, state)
            if open_ or state or begun == -1:
                open_.append(text)
                if not state:  # a record that began before this line ends with it
                    rows.append((path, start, first, _PIECE if begun == -1 else _WHOLE, begun, "\n".join(open_)))
                    open_, begun = [], 1
            else:
                rows.append((path, start, line, _WHOLE, 1, text))
            line += 1
        if rows:
            yield flush()
    closed()
    if rows:
        yield flush()


def split_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The records of CSV files as text: path, place (rising within a file) and record; blank lines outside of values are left out."""
    lines = _lines(spark, paths)
    begin: dict[str, list[int]] = {}
    for r in states(lines).where("_inside").toLocalIterator():  # a number for each block of a file that begins inside a value
        begin.setdefault(r[PATH], []).append(r["_start"])
    inside = spark.sparkContext.broadcast({p: np.array(sorted(v)) for p, v in begin.items()})
    cut = lines.mapInArrow(partial(_records, inside=inside), f"{PATH} string, _start long, _line long, _kind byte, _part byte, {RECORD} string")
    whole = cut.where(F.col("_kind") == _WHOLE).select(PATH, (F.col("_start") + F.col("_line")).alias(PLACE), RECORD)
    pieces = cut.where(F.col("_kind") == _PIECE)
    # A record begins with a piece of part 1; those of part -1 after it belong to it.
    chain = F.sum((F.col("_part") == 1).cast("int")).over(Window.partitionBy(PATH).orderBy("_start", "_line"))
    joined = pieces.withColumn("_chain", chain).groupBy(PATH, "_chain").agg(
        F.min(F.col("_start") + F.col("_line")).alias(PLACE), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_start", "_line", RECORD))), lambda x: x[RECORD]), "\n").alias(RECORD)
    )
    clean = F.regexp_replace(F.regexp_replace(RECORD, "\r$", ""), "\r\n", "\n").alias(RECORD)
    return whole.unionByName(joined.select(PATH, PLACE, RECORD)).select(PATH, PLACE, clean).where(F.trim(RECORD) != "")


def heads(records: DataFrame) -> DataFrame:
    """The first record of each file."""
    return records.groupBy(PATH).agg(F.min(PLACE).alias(PLACE), F.min_by(RECORD, PLACE).alias(RECORD))


def values(records: DataFrame, columns: int) -> DataFrame:
    """path, place and ``_r``, the array of a record's values; null where it is short."""
    fields = ", ".join(f"_c{i} string" for i in range(columns))
    parsed = F.from_csv(RECORD, fields, {"escape": '"', "mode": "PERMISSIVE"})
    return records.withColumn("_v", parsed).select(PATH, PLACE, F.array(*(F.col(f"_v._c{i}") for i in range(columns))).alias("_r"))
