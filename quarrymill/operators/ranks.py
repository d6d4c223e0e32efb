"""Operations along a total order without one task that holds it: dense numbers, and the last row before each row.

Rows are dealt into ranges of the order; within a range, work goes row by row, and what a range needs from those before it is a sum or a row for each of
them. Only these few rows, one a range, come to the driver.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.sources.work import work_folder, written

_BITS = 33  # of a place in a partition in Spark's increasing ids; the partition's number is above them


def _ranges(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def dense_numbers(keys: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Distinct keys with numbers from 1 in their order, as a written table."""
    at = work_folder(keys.sparkSession)
    first = written(keys, f"{at}/keys")  # dealing into ranges reads its input twice
    place = F.monotonically_increasing_id()
    marked = written(first.repartitionByRange(_ranges(first), key).sortWithinPartitions(key).select("*", place.alias("_place")), f"{at}/placed")
    part = F.shiftright("_place", _BITS)
    before, total = [], 0
    for r in sorted(marked.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()):
        before.append((r["part"], total))
        total += r["n"]
    offsets = F.broadcast(keys.sparkSession.createDataFrame(before, "_part long, _before long"))  # one row a range
    number = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << _BITS) - 1)) + 1
    return marked.withColumn("_part", part).join(offsets, "_part").withColumn(name, number).drop("_part", "_place", "_before")


def last_before(points: DataFrame, starts: DataFrame, key: str, values: list[str]) -> DataFrame:
    """``points`` with the values of the last start at or before each; null where there is none.

    points: distinct keys; starts: (key, values), one a key. Both are dealt into ranges together, so that where most points are, there are most ranges.
    """
    at, n = work_folder(points.sparkSession), _ranges(points)
    starts = starts.select(key, F.lit(0).alias("_kind"), F.struct(*values).alias("_open"))
    kind = starts.schema["_open"].dataType
    both = written(points.select(key, F.lit(1).alias("_kind"), F.lit(None).cast(kind).alias("_open")).unionByName(starts), f"{at}/both")
    dealt = written(both.repartitionByRange(n, key, "_kind").withColumn("_part", F.spark_partition_id()), f"{at}/dealt")
    # What is open at the edge of each range: the last start of the ranges before it.
    edges = sorted((r["_part"], r["last"]) for r in dealt.where("_kind = 0").groupBy("_part").agg(F.max_by("_open", key).alias("last")).collect())
    firsts = [p for p, _ in edges]
    carry = [(p, edges[i - 1][1]) for p in range(n) if (i := bisect.bisect_left(firsts, p))]
    schema = T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("_edge", kind)])
    carry = F.broadcast(points.sparkSession.createDataFrame(carry, schema))  # one row a range
    within = Window.partitionBy("_part").orderBy(key, "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = dealt.withColumn("_open", F.last("_open", ignorenulls=True).over(within)).where("_kind = 1").join(carry, "_part", "left")
    return found.select(key, F.coalesce("_open", "_edge").alias("_open")).select(key, *(F.col(f"_open.`{v}`").alias(v) for v in values))
