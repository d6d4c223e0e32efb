"""Numbers and joins along an order, without one task that holds it."""

import ipaddress
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarrymill.functions import network
from quarrymill.operators import dictionary as enums
from quarrymill.operators.ranks import dense_numbers, last_before


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_million_new_keys(spark):
    words = lambda n: spark.range(n).select(F.concat(F.lit("k"), F.lpad(F.col("id") * 7919 % 1_000_003, 7, "0")).alias("word"))
    rows, grown = enums.encode(words(1_000_000).union(words(1000)), "w", "word", enums.empty(spark))
    assert "SinglePartition" not in _plan(rows) and "SinglePartition" not in _plan(grown)
    got = rows.agg(F.count(F.lit(1)), F.countDistinct("w"), F.min("w"), F.max("w")).first()
    assert tuple(got) == (1_001_000, 1_000_000, 1, 1_000_000)
    # Ids follow the order of keys.
    wrong = grown.withColumn("next", F.lead("key").over(Window.orderBy("id"))).where("next <= key").count()
    assert wrong == 0


@pytest.mark.parametrize("n", [0, 1, 2, 50])
def test_dense_numbers(spark, n):
    words = [f"w{(i * 37) % 101:03d}" for i in range(n)]
    got = {r.key: r.n for r in dense_numbers(spark.createDataFrame([(w,) for w in words], "key string").repartition(3), "key").collect()}
    assert got == {w: i + 1 for i, w in enumerate(sorted(words))}


def test_new_keys_come_after_the_largest(spark):
    words = spark.createDataFrame([("w", "m", 9, None), ("other", "z", 50, None)], enums.SCHEMA)
    rows, grown = enums.encode(spark.createDataFrame([("z",), ("a",), ("m",)], "word string"), "w", "word", words)
    assert {r.word: r.w for r in rows.collect()} == {"m": 9, "a": 10, "z": 11} and grown.count() == 4
    again, same = enums.encode(spark.createDataFrame([("z",)], "word string"), "w", "word", grown)
    assert again.first().w == 11 and same.count() == 4


def test_last_before(spark):
    r = random.Random(5)
    starts = {r.randrange(1000): i for i in range(40)}
    points = sorted({r.randrange(1000) for _ in range(300)})
    got = {x.k: x.v for x in last_before(spark.createDataFrame([(p,) for p in points], "k long").repartition(3), spark.createDataFrame(list(starts.items()), "k long, v long"), "k", ["v"]).collect()}
    assert got == {p: starts.get(max((s for s in starts if s <= p), default=None)) for p in points}
    nothing = last_before(spark.createDataFrame([(1,)], "k long"), spark.createDataFrame([], "k long, v long"), "k", ["v"])
    assert [tuple(x) for x in nothing.collect()] == [(1, None)]


def _brute(ip, ranges):
    try:
        at = ipaddress.ip_address((ip or "").strip())
    except ValueError:
        return None
    for a, b, place in ranges:
        if (low := ipaddress.ip_address(a)).version == at.version and low <= at <= ipaddress.ip_address(b):
            return place
    return None


@pytest.mark.parametrize("few", [0, 1000])
def test_addresses_of_both_versions(spark, monkeypatch, few):
    monkeypatch.setattr(enums, "FEW_RANGES", few)
    r = random.Random(2)
    ranges, at = [], 0
    for i in range(60):  # all in 10.0.0.0/8, with gaps
        at += r.randrange(1, 5000)
        size = r.randrange(1, 3000)
        ranges.append((str(ipaddress.ip_address((10 << 24) + at)), str(ipaddress.ip_address((10 << 24) + at + size)), None if i == 5 else f"v4-{i}"))
        at += size
    at = 1 << 100
    for i in range(30):
        at += r.randrange(1, 1 << 90)
        ranges.append((str(ipaddress.ip_address(at)), str(ipaddress.ip_address(at + (1 << 80))).upper(), f"v6-{i}"))
        at += 1 << 80
    ranges.append(("::", "::ffff", "least"))
    ips = [str(ipaddress.ip_address((10 << 24) + r.randrange(300_000))) for _ in range(300)] + [x for a, b, _ in ranges for x in (a, b)]
    ips += [str(ipaddress.ip_address((1 << 100) + r.randrange(1 << 95))) for _ in range(100)] + [None, "", "junk", "9.255.255.255", "255.255.255.255", "::1", "10.0.0", " 10.0.0.9 "]
    df = spark.createDataFrame([(i, x, "own") for i, x in enumerate(ips)], "id int, ip string, start_ip string").repartition(3)
    got = enums.locate(df, F.col("ip"), spark.createDataFrame(ranges, "start_ip string, end_ip string, place string"), ["place"])
    assert got.columns == ["id", "ip", "start_ip", "place"]
    assert {x.id: x.place for x in got.collect()} == {i: _brute(x, ranges) for i, x in enumerate(ips)}


def test_rows_of_one_network_are_dealt_evenly(spark):
    """All addresses in 10.1.0.0/16, and ranges beside: the order itself is dealt, so that no task has most of it."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        points = spark.range(40_000).select(network.order_key(F.concat_ws(".", F.lit("10"), F.lit("1"), (F.col("id") / 256).cast("int"), F.col("id") % 256)).alias("_ip"))
        starts = spark.range(200).select(network.number_key(F.shiftleft("id", 24)).alias("_ip"), F.col("id").alias("net"))
        found = last_before(points, starts, "_ip", ["net"])
        assert found.where("net = 10").count() == 40_000
        dealt = spark.read.parquet(found.inputFiles()[0].rsplit("/", 1)[0]).groupBy("_part").count().collect()
        assert len(dealt) == 8 and max(r["count"] for r in dealt) < 3 * 40_200 / 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
