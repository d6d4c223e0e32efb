"""Enum dictionaries: a small table (column, key, id, info) for each dataset; id 0 is a column's default."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import network
from quarrymill.operators.ranks import dense_numbers, last_before

SCHEMA = "column string, key string, id bigint, info string"


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def encode(values: DataFrame, name: str, source: str, dictionary: DataFrame, valid: Column | None = None, default: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(values with ids in ``name``, the dictionary with new keys).

    Keys are trimmed. New valid keys get ids after the largest, in order of key within this batch, so that the
    result doesn't depend on partitions. Invalid and missing keys get 0, the default's id; without a default they are an error.
    New keys are numbered here, once, into a written table that both results read.
    """
    key = F.trim(F.col(source).cast("string"))
    ok = key.isNotNull() & (key != "")
    if valid is not None:
        ok = ok & F.coalesce(valid, F.lit(False))
    known = dictionary.where(F.col("column") == name)
    fresh = values.where(ok).select(key.alias("key")).distinct().join(known.select("key"), "key", "left_anti")
    last = known.agg(F.max("id")).first()[0] or 0
    added = dense_numbers(fresh, "key").select(F.lit(name).alias("column"), "key", (F.lit(last) + F.col("n")).cast("bigint").alias("id"), F.lit(None).cast("string").alias("info"))
    if default is not None:
        zero = values.sparkSession.createDataFrame([(name, default, 0, None)], SCHEMA)
        added = added.unionByName(zero.join(known.where("id = 0").select("column"), "column", "left_anti"))
    grown = dictionary.unionByName(added)
    ids = grown.where(F.col("column") == name).select(F.col("key").alias("_key"), F.col("id").alias("_id"))
    joined = values.withColumn("_k", F.when(ok, key)).join(ids, F.col("_k") == F.col("_key"), "left")
    none = F.lit(0) if default is not None else F.raise_error(F.concat(F.lit(f"no valid key for {name}: "), F.coalesce(F.col(source).cast("string"), F.lit("null")))).cast("bigint")
    return joined.withColumn(name, F.coalesce("_id", none)).drop("_k", "_key", "_id"), grown


def seen_domains(rows: DataFrame, domain: Column, found: Column, pattern: str) -> DataFrame:
    """Valid domains: of the right form, with one request at least that was found."""
    return rows.where(F.coalesce(domain.rlike(pattern), F.lit(False)) & F.coalesce(found, F.lit(False))).select(domain.alias("domain")).distinct()


def domain2enum(rows: DataFrame, name: str, source: str, not_found: Column, pattern: str, dictionary: DataFrame, default: str = "default") -> tuple[DataFrame, DataFrame]:
    """Domains as ids. A domain counts once any of its requests was found, for all of its rows."""
    valid = seen_domains(rows, F.col(source), ~not_found, pattern).select(F.col("domain").alias("_d"))
    known = dictionary.where((F.col("column") == name) & (F.col("id") != 0)).select(F.col("key").alias("_d"))
    both = valid.union(known).distinct().withColumn("_ok", F.lit(True))
    marked = rows.join(both, F.col(source) == F.col("_d"), "left")
    out, grown = encode(marked, name, source, dictionary, F.col("_ok"), default)
    return out.drop("_d", "_ok"), grown


def decode(df: DataFrame, c: str, dictionary: DataFrame, name: str | None = None, keep: str | None = None) -> DataFrame:
    """Ids as labels; an unknown id stays, as text. keep: a name under which the id stays, too."""
    ids = dictionary.where(F.col("column") == (name or c)).select(F.col("id").alias("_id"), F.col("key").alias("_label"))
    out = df.join(ids, F.col(c) == F.col("_id"), "left")
    if keep:
        out = out.withColumn(keep, F.col(c))
    return out.withColumn(c, F.coalesce("_label", F.col(c).cast("string"))).drop("_id", "_label")


def lookup(dictionary: DataFrame, name: str, keys: list[str]) -> dict[str, int]:
    """Ids of labels (as many rows as keys)."""
    rows = dictionary.where((F.col("column") == name) & F.col("key").isin(keys)).collect()
    return {r["key"]: r["id"] for r in rows}


def search(dictionary: DataFrame, name: str, pattern: str) -> DataFrame:
    """Rows of labels like the pattern, * standing for any text."""
    like = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_").replace("*", "%")
    return dictionary.where((F.col("column") == name) & F.col("key").like(like))


#: Tables of at most so many address ranges go to every task.
FEW_RANGES = 256


def locate(df: DataFrame, ip: Column, ranges: DataFrame, columns: list[str]) -> DataFrame:
    """Left join with non-overlapping address ranges (start_ip, end_ip, ...), of IPv4 and IPv6.

    ip: addresses as text. Bounds are text, or numbers for IPv4. A few ranges are compared with each row; of more, each distinct address looks up the last
    range that starts at or before it, and has it if it ends no earlier. Addresses that share a network, or most of their bits, are as good as any: they are dealt by
    their order, with the ranges.
    """
    def bound(c: str) -> Column:
        return network.order_key(F.col(c)) if ranges.schema[c].dataType.typeName() == "string" else network.number_key(F.col(c))

    starts = ranges.select(bound("start_ip").alias("_start"), bound("end_ip").alias("_end"), *columns).where("_start IS NOT NULL")
    keyed = df.withColumn("_ip", network.order_key(ip))
    few = starts.limit(FEW_RANGES + 1).collect()
    if len(few) <= FEW_RANGES:
        table = F.broadcast(df.sparkSession.createDataFrame(few, starts.schema).withColumn("_net", F.explode(F.sequence(_net("_start"), _net("_end")))))
        hit = (_net("_ip") == F.col("_net")) & (F.col("_ip") >= F.col("_start")) & (F.col("_ip") <= F.col("_end"))
        return keyed.join(table, hit, "left").drop("_ip", "_start", "_end", "_net")
    points = keyed.where("_ip IS NOT NULL").select("_ip").distinct()
    found = last_before(points, starts.withColumnRenamed("_start", "_ip"), "_ip", ["_end", *columns]).where(F.col("_end") >= F.col("_ip")).drop("_end")
    return keyed.join(found, "_ip", "left").drop("_ip")


def _net(key: str) -> Column:
    """The version and the first eight bits of an address's key, as a number; a range has 512 at most."""
    return F.conv(F.substring(key, 1, 3), 16, 10).cast("int")


def country_label(ip: Column, country: Column, internal: str = "Internal", unknown: str = "Unknown") -> Column:
    return F.when(ip.isNull() | (F.trim(ip) == ""), unknown).otherwise(F.coalesce(F.initcap(country), F.lit(internal)))


def city_label(ip: Column, country: Column, city: Column, internal: str = "Internal", unknown: str = "Unknown") -> Column:
    """"Country City", or the country where the city isn't known."""
    both = F.concat_ws(" ", F.initcap(country), F.initcap(F.nullif(city, F.lit(""))))
    return F.when(ip.isNull() | (F.trim(ip) == ""), unknown).when(country.isNull(), internal).otherwise(both)


def first_known(df: DataFrame, key: str, sources: list[tuple[DataFrame, str, str]], out: str) -> DataFrame:
    """Looks a key up in several tables (table, key column, value column), in order; else the key itself."""
    found = []
    for i, (table, k, v) in enumerate(sources):
        one = table.groupBy(F.col(k).alias(f"_k{i}")).agg(F.min(v).alias(f"_v{i}"))
        df = df.join(one, F.col(key) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
        found.append(f"_v{i}")
    return df.withColumn(out, F.coalesce(*found, F.col(key).cast("string"))).drop(*found)
