"""Shards by extendible hashing.

A document's hash is a string of bits. The directory begins with one bucket, and a bucket whose documents exceed
the byte limit splits on the next bit, and only such a bucket. A bucket's depth is therefore the least number
of leading bits at which it fits, and that can be read off sums of bytes by prefix: documents are summed
once by a prefix long enough for an even spread, those sums (some dozens a shard, not one a document) give all
shorter prefixes, and only what is still too large at that length is summed again by longer ones.

Rows that no bit parts (their hashes are equal) and that exceed the limit together go on pages: they are dealt in runs by a
running sum of bytes. A single document larger than the limit has a shard of its own.

Defined results: null text has 0 bytes; a null doc_id hashes as the empty string, so that such rows share a bucket and
pages; repeated rows stay together until a page is full; an empty table gives no rows; columns other than doc_id
and text are ignored in ``assign``, and kept by ``write_shards``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import Scratch, read

#: Bytes of text in a shard, at most.
LIMIT = 64 * 1024 * 1024
BITS = 60
SPREAD_BITS = 5
#: Lengths of prefixes that are summed together.
STEP = 4


def hash_bits() -> F.Column:
    """The first 60 bits of the md5 of doc_id as text."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, BITS // 4), 16, 10).cast("long")


def _leaves(sums: DataFrame, low: int, high: int, limit: int, scratch: Scratch) -> DataFrame:
    """(fine, depth, shard_bytes): for each prefix of ``high`` bits the shortest of its prefixes, from ``low`` bits on, that fits.

    From the top, some lengths at a time: sums by the longest prefix of a step are repeated for the step's lengths only, and what is too large at that prefix goes
    on to the next step. The first step has all lengths whose sums are few beside those of ``high`` bits.
    """
    left, out = sums.select("fine", "size"), None
    while True:
        at = next(b for b in (high - 2 * STEP, high - STEP, high) if b >= low)
        level = scratch.put(left.groupBy(F.shiftright("fine", high - at).alias("at")).agg(F.sum("size").alias("size")), f"level{at}")
        up = level.select("at", "size", F.explode(F.sequence(F.lit(low), F.lit(at))).alias("depth")).withColumn("prefix", F.expr(f"shiftright(at, {at} - depth)"))
        fits = up.groupBy("depth", "prefix").agg(F.sum("size").alias("total")).where(F.col("total") <= limit)
        leaves = up.join(fits, ["depth", "prefix"]).groupBy("at").agg(F.min("depth").alias("depth"), F.min_by("total", "depth").alias("shard_bytes"))
        placed = scratch.put(left.withColumn("at", F.shiftright("fine", high - at)).join(leaves, "at", "left").drop("at"), f"placed{at}")
        found = placed.where("depth IS NOT NULL").select("fine", "depth", "shard_bytes")
        out = found if out is None else out.unionByName(found)
        if at == high:
            return out
        left, low = placed.where("depth IS NULL").select("fine", "size"), at + 1


def assign(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, depth, prefix (the leading bits as text), page, shard_id and shard_bytes of every row."""
    scratch = Scratch(docs.sparkSession)
    return _assigned(scratch.put(_sized(docs), "sized"), limit, scratch)


def _sized(docs: DataFrame, *more: F.Column) -> DataFrame:
    """doc_id, n_bytes, the hash and further columns of every row."""
    own = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("n_bytes"), *more)
    return own.withColumn("_h", hash_bits())


def _assigned(sized: DataFrame, limit: int, scratch: Scratch, keys: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``assign`` and ``keys`` (columns that name a row) of every row of ``sized``, a written table."""
    total = sized.agg(F.sum("n_bytes")).first()[0] or 0
    low, high = 0, min(BITS, max(0, (total // limit).bit_length()) + SPREAD_BITS)
    left, out = sized, None
    while True:
        here = left.withColumn("fine", F.shiftright(F.col("_h"), BITS - high))
        sums = scratch.put(here.groupBy("fine").agg(F.sum("n_bytes").alias("size"), F.min("_h").alias("_lo"), F.max("_h").alias("_hi")), f"sums{high}")
        leaves = scratch.put(_leaves(sums, low, high, limit, scratch), f"leaves{high}")
        found = here.join(leaves, "fine").drop("fine").withColumn("page", F.lit(0).cast("long"))
        out = found if out is None else out.unionByName(found)
        over = scratch.put(sums.join(leaves, "fine", "left_anti"), f"over{high}")
        # Rows of one hash are parted by no bit.
        alike = over.where("_lo = _hi").select("fine")
        if not alike.isEmpty():
            out = out.unionByName(_paged(here.join(alike, "fine").drop("fine"), limit, scratch, keys, f"paged{high}"))
        more = over.where("_lo <> _hi").select("fine")
        if more.isEmpty():
            break
        left = scratch.put(here.join(more, "fine").drop("fine"), f"left{high}")
        # What is left is too large at this prefix: its shorter prefixes are, too.
        low, high = high + 1, min(BITS, high + 8)
    bits = F.lpad(F.bin("_h"), BITS, "0").substr(F.lit(1), F.col("depth"))
    return out.withColumn("prefix", bits).select(
        "doc_id", "n_bytes", F.col("depth").cast("int").alias("depth"), "prefix", "page", F.concat(F.lit("s"), "prefix", F.when(F.col("page") > 0, F.concat(F.lit("-"), F.col("page").cast("string"))).otherwise("")).alias("shard_id"), "shard_bytes", *keys
    )


def directory(assigned: DataFrame) -> DataFrame:
    """The directory of what ``assign`` gave: a row for each bucket (or page of one) with its prefix, depth, documents and bytes.

    A directory is indexed by the leading ``global_depth`` bits (the greatest depth); a bucket of fewer bits has ``slots`` entries in it,
    from ``first_slot`` on. Buckets are as many as shards, so the window for the greatest depth holds shards, not documents.
    """
    buckets = assigned.groupBy("prefix", "depth", "page", "shard_id").agg(F.count(F.lit(1)).alias("n_docs"), F.max("shard_bytes").alias("shard_bytes"))
    deepest = assigned.agg(F.coalesce(F.max("depth"), F.lit(0)).alias("global_depth"))
    out = buckets.join(F.broadcast(deepest))  # one row
    slots = F.expr("shiftleft(1L, global_depth - depth)")
    first = F.when(F.col("depth") > 0, F.conv("prefix", 2, 10).cast("long")).otherwise(F.lit(0).cast("long")) * slots
    return out.select("shard_id", "prefix", "depth", "page", "n_docs", "shard_bytes", "global_depth", slots.alias("slots"), first.alias("first_slot"))


def _paged(left: DataFrame, limit: int, scratch: Scratch, keys: tuple[str, ...], name: str) -> DataFrame:
    """Rows of equal hashes on pages. Each input partition fills pages of its own, so that no task holds a whole hash."""
    left = scratch.put(left.withColumn("_part", F.spark_partition_id()), name)
    run = Window.partitionBy("_h", "_part").orderBy("doc_id", "n_bytes", *keys).rowsBetween(Window.unboundedPreceding, 0)
    # The first-fit of a running sum: a page starts where a row would pass a multiple of half the limit, so a page holds
    # at most the limit, or one larger row.
    filled = left.withColumn("_page", F.floor((F.sum("n_bytes").over(run) - 1) / F.lit(limit // 2 or 1)).cast("long"))
    big = F.col("n_bytes") > limit // 2
    alone = F.when(big, F.row_number().over(Window.partitionBy("_h", "_part").orderBy("doc_id", "n_bytes", *keys)))
    filled = filled.withColumn("_alone", F.coalesce(alone, F.lit(0)))
    pages = filled.groupBy("_h", "_part", "_page", "_alone").agg(F.sum("n_bytes").alias("shard_bytes"))
    pages = pages.withColumn("page", F.row_number().over(Window.partitionBy("_h").orderBy("_part", "_page", "_alone")).cast("long"))
    return filled.join(pages, ["_h", "_part", "_page", "_alone"]).select("doc_id", "n_bytes", "_h", F.lit(BITS).alias("depth"), "shard_bytes", "page", *keys)


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> str:
    """Writes the documents under one folder a shard; returns the folders' column: shard_id, with as many _ behind it as keep it apart from the documents' own columns.

    Rows are numbered in a written table and find their shard by number, so that those of one doc_id, or of none,
    go to the pages that they were dealt to.
    """
    scratch = Scratch(docs.sparkSession)
    name, taken = "shard_id", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc")
    numbered = scratch.put(_sized(docs, row, F.monotonically_increasing_id().alias("_row")), "numbered")
    ids = scratch.put(_assigned(numbered.drop("_doc"), limit, scratch, ("_row",)).select("_row", F.col("shard_id").alias("_shard")), "ids")
    named = numbered.select("_row", "_doc").join(ids, "_row").select("_doc.*", F.col("_shard").alias(name))
    named.repartition(name).write.partitionBy(name).mode("overwrite").parquet(path)
    scratch.drop("numbered", "ids")
    return name


#: A limit at which small tables have many shards, for the queries beside the production one.
SMALL_LIMIT = 64 * 1024


def op4_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(read(spark, sf_dir, "documents"))


def small_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(read(spark, sf_dir, "documents"), SMALL_LIMIT)


def small_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return directory(assign(read(spark, sf_dir, "documents"), SMALL_LIMIT))


def oracle(limit: int) -> str:
    """Documents of different hashes; one larger than the limit goes on page 1 of the whole hash."""
    return f"""
WITH sized AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents
), up AS (
  SELECT h, n_bytes, depth, h >> (60 - depth) AS prefix FROM sized, (SELECT unnest(range(0, 33)) AS depth)
), fits AS (
  SELECT depth, prefix, CAST(sum(n_bytes) AS BIGINT) AS total FROM up GROUP BY ALL HAVING sum(n_bytes) <= {limit}
), leaf AS (
  SELECT h, min(depth) AS depth FROM (SELECT DISTINCT h, depth, prefix FROM up) JOIN fits USING (depth, prefix) GROUP BY h
), placed AS (
  SELECT doc_id, n_bytes, h, coalesce(l.depth, 60) AS depth, CASE WHEN l.depth IS NULL THEN 1 ELSE 0 END AS page, coalesce(f.total, n_bytes) AS shard_bytes
  FROM sized s LEFT JOIN leaf l USING (h) LEFT JOIN fits f ON f.depth = l.depth AND f.prefix = h >> (60 - l.depth)
)
SELECT doc_id, n_bytes, CAST(depth AS INTEGER) AS depth, substr(lpad(bin(h), 60, '0'), 1, depth) AS prefix, CAST(page AS BIGINT) AS page,
       's' || substr(lpad(bin(h), 60, '0'), 1, depth) || CASE WHEN page > 0 THEN '-1' ELSE '' END AS shard_id, CAST(shard_bytes AS BIGINT) AS shard_bytes
FROM placed
"""


ORACLE = oracle(LIMIT)
SMALL_ORACLE = oracle(SMALL_LIMIT)
DIRECTORY_ORACLE = f"""
WITH assigned AS ({SMALL_ORACLE}), deepest AS (SELECT coalesce(max(depth), 0) AS global_depth FROM assigned)
SELECT shard_id, prefix, depth, page, count(*) AS n_docs, max(shard_bytes) AS shard_bytes, global_depth, CAST(1 AS BIGINT) << (global_depth - depth) AS slots,
       CASE WHEN depth > 0 THEN CAST('0b' || prefix AS BIGINT) ELSE 0 END * (CAST(1 AS BIGINT) << (global_depth - depth)) AS first_slot
FROM assigned, deepest GROUP BY ALL
"""
