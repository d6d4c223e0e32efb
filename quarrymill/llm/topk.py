"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length: a class holds lengths within a factor of 10/9. Inside a class they are grouped by direction: each vector
goes to the nearest of some pivots (centres of a bounded sample), and the group keeps its widest angle to the pivot. Large groups are dealt into blocks
of bounded bytes by a hash, so that no class, however common, is one task's. Queries take a first threshold
from the longest vectors (a bounded sample; its k-th best product is a lower bound of the true one), and
go only to groups whose greatest length, at the least angle that the group's cone leaves, can still reach it. Where the vectors have one length and no
directions in common, nothing can be skipped, and every query meets every block. Inside a block, buckets run from long to short. Each bucket
turns a query's threshold into a local cosine threshold; above 1 the bucket is skipped, high thresholds
prune by the feasible intervals of a few coordinates, low ones by length alone, and what is left is verified with exact
integer products that raise the threshold for the next bucket (the LEMP scheme of Teflioudi and others).

Queries are a stated set and meet the rows in blocks: a block pair holds about BLOCK_BYTES of queries and as much of vectors.

Defined results: vectors null or with null or non-finite components take no part, nor do rows with null vec_id;
an empty vector and a zero vector score 0; vectors of different dimension don't meet; a vec_id that repeats is a candidate
with each of its rows, never for itself, and is one query with the least of its vectors; ties go to the smaller
vec_id; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import Scratch, read

K = 10
SCALE = 1024
#: Bytes (8 a component) of the vectors, and of the queries, of a block pair.
BLOCK_BYTES = 16_000_000
SEED_ROWS = 2_048
#: Vectors that the pivots are found on, vectors for each pivot, and pivots at most.
PIVOT_SAMPLE = 2_048
PIVOT_ROWS = 16_384
PIVOTS = 256
BUCKET_ROWS = 1_024
#: From this local cosine threshold on, coordinates prune better than lengths.
COORDINATE_FROM = 0.75
FOCUS = 3
_STEP = 10 / 9
_SLACK = 1 + 1e-9


def integer_vectors(df: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v, norm2, dim): floor(scale * x) of each component, for vectors that are whole and finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    kept = df.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("e")).where(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & ~F.exists("e", bad))
    ints = kept.select("vec_id", F.transform("e", lambda x: F.floor(x * F.lit(float(scale))).cast("long")).alias("v"))
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return ints.select("vec_id", "v", norm2.alias("norm2"), F.size("v").alias("dim"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(array)
    flat = array.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n else np.empty((0, 0), np.int64)


class _Best:
    """The k best of each query so far: scores and ids, best first, ties to smaller ids."""

    def __init__(self, ids: np.ndarray, floor: np.ndarray, k: int):
        self.ids, self.floor, self.k = ids, floor, k
        self.score = [np.empty(0, np.int64)] * len(ids)
        self.vec = [np.empty(0, np.int64)] * len(ids)

    def add(self, q: int, score: np.ndarray, vec: np.ndarray) -> None:
        own = (vec != self.ids[q]) & (score >= self.floor[q])
        if not own.any():
            return
        s, v = np.concatenate([self.score[q], score[own]]), np.concatenate([self.vec[q], vec[own]])
        best = np.lexsort((v, -s))[: self.k]
        self.score[q], self.vec[q] = s[best], v[best]
        if len(best) == self.k:
            self.floor[q] = max(self.floor[q], s[best[-1]])


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact integer products; in floating point where every partial sum is an exact integer there."""
    if q.size == 0 or p.size == 0:
        return np.zeros((len(q), len(p)), np.int64)
    if float(np.abs(q).max()) * float(np.abs(p).max()) * q.shape[1] < 2.0**52:
        return (q.astype(np.float64) @ p.astype(np.float64).T).astype(np.int64)
    return q @ p.T


def search_block(q: np.ndarray, q_norm: np.ndarray, best: _Best, p: np.ndarray, p_norm: np.ndarray, p_id: np.ndarray) -> None:
    """Raises ``best`` with all rows p, in buckets from long to short."""
    order = np.argsort(-p_norm, kind="stable")
    p, p_norm, p_id = p[order], p_norm[order], p_id[order]
    at = 0
    unit_q = q / np.maximum(q_norm, 1e-300)[:, None]
    while at < len(p):
        longest = p_norm[at]
        end = min(len(p), at + BUCKET_ROWS, at + int(np.searchsorted(-p_norm[at:], -longest * 0.9, side="right")))
        end = max(end, at + 1)
        bucket, norms, ids = p[at:end], p_norm[at:end], p_id[at:end]
        reach = np.maximum(q_norm * longest, 1e-300)
        local = best.floor / (reach * _SLACK)
        local = np.where(best.floor <= 0, -1.0, local)
        by_coordinate = np.flatnonzero((local >= COORDINATE_FROM) & (local <= 1))
        by_length = np.flatnonzero(local < COORDINATE_FROM)
        if len(by_coordinate):
            unit = bucket / np.maximum(norms, 1e-300)[:, None]
            ranked = np.argsort(unit, axis=0)
            for i in by_coordinate.tolist():
                t = min(1.0, local[i])
                count = np.zeros(len(bucket), np.int8)
                focus = np.argsort(-np.abs(unit_q[i]))[:FOCUS]
                for f in focus.tolist():
                    c, wide = unit_q[i, f], np.sqrt(max(0.0, (1 - t * t) * (1 - unit_q[i, f] ** 2)))
                    # Cosine t to q leaves a coordinate this interval; past q's own side of the cap it is open.
                    low = c * t - wide if c > -t else -1.0
                    high = c * t + wide if c < t else 1.0
                    sorted_f = unit[ranked[:, f], f]
                    a, b = np.searchsorted(sorted_f, low - 1e-9), np.searchsorted(sorted_f, high + 1e-9, side="right")
                    count[ranked[a:b, f]] += 1
                rows = np.flatnonzero(count == len(focus))
                if len(rows):
                    best.add(i, products(q[i : i + 1], bucket[rows])[0], ids[rows])
        for part in np.array_split(by_length, -(-len(by_length) // 1024)) if len(by_length) else []:
            need = best.floor[part] / np.maximum(q_norm[part], 1e-300)
            rows = len(bucket) if (best.floor[part] <= 0).any() else int(np.searchsorted(-norms * _SLACK, -need.min(), side="right"))
            scores = products(q[part], bucket[:rows])
            for j, i in enumerate(part.tolist()):
                best.add(i, scores[j], ids[:rows])
        at = end


def _unit(m: np.ndarray) -> np.ndarray:
    m = m.astype(np.float64)
    return m / np.maximum(np.sqrt((m * m).sum(1)), 1e-300)[:, None]


def find_pivots(x: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """k directions among the rows: spherical k-means from the first k of them."""
    x = _unit(x)
    pivots = x[:k]
    for _ in range(rounds if k > 1 else 0):
        near = (x @ pivots.T).argmax(1)
        pivots = _unit(np.array([x[near == i].sum(0) if (near == i).any() else pivots[i] for i in range(len(pivots))]))
    return pivots


def _by_dim(batch: pa.RecordBatch):
    dims = batch.column(batch.schema.get_field_index("dim")).to_numpy()
    for d in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == d)
        yield d, rows, _matrix(batch.column(batch.schema.get_field_index("v")).take(pa.array(rows)))


def _directed(batches, pivots):
    """Adds the nearest pivot and the cosine to it."""
    for b in batches:
        at, cos = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows)
        for d, rows, m in _by_dim(b):
            if d in pivots.value:
                c = _unit(m) @ pivots.value[d].T
                at[rows] = c.argmax(1)
                cos[rows] = c.max(1)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at), pa.array(cos)], [*b.schema.names, "pivot", "cos"])


def _floors(batches, sample, pivots, k):
    """Adds the first threshold and the cosines to all pivots."""
    ids, p = sample.value
    for b in batches:
        qid = b.column(b.schema.get_field_index("vec_id")).to_numpy()
        floor, cos = np.full(len(qid), -(2.0**62)), [[]] * len(qid)
        for d, rows, m in _by_dim(b):
            if d in pivots.value:
                for i, c in zip(rows.tolist(), (_unit(m) @ pivots.value[d].T).tolist()):
                    cos[i] = c
            if d not in p:
                continue
            for part in np.array_split(np.arange(len(rows)), -(-len(rows) // 1024)):
                s = products(m[part], p[d]).astype(np.float64)
                s[qid[rows[part]][:, None] == ids[d][None, :]] = -(2.0**62)
                if s.shape[1] >= k:
                    floor[rows[part]] = np.partition(s, -k, axis=1)[:, -k]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(floor), pa.array(cos, pa.list_(pa.float64()))], [*b.schema.names, "floor", "cosines"])


def _reaches() -> F.Column:
    """Whether the best vector that a group may hold could reach a query's threshold.

    The group's vectors lie in a cone around its pivot; the least angle to the query is what the angle to the pivot leaves.
    """
    slack = 1e-9
    to_pivot = F.least(F.lit(1.0), F.coalesce(F.get("cosines", F.col("pivot")), F.lit(1.0)) + slack)
    cone = F.greatest(F.lit(-1.0), F.col("low") - slack)
    side = lambda c: F.sqrt(F.greatest(F.lit(0.0), 1 - c * c))
    best = F.when(to_pivot >= cone, F.lit(1.0)).otherwise(to_pivot * cone + side(to_pivot) * side(cone) + slack)
    # A negative cosine is best with the shortest vector, of which nothing is known: the product is below 0.
    return (F.col("floor") <= 0) | (F.sqrt("norm2") * F.sqrt("top") * F.greatest(F.lit(0.0), best) * _SLACK >= F.col("floor"))


def _block(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """left: queries; right: vectors."""
    names = ["query_id", "vec_id", "score"]
    if not left.num_rows or not right.num_rows:
        return pa.table([pa.array([], pa.int64())] * 3, names)
    q, p = _matrix(left["v"]), _matrix(right["v"])
    ids, floor = left["vec_id"].to_numpy(), left["floor"].to_numpy().copy()
    best = _Best(ids, floor, k)
    search_block(q, np.sqrt(left["norm2"].to_numpy()), best, p, np.sqrt(right["norm2"].to_numpy()), right["vec_id"].to_numpy())
    n = [len(s) for s in best.score]
    return pa.table([pa.array(np.repeat(ids, n)), pa.array(np.concatenate(best.vec)), pa.array(np.concatenate(best.score))], names)


def _length_class() -> F.Column:
    return F.when(F.col("norm2") > 0, F.floor(F.log(F.col("norm2")) / F.lit(2 * np.log(_STEP)))).otherwise(F.lit(-1)).cast("int")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE, block_bytes: int = BLOCK_BYTES, pivot_rows: int = PIVOT_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k largest integer inner products over all vectors but its own."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    found = _sent_and_held(spark, scratch, vectors, queries, k, scale, block_bytes, pivot_rows)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sent, held = found
    key = ["qg", "dim", "cls", "pivot", "block"]
    out = sent.groupBy(*key).cogroup(held.groupBy(*key)).applyInArrow(partial(_block, k=k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _sent_and_held(spark: SparkSession, scratch: Scratch, vectors: DataFrame, queries: DataFrame, k: int, scale: int, block_bytes: int, pivot_rows: int):
    """The queries by the blocks that they go to, and the vectors by their block and query group."""
    whole = integer_vectors(vectors, scale).withColumn("cls", _length_class())
    by_hash = whole.where("norm2 > 0").select("vec_id", "v", "dim").orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).toArrow()
    counts = {r["dim"]: r["count"] for r in whole.groupBy("dim").count().collect()}  # a row for each dimension
    if not counts:
        return None
    dims = by_hash["dim"].to_numpy()
    pivots = spark.sparkContext.broadcast({int(d): find_pivots(_matrix(by_hash["v"].take(pa.array(np.flatnonzero(dims == d)))), min(PIVOTS, -(-counts[d] // pivot_rows))) for d in np.unique(dims) if d})
    data = scratch.put(whole.mapInArrow(partial(_directed, pivots=pivots), "vec_id long, v array<long>, norm2 double, dim int, cls int, pivot int, cos double"), "vectors")
    # At most a few hundred length classes for each dimension, times the pivots.
    groups = data.groupBy("dim", "cls", "pivot").agg(F.count(F.lit(1)).alias("n"), F.max("norm2").alias("top"), F.min("cos").alias("low")).collect()

    longest = data.orderBy(F.desc("norm2"), "vec_id").limit(SEED_ROWS).select("vec_id", "v", "dim").toArrow()
    dims = longest["dim"].to_numpy()
    rows = {int(d): np.flatnonzero(dims == d) for d in np.unique(dims)}
    sample = spark.sparkContext.broadcast(({d: longest["vec_id"].to_numpy()[r] for d, r in rows.items()}, {d: _matrix(longest["v"].take(pa.array(r))) for d, r in rows.items()}))
    asked = integer_vectors(queries, scale).groupBy("vec_id").agg(F.min(F.struct("v", "norm2", "dim")).alias("m")).select("vec_id", "m.*")
    asked = scratch.put(asked.mapInArrow(partial(_floors, sample=sample, pivots=pivots, k=k), "vec_id long, v array<long>, norm2 double, dim int, floor double, cosines array<double>"), "queries")

    per_block = lambda d: max(1, block_bytes // (8 * max(1, d)))
    n_asked = {r["dim"]: r["count"] for r in asked.groupBy("dim").count().collect()}
    table = [(r["dim"], r["cls"], r["pivot"], -(-r["n"] // per_block(r["dim"])), float(r["top"]), float(r["low"]), max(1, -(-n_asked.get(r["dim"], 0) // per_block(r["dim"])))) for r in groups]
    table = F.broadcast(spark.createDataFrame(table, "dim int, cls int, pivot int, blocks int, top double, low double, qgs int"))
    group = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("qgs")).cast("int").alias("qg")
    sent = asked.join(table, "dim").where(_reaches()).select(group, "dim", "cls", "pivot", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "vec_id", "v", "norm2", "floor")
    block = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.col("blocks")).cast("int").alias("block")
    held = data.join(table, ["dim", "cls", "pivot"]).select(F.explode(F.sequence(F.lit(0), F.col("qgs") - 1)).alias("qg"), "dim", "cls", "pivot", block, "vec_id", "v", "norm2")
    return sent, held


def op1_norm_bucketed_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, p.vec_id, CAST(list_inner_product(q.e, p.e) AS BIGINT) AS score
  FROM v q JOIN v p ON q.vec_id <> p.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 10
"""
