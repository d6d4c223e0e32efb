"""Mixing sources to target weights by iterative proportional fitting.

Documents fall in cells of source, language and topic. The cells' token counts are raked: scaled to the
source shares, then to the language shares, then to the topic shares, again and again until all three hold. A
cell's factor (fitted over counted tokens) sets the probability of its documents; the probabilities are calibrated so that
the expected tokens are the budget: where a factor asks for more than a cell has, its documents are all taken and the rest
is shared out by factor. A document is taken if a hash of its id is below its probability, so a run can be repeated, and
a larger budget takes a superset.

A token is a word: a run of bytes that aren't white space. Topics are learned from the corpus: k-means over hashed word profiles, less the mean profile of
their language (so that a topic isn't a language again), fitted on every row with words; every text then goes to its nearest centre. One pass reads
the texts and writes their word counts by hash (512 bytes a row before compression); each round of k-means is a pass over these. Sums are of integers,
so that the centres don't depend on partitions. A language has a mean of its own if it has one row in ``RARE`` with words at least; rarer ones share the mean of all.

Only the cells come to the driver, up to ``max_cells`` of them, which don't grow with the documents. More cells (sources that are
hosts, say) are raked by grouped sums and joins on the executors, to the same weights.

Targets, by axis: shares by category (categories without tokens are left out, categories without a target keep their counted
share), or a number: the counted share to that power, 0 for equal shares. Where no weights meet all targets (a source in one language only, say), the last
axis holds and the others are as near as ``ROUNDS`` rounds bring them; both ways of raking stop by the same rule.

Defined results: null source, language or text count as '' (a text without words has 0 tokens, the topic 'none', and its cell's probability); rows with null
doc_id hash as the empty id; repeated rows are taken or left together; an empty table gives no rows; other
columns are ignored in ``mixing_weights`` and kept in ``sample``, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.llm.common import Scratch, map_slices, read, text_slices, texts_of
from quarrymill.llm.words import WordHashes, doc_of, mix, word_hashes

BUDGET = 0.8
TEMPER = 0.7
MAX_CELLS = 200_000
AXES = ("source", "lang", "topic")
#: The mix that the queries ask for: sources nearer to each other than they are, languages by weight, topics nearer to each other.
TARGETS: dict[str, dict[str, float] | float] = {"source": 0.5, "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}, "topic": 0.7}
#: Raking ends after so many rounds, or when no factor of a round is further than this from 1.
ROUNDS, CLOSE = 200, 1e-9
TOPICS = 8
#: Languages with less than one row in so many have no mean of their own, so there are at most so many means.
RARE = 10_000
#: Profiles are added up in units of 2**-UNIT.
UNIT = 24
PROFILE_BITS = 7
_BITS = 52

_cache = WordHashes()


def uniform(seed: str) -> Column:
    """A number in [0, 1) from doc_id."""
    hexes = F.substring(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f"/{seed}"))), 1, _BITS // 4)
    return F.conv(hexes, 16, 10).cast("double") / F.lit(float(1 << _BITS))


# --- topics ------------------------------------------------------------------------------------------------------


def counts_of(texts: list[bytes]) -> np.ndarray:
    """The word counts of each text by hash."""
    h, ends = word_hashes([t.lower() for t in texts], _cache)
    size = 1 << PROFILE_BITS
    at = doc_of(ends) * size + (mix(h) >> np.uint64(64 - PROFILE_BITS)).astype(np.int64)
    return np.bincount(at, minlength=len(texts) * size).reshape(len(texts), size)


def profile(counts: np.ndarray) -> np.ndarray:
    """The roots of counts, of length 1 (0 without words)."""
    return np.sqrt(counts / np.maximum(1, counts.sum(1))[:, None])


def profiles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The number of words of each text, and its profile."""
    counts = counts_of(texts)
    return counts.sum(1), profile(counts)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Rounded, since products in batches of different sizes may differ in the last bits."""
    return np.round(x @ centres.T * 2 - (centres**2).sum(1), 6).argmax(1)


@dataclass
class Topics:
    """centres: of the profiles less the mean of their language."""

    means: dict[str, np.ndarray]
    mean: np.ndarray
    centres: np.ndarray

    def less_language(self, x: np.ndarray, langs: list[str]) -> np.ndarray:
        return x - np.array([self.means.get(g, self.mean) for g in langs]).reshape(x.shape)

    def of(self, words: np.ndarray, x: np.ndarray, langs: list[str]) -> list[str]:
        if not len(self.centres):
            return ["topic0" if n else "none" for n in words.tolist()]
        near = nearest(self.less_language(x, langs), self.centres)
        return [f"topic{i}" if n else "none" for i, n in zip(near.tolist(), words.tolist())]


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    counts = counts_of(texts_of(batch))
    get = lambda c: batch.column(batch.schema.get_field_index(c))
    rows = counts.astype("<u4")
    return pa.RecordBatch.from_arrays([get("doc_id"), get("source"), get("lang"), pa.array(counts.sum(1), pa.int64()), pa.array([r.tobytes() for r in rows], pa.binary())], ["doc_id", "source", "lang", "words", "counts"])


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _profiled(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, source, lang, number of words, their counts by hash, and a hash of the row, of every row, written."""
    rows = docs.select(F.col("doc_id").cast("long"), _text("source").alias("source"), _text("lang").alias("lang"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(map_slices(_counted), "doc_id long, source string, lang string, words long, counts binary")
    return scratch.put(found.withColumn("hash", F.xxhash64("doc_id", "lang", "counts")), "profiles")


def _read_counts(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("counts"))
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, 1 << PROFILE_BITS).astype(np.int64)


def _slices(batches):
    for batch in batches:
        for a in range(0, batch.num_rows, 4_000):
            yield batch.slice(a, 4_000)


def _units(x: np.ndarray) -> np.ndarray:
    return np.rint(x * (1 << UNIT)).astype(np.int64)


def _language_sums(batches):
    """The sum of the profiles of each language in a slice."""
    for batch in _slices(batches):
        langs, at = np.unique(np.array(batch.column(batch.schema.get_field_index("lang")).to_pylist(), object), return_inverse=True)
        x = _units(profile(_read_counts(batch)))
        for i, g in enumerate(langs.tolist()):
            own = x[at == i]
            yield pa.RecordBatch.from_arrays([pa.array([g], pa.string()), pa.array([len(own)], pa.int64()), pa.array([own.sum(0)], pa.list_(pa.int64()))], ["lang", "n", "sums"])


def _drawn(batches, topics, turn: int):
    """Of a task's rows the first to come, when each waits for a time of mean 1 / squared distance to its nearest centre: so the first of all is drawn by that weight."""
    best = None
    for batch in _slices(batches):
        langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
        counts, c = _read_counts(batch), topics.value.centres
        x = topics.value.less_language(profile(counts), langs)
        far = np.round(((x[:, None, :] - c) ** 2).sum(2).min(1), 9) if len(c) else np.ones(len(x))
        h = batch.column(batch.schema.get_field_index("hash")).to_numpy(zero_copy_only=False).view(np.uint64)
        u = (mix(h + np.uint64(turn + 1) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64)
        wait = np.where(far > 1e-9, -np.log((u + 1) / float((1 << 53) + 1)) / np.maximum(far, 1e-9), np.inf)
        for i in np.flatnonzero(wait == wait.min()):
            row = (float(wait[i]), langs[i], counts[i].astype("<u4").tobytes())
            if np.isfinite(row[0]) and (best is None or row < best):
                best = row
    if best:
        yield pa.RecordBatch.from_arrays([pa.array([best[0]]), pa.array([best[1]], pa.string()), pa.array([best[2]], pa.binary())], ["wait", "lang", "counts"])


def _cluster_sums(batches, topics):
    """The number of a task's rows by nearest centre, and their sums."""
    c = topics.value.centres
    n, sums = np.zeros(len(c), np.int64), np.zeros(c.shape, np.int64)
    for batch in _slices(batches):
        x = topics.value.less_language(profile(_read_counts(batch)), batch.column(batch.schema.get_field_index("lang")).to_pylist())
        near, units = nearest(x, c), _units(x)
        n += np.bincount(near, minlength=len(c))
        for i in range(len(c)):
            sums[i] += units[near == i].sum(0)
    yield pa.RecordBatch.from_arrays([pa.array([n], pa.list_(pa.int64())), pa.array([sums.ravel()], pa.list_(pa.int64()))], ["n", "sums"])


def _language_means(full: DataFrame) -> tuple[dict[str, np.ndarray], np.ndarray] | None:
    """The mean profile of each language that isn't rare, and of all rows; none without rows."""
    size = 1 << PROFILE_BITS
    parts = full.select("lang", "counts").mapInArrow(_language_sums, "lang string, n long, sums array<long>")
    sums = parts.groupBy("lang").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(size)))
    sums = sums.select("lang", "n", F.array(*(f"s{i}" for i in range(size))).alias("sums")).persist()
    try:
        total, *all_ = sums.agg(F.sum("n"), *(F.sum(F.col("sums")[i]) for i in range(size))).first()
        if not total:
            return None
        own = sums.where(F.col("n") * F.lit(RARE) >= F.lit(total)).collect()  # RARE rows at most
    finally:
        sums.unpersist()
    mean = lambda s, n: np.array(s, np.float64) / n / (1 << UNIT)
    return {r["lang"]: mean(r["sums"], r["n"]) for r in sorted(own)}, mean(all_, total)


def _k_means(full: DataFrame, topics: Topics, k: int, rounds: int = 30) -> np.ndarray:
    """Centres of all rows, the largest cluster first. A task sends one row a round, of 1 kB a centre at most."""
    context = full.sparkSession.sparkContext
    size = 1 << PROFILE_BITS

    def passed(run, schema: str, *columns: str) -> list:
        shared = context.broadcast(topics)
        try:
            return full.select(*columns, "lang", "counts").mapInArrow(partial(run, topics=shared), schema).collect()
        finally:
            shared.unpersist()

    for turn in range(k):
        rows = passed(partial(_drawn, turn=turn), "wait double, lang string, counts binary", "hash")
        if not rows:
            break
        _, lang, counts = min((r["wait"], r["lang"], bytes(r["counts"])) for r in rows)
        x = topics.less_language(profile(np.frombuffer(counts, "<u4").astype(np.int64)[None]), [lang])
        topics.centres = np.vstack([topics.centres, x])
    n = np.zeros(len(topics.centres), np.int64)
    for _ in range(rounds):
        rows = passed(_cluster_sums, "n array<long>, sums array<long>")
        n = sum(np.array(r["n"], np.int64) for r in rows)
        sums = sum(np.array(r["sums"], np.int64) for r in rows).reshape(-1, size)
        before = topics.centres
        topics.centres = np.where(n[:, None] > 0, sums / np.maximum(1, n)[:, None] / (1 << UNIT), before)
        if np.array_equal(before, topics.centres):
            break  # further rounds change nothing
    return topics.centres[np.argsort(-n, kind="stable")]


def _fitted_topics(profiled: DataFrame, k: int = TOPICS) -> Topics:
    full, size = profiled.where("words > 0"), 1 << PROFILE_BITS
    means = _language_means(full)
    if means is None:
        return Topics({}, np.zeros(size), np.empty((0, size)))
    out = Topics(*means, np.empty((0, size)))
    out.centres = _k_means(full, out, k)
    return out


def fit_topics(docs: DataFrame, k: int = TOPICS) -> Topics:
    """Fitted on all rows with words."""
    scratch = Scratch(docs.sparkSession)
    out = _fitted_topics(_profiled(docs, scratch), k)
    scratch.drop("profiles")
    return out


def _marks(batches, topics):
    for batch in _slices(batches):
        get = lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: E731, B023
        names = topics.value.of(get("words").to_numpy(), profile(_read_counts(batch)), get("lang").to_pylist())
        yield pa.RecordBatch.from_arrays([get("doc_id"), get("source"), get("lang"), pa.array(names, pa.string()), get("words")], ["doc_id", *AXES, "tokens"])


def _marked(docs: DataFrame, topics: Topics | None, scratch: Scratch) -> tuple[DataFrame, Topics]:
    """doc_id, source, lang, topic and tokens of every row, written; and the topics, fitted where there are none."""
    profiled = _profiled(docs, scratch)
    topics = topics or _fitted_topics(profiled)
    shared = docs.sparkSession.sparkContext.broadcast(topics)  # centres, and RARE means at most
    out = scratch.put(profiled.drop("hash").mapInArrow(partial(_marks, topics=shared), "doc_id long, source string, lang string, topic string, tokens long"), "marks")
    scratch.drop("profiles")
    return out, topics


def _append_topic(batches, topics, field: int):
    """field: the place of the text in the row, which is sent once."""
    for whole in batches:
        text = pc.struct_field(whole.column(whole.schema.get_field_index("_row")), [field]).cast(pa.string())
        for batch in text_slices([whole.append_column("_text", text)], "_text"):
            words, x = profiles(texts_of(batch, "_text"))
            names = topics.value.of(words, x, batch.column(batch.schema.get_field_index("lang")).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(names, pa.string())], [*whole.schema.names, "topic"])


# --- raking ------------------------------------------------------------------------------------------------------


def rake(counts: np.ndarray, axes: list[np.ndarray], targets: list[np.ndarray], rounds: int = ROUNDS, close: float = CLOSE) -> np.ndarray:
    """Cell weights, in proportion to counts within a cell's categories, with the target shares on every axis.

    axes: each cell's category on each axis; targets: shares by category.
    """
    w = counts / counts.sum()
    for _ in range(rounds):
        worst = 0.0
        for at, target in zip(axes, targets):
            now = np.bincount(at, weights=w, minlength=len(target))
            factor = np.divide(target, now, out=np.ones_like(now), where=now > 0)
            worst = max(worst, float(np.abs(factor - 1).max(initial=0)))
            w = w * factor[at]
        if worst < close:
            break
    return w


def probabilities(counts: np.ndarray, weights: np.ndarray, budget: float) -> np.ndarray:
    """Inclusion probabilities min(1, c * weight / count) with expected tokens ``budget``."""
    factor = weights / counts
    order = np.argsort(-factor, kind="stable")
    c, f = counts[order], factor[order]
    # With the first k cells taken whole, the others share what is left in proportion to their weight.
    taken = np.concatenate([[0.0], np.cumsum(c)[:-1]])
    rest = np.cumsum((c * f)[::-1])[::-1]
    scale = np.maximum(0, budget - taken) / rest
    fits = np.flatnonzero(scale * f <= 1 + 1e-15)
    p = np.ones(len(c))
    if len(fits):
        k = fits[0]
        p[k:] = np.minimum(1, scale[k] * f[k:])
    out = np.empty(len(c))
    out[order] = p
    return out


def _share(names: list[str], seen: np.ndarray, wish: dict[str, float] | float) -> np.ndarray:
    out = np.array([max(0.0, wish.get(n, s)) for n, s in zip(names, seen)]) if isinstance(wish, dict) else seen**wish
    return out / out.sum()


def _fitted(marked: DataFrame, targets: dict | None, budget: float, temper: float, max_cells: int, scratch: Scratch, rounds: int = ROUNDS) -> DataFrame:
    """(source, lang, topic, weight, probability) of every cell."""
    spark = marked.sparkSession
    wishes = {a: (targets or {}).get(a, temper) for a in AXES}
    cells = scratch.put(marked.groupBy(*AXES).agg(F.sum("tokens").alias("n")), "cells")
    if cells.count() > max_cells:
        return _fitted_on_executors(cells, wishes, budget, scratch, rounds)
    table = sorted(cells.collect(), key=lambda r: (r["source"], r["lang"], r["topic"]))
    schema = "source string, lang string, topic string, weight double, probability double"
    full = [r for r in table if r["n"]]
    known = {}
    if full:
        counts = np.array([float(r["n"]) for r in full])
        axes, shares = [], []
        for a in AXES:
            names, at = np.unique(np.array([r[a] for r in full], object), return_inverse=True)
            axes.append(at), shares.append(_share(names.tolist(), np.bincount(at, weights=counts) / counts.sum(), wishes[a]))
        weights = rake(counts, axes, shares, rounds)
        p = probabilities(counts, weights, budget * counts.sum())
        known = {tuple(r[a] for a in AXES): (float(w), float(q)) for r, w, q in zip(full, weights, p)}
    rows = [(*(key := tuple(r[a] for a in AXES)), *known.get(key, (0.0, float(min(1.0, budget))))) for r in table]
    return F.broadcast(spark.createDataFrame(rows, schema))  # max_cells rows at most


def _fitted_on_executors(cells: DataFrame, wishes: dict, budget: float, scratch: Scratch, rounds: int = ROUNDS, close: float = CLOSE) -> DataFrame:
    """The same by grouped sums of each axis and joins of their factors; each round is a written table, and the driver sees a few sums."""
    spark = cells.sparkSession
    full = cells.where("n > 0")
    total = float(full.agg(F.sum("n")).first()[0] or 0)
    shares = {}
    for a in AXES:
        seen = full.groupBy(a).agg((F.sum("n") / F.lit(total)).alias("seen"))
        if isinstance(wishes[a], dict):
            wished = spark.createDataFrame([(k, float(v)) for k, v in wishes[a].items()] or [("", 0.0)], f"{a} string, wish double").where(F.lit(bool(wishes[a])))
            raw = seen.join(wished, a, "left").select(a, F.greatest(F.lit(0.0), F.coalesce("wish", "seen")).alias("s"))
        else:
            raw = seen.select(a, F.pow("seen", F.lit(float(wishes[a]))).alias("s"))
        raw = scratch.put(raw, f"wish_{a}")
        shares[a] = raw.select(a, (F.col("s") / F.lit(float(raw.agg(F.sum("s")).first()[0] or 1))).alias("share"))
    now = full.withColumn("weight", F.col("n") / F.lit(total))
    for turn in range(rounds):
        now = now.withColumn("_far", F.lit(0.0))
        for a in AXES:
            factor = now.groupBy(a).agg(F.sum("weight").alias("_s")).where("_s > 0").join(shares[a], a).select(a, (F.col("share") / F.col("_s")).alias("_f"))
            now = now.join(factor, a, "left").withColumns({"weight": F.col("weight") * F.coalesce("_f", F.lit(1.0)), "_far": F.greatest("_far", F.abs(F.coalesce("_f", F.lit(1.0)) - 1))}).drop("_f")
        now = scratch.put(now, f"raked{turn}")
        far = now.agg(F.max("_far")).first()[0]
        now = now.drop("_far")
        scratch.drop(*([f"raked{turn - 1}"] if turn else []))
        if far is None or far < close:
            break
    # Cells whose factor asks for more than they have are taken whole; what is left of the budget raises the others' scale.
    factor, scale = F.col("weight") / F.col("n"), budget * total
    while True:
        over = factor * F.lit(scale) >= 1
        taken, rest = now.agg(F.sum(F.when(over, F.col("n"))), F.sum(F.when(~over, F.col("weight")))).first()
        new = max(0.0, budget * total - float(taken or 0)) / rest if rest else scale
        if new <= scale * (1 + 1e-12):
            break
        scale = new
    fitted = now.select(*AXES, "weight", F.least(F.lit(1.0), factor * F.lit(scale)).alias("probability"))
    return cells.select(*AXES).join(fitted, list(AXES), "left").select(*AXES, F.coalesce("weight", F.lit(0.0)).alias("weight"), F.coalesce("probability", F.lit(float(min(1.0, budget)))).alias("probability"))


def mixing_weights(docs: DataFrame, targets: dict | None = None, budget: float = BUDGET, temper: float = TEMPER, seed: str = "mix", max_cells: int = MAX_CELLS, topics: Topics | None = None, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, source, lang, topic, tokens, weight (the fitted share of the cell), probability and kept of every row."""
    scratch = Scratch(docs.sparkSession)
    marked, _ = _marked(docs, topics, scratch)
    cells = _fitted(marked, targets, budget, temper, max_cells, scratch, rounds)
    return marked.join(cells, list(AXES)).select("doc_id", *AXES, "tokens", "weight", "probability", (uniform(seed) < F.col("probability")).alias("kept"))


def sample(docs: DataFrame, targets: dict | None = None, budget: float = BUDGET, temper: float = TEMPER, seed: str = "mix", max_cells: int = MAX_CELLS, topics: Topics | None = None, rounds: int = ROUNDS) -> DataFrame:
    """The documents taken, in their own columns. A second pass finds the topics again, which is less work than to write all rows or join them by id."""
    scratch = Scratch(docs.sparkSession)
    found, topics = _marked(docs, topics, scratch)
    cells = _fitted(found, targets, budget, temper, max_cells, scratch, rounds).select(*AXES, "probability")
    shared = docs.sparkSession.sparkContext.broadcast(topics)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), _text("source").alias("source"), _text("lang").alias("lang"), uniform(seed).alias("_u"))
    schema = T.StructType([*rows.schema.fields, T.StructField("topic", T.StringType())])
    field = [c.lower() for c in docs.columns].index("text")
    marked = rows.mapInArrow(partial(_append_topic, topics=shared, field=field), schema)
    return marked.join(cells, list(AXES)).where("_u < probability").select("_row.*")


def op8_ipf_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_weights(read(spark, sf_dir, "documents"), TARGETS)
