"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words. Each passage is encoded (shares of character classes, word
shapes, repetition; then a learned tanh layer), a gated attention network weighs the passages from document
labels alone, and the weighted mean of the passages' codes gets the score (Ilse, Tomczak, Welling: Attention-based deep
multiple instance learning). Only the text enters a score.

The model is fitted on every passage of every labelled document outside the test fold. One pass reads the texts and writes their features
(76 bytes a passage); those of labelled documents are put together in blocks by a hash of their ids, and each epoch is a pass over the blocks. A block's
sums are rounded to integers, so that the model doesn't depend on partitions; where the passages are few (``LOCAL``), the driver makes the passes over the
blocks, by the same code to the same model. Scoring reads every passage of every document.

Defined results: null text is empty text, one passage without words, and has a score; equal texts have equal scores;
labels that are null are ignored, and repeated labels of one document are averaged; of different texts under one labelled id the one of least hash is
learned from; without labels, or with one class
only, every score is the mean label (0.5 without any); null doc_id is not held out; empty tables give no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm.common import Scratch, map_slices, read, text_slices, texts_of
from quarrymill.llm.words import WordHashes, mix, word_hashes

PASSAGE = 100
THRESHOLD = 0.7
#: Documents of a block, about; passages (76 bytes each) up to which the driver makes the passes over the blocks.
BLOCK, LOCAL = 256, 100_000
#: Blocks are added up in units of 2**-UNIT.
UNIT = 24
HIDDEN, GATE, EPOCHS = 16, 8, 200

_cache = WordHashes()

#: Byte classes: space, line end, lower, upper, digit, full stop or comma, other sentence marks, brackets and quotes, symbols, above ASCII, control.
CLASSES = 11
_CLASS = np.full(256, 10, np.uint8)
for _i, _chars in enumerate((b" ", b"\n\r\t\x0b\x0c", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,", b"!?:;-'", b"()[]{}\"", b"#$%&*+/<=>@\\^_`|~", bytes(range(128, 256)))):
    _CLASS[list(_chars)] = _i
FEATURES = CLASSES + 8


def passages(texts: list[bytes], size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of every text, and the passages' offsets by text (one at least each)."""
    h, ends = word_hashes(texts, _cache)
    words = np.diff(ends)
    count = np.maximum(1, -(-words // size))
    first = np.cumsum([0, *count])
    total = int(first[-1])
    doc = np.repeat(np.arange(len(texts)), words)
    of_word = first[doc] + (np.arange(len(h)) - ends[doc]) // size
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)  # one line end after each text
    kind = _CLASS[data]
    blank = kind < 2
    start = ~blank
    start[1:] &= blank[:-1]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    doc_of_byte = np.repeat(np.arange(len(texts)), sizes + 1)
    word = np.cumsum(start) - 1
    # Bytes before a document's first word belong to its first passage.
    of_byte = first[doc_of_byte] if not len(h) else np.maximum(first[doc_of_byte], np.where(word >= 0, of_word[np.maximum(word, 0)], 0))
    by_class = np.bincount(of_byte.astype(np.int64) * CLASSES + kind, minlength=total * CLASSES).reshape(total, CLASSES).astype(np.float64)
    n_bytes = np.maximum(1, by_class.sum(1))
    n_words = np.bincount(of_word, minlength=total).astype(np.float64)
    some = np.maximum(1, n_words)
    inside = np.ones(len(h), bool)
    same = np.zeros(len(h), bool)
    if len(h):
        inside[0] = False
        inside[1:] = of_word[1:] == of_word[:-1]
        same[1:] = (h[1:] == h[:-1]) & inside[1:]
    distinct = np.unique(mix(h ^ mix(of_word.astype(np.uint64) + np.uint64(1))), return_index=True)[1]
    count_of = lambda at: np.bincount(of_word[at], minlength=total)
    at = np.flatnonzero(start)
    upper_first = count_of(np.flatnonzero(kind[at] == 3)) if len(at) else np.zeros(total)
    odd_first = count_of(np.flatnonzero((kind[at] >= 5) & (kind[at] <= 8))) if len(at) else np.zeros(total)
    length = (n_bytes - by_class[:, 0] - by_class[:, 1]) / some
    rest = [np.log1p(n_words), np.log1p(length), np.minimum(1, np.log1p(by_class[:, 1]) / 3), count_of(np.flatnonzero(same)) / some, count_of(distinct) / some, upper_first / some, odd_first / some, (by_class[:, 8] + by_class[:, 6] > 0.5 * n_words).astype(float)]
    return np.column_stack([np.sqrt(by_class / n_bytes[:, None]), *rest]).astype(np.float32), first


@dataclass
class Model:
    """Weights of the encoder, the gated attention and the score; ``constant`` where nothing could be learned."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        # Rounded, since products in batches of different sizes may differ in the last bits.
        return np.round(forward(self.weights, (x - self.mean) / self.scale, first)["p"], 9)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def forward(w: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    starts, per = first[:-1], np.diff(first)
    code = np.tanh(x @ w["E"] + w["e"])
    t, g = np.tanh(code @ w["V"]), _sigmoid(code @ w["U"])
    raw = (t * g) @ w["a"]
    top = np.maximum.reduceat(raw, starts)
    share = np.exp(raw - np.repeat(top, per))
    share /= np.repeat(np.add.reduceat(share, starts), per)
    bag = np.add.reduceat(code * share[:, None], starts)
    return {"code": code, "t": t, "g": g, "share": share, "bag": bag, "p": _sigmoid(bag @ w["c"] + w["b"][0])}


def gradients(w: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    f, starts, per = forward(w, x, first), first[:-1], np.diff(first)
    d = (f["p"] - y) / len(y)
    d_bag = d[:, None] * w["c"][None, :]
    spread = np.repeat(d_bag, per, axis=0)
    along = (f["code"] * spread).sum(1)
    d_raw = f["share"] * (along - np.repeat(np.add.reduceat(f["share"] * along, starts), per))
    d_t, d_g = d_raw[:, None] * w["a"] * f["g"] * (1 - f["t"] ** 2), d_raw[:, None] * w["a"] * f["t"] * f["g"] * (1 - f["g"])
    d_code = (spread * f["share"][:, None] + d_t @ w["V"].T + d_g @ w["U"].T) * (1 - f["code"] ** 2)
    return {"c": f["bag"].T @ d, "b": np.array([d.sum()]), "a": (f["t"] * f["g"]).T @ d_raw, "V": f["code"].T @ d_t, "U": f["code"].T @ d_g, "E": x.T @ d_code, "e": d_code.sum(0)}


def _blocks_of(batches):
    """(features, offsets, labels) of each block."""
    for batch in batches:
        columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("x", "sizes", "y"))
        for x, sizes, y in zip(*columns):
            x = np.frombuffer(x, "<f4").reshape(-1, FEATURES).astype(np.float64)
            yield x, np.cumsum([0, *np.frombuffer(sizes, "<i8")]), np.frombuffer(y, "<f8")


def _added(batches, sums):
    """One row for a task: ``sums`` (of features, offsets, labels) of its blocks, in units."""
    total = 0
    for block in _blocks_of(batches):
        total = total + np.rint(sums(*block) * (1 << UNIT)).astype(np.int64)
    if not np.isscalar(total):
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], ["sums"])


def _feature_sums(x, first, y) -> np.ndarray:
    return x.sum(0)


def _square_sums(x, first, y, mean) -> np.ndarray:
    return ((x - mean) ** 2).sum(0)


def _gradient_sums(x, first, y, model) -> np.ndarray:
    """Not the mean but the sum of all documents' gradients, the weights in order of their names."""
    d = gradients(model.weights, (x - model.mean) / model.scale, first, y)
    return np.concatenate([d[k].ravel() for k in sorted(d)]) * len(y)


def fit(blocks: DataFrame, n_docs: int, n_passages: int, epochs: int = EPOCHS, local: int = LOCAL, seed: int = 7) -> Model:
    """Adam over all bags at once, with weight decay; the same data give the same model. A task sends one row an epoch, of a number for each weight."""
    here = blocks.toArrow().to_batches() if n_passages <= local else None

    def summed(sums) -> np.ndarray:
        run = partial(_added, sums=sums)
        rows = [r["sums"].to_pylist()[0] for r in run(here)] if here else [r["sums"] for r in blocks.mapInArrow(run, "sums array<long>").collect()]
        return np.array(rows, object).sum(0).astype(np.float64) / (1 << UNIT)

    mean = summed(_feature_sums) / n_passages
    scale = np.sqrt(summed(partial(_square_sums, mean=mean)) / n_passages) + 0.02
    r = np.random.default_rng(seed)
    init = lambda *shape: r.normal(0, shape[0] ** -0.5, shape)
    w = {"E": init(FEATURES, HIDDEN), "e": np.zeros(HIDDEN), "V": init(HIDDEN, GATE), "U": init(HIDDEN, GATE), "a": init(GATE), "c": init(HIDDEN), "b": np.zeros(1)}
    m, v = ({k: np.zeros_like(z) for k, z in w.items()} for _ in range(2))
    names = sorted(w)
    ends = np.cumsum([w[k].size for k in names])[:-1]
    for i in range(1, epochs + 1):
        parts = np.split(summed(partial(_gradient_sums, model=Model(mean, scale, w))) / n_docs, ends)
        for k, d in zip(names, parts):
            d = d.reshape(w[k].shape) + 1e-4 * w[k] * (k != "b")
            m[k] = 0.9 * m[k] + 0.1 * d
            v[k] = 0.999 * v[k] + 0.001 * d * d
            w[k] = w[k] - 0.03 * (m[k] / (1 - 0.9**i)) / (np.sqrt(v[k] / (1 - 0.999**i)) + 1e-8)
    return Model(mean, scale, w)


def held_out() -> F.Column:
    """Rows of the test fold: crc32 of doc_id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learned_labels(labels: DataFrame, target: str) -> DataFrame:
    """(doc_id, y) of every labelled document outside the test fold."""
    own = labels.select(F.col("doc_id").cast("long"), F.col(target).cast("double").alias("y")).where("doc_id is not null and y is not null")
    return own.where(~held_out()).groupBy("doc_id").agg(F.avg("y").alias("y"))


def training_ids(labels: DataFrame, target: str, rows: int) -> DataFrame:
    """(doc_id, y) of at most ``rows`` labelled documents outside the test fold, chosen by a hash of their ids."""
    own = learned_labels(labels, target)
    return own.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(rows)


def labelled_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The columns of ``ids`` (a bounded table with one row for a doc_id) and the text of each id; one row for each, however often it repeats."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id").cast("long"), text).join(F.broadcast(ids.select("doc_id")), "doc_id")
    one = rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("_t")).select("doc_id", F.col("_t.text").alias("text"))
    return one.join(F.broadcast(ids), "doc_id")


def within(sample: DataFrame, most: int) -> DataFrame:
    """The rows of a written sample (doc_id, size, ...) that are taken in order of their ids' hashes while the sum of their sizes is at most ``most``.

    The driver gets a number for each row of the sample, whose rows are bounded.
    """
    sizes = sample.select("doc_id", "size", F.md5(F.col("doc_id").cast("string")).alias("h")).collect()
    taken, left = [], most
    for r in sorted(sizes, key=lambda r: (r["h"], r["doc_id"])):
        if r["size"] <= left:
            taken.append((r["doc_id"],))
            left -= r["size"]
    if len(taken) == len(sizes):
        return sample
    return sample.join(F.broadcast(sample.sparkSession.createDataFrame(taken, "doc_id long")), "doc_id", "left_semi")


def _featured(batch: pa.RecordBatch) -> pa.RecordBatch:
    x, first = passages(texts_of(batch))
    rows = [x[a:b].astype("<f4").tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
    get = lambda n: batch.column(batch.schema.get_field_index(n))
    return pa.RecordBatch.from_arrays([get("doc_id"), get("h"), pa.array(np.diff(first), pa.int64()), pa.array(rows, pa.binary())], ["doc_id", "h", "size", "x"])


def _block(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("doc_id")
    y, sizes = (rows[c].to_numpy().astype(t).tobytes() for c, t in (("y", "<f8"), ("size", "<i8")))
    return pa.table({"y": pa.array([y], pa.binary()), "sizes": pa.array([sizes], pa.binary()), "x": pa.array([b"".join(rows["x"].to_pylist())], pa.binary())})


def train(docs: DataFrame, labels: DataFrame, epochs: int = EPOCHS, local: int = LOCAL) -> Model:
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("doc_id is not null").where(~held_out())
    features = texts.withColumn("h", F.xxhash64("text")).mapInArrow(map_slices(_featured), "doc_id long, h long, size long, x binary")
    features = scratch.put(features, "features")
    one = features.groupBy("doc_id").agg(F.min(F.struct("h", "size", "x")).alias("_b")).select("doc_id", "_b.size", "_b.x")
    bags = scratch.put(one.join(learned_labels(labels, "quality").hint("merge"), "doc_id"), "bags")  # labels grow with the documents, so they aren't broadcast
    n, low, high, size = bags.agg(F.count("y"), F.min("y"), F.max("y"), F.sum("size")).first()
    if not n or low == high:
        model = Model(np.zeros(FEATURES), np.ones(FEATURES), {}, low if n else 0.5)
    else:
        keyed = bags.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(n // BLOCK + 1)))
        blocks = scratch.put(keyed.groupBy("block").applyInArrow(_block, "y binary, sizes binary, x binary"), "blocks")
        model = fit(blocks, n, size, epochs, local)
    scratch.drop("features", "bags", "blocks")
    return model


def _scored(batch: pa.RecordBatch, model) -> pa.RecordBatch:
    x, first = passages(texts_of(batch))
    score = model.value.score(x, first)
    return pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), pa.array(score.astype(np.float64))], ["doc_id", "score"])


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few kB
    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(map_slices(partial(_scored, model=shared)), "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _accepted(batches, model, threshold):
    for batch in text_slices(batches):
        x, first = passages(texts_of(batch))
        yield batch.filter(pa.array(model.value.score(x, first) >= threshold))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the model accepts, in their own columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(partial(_accepted, model=shared, threshold=threshold), docs.schema)


def op3_attention_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score_documents(docs, train(docs, read(spark, sf_dir, "labels")))
