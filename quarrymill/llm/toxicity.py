"""Toxicity by a classifier chain.

Categories are predicted one after another by linear models over terms of the text; each model also gets the
probabilities of the categories before it. In training those probabilities are out of fold (a model of the other
folds made them), so that a later model sees them as uncertain as they are on new text.

Terms are words in lower case without marks around them, and their first four and five bytes, which carry stems that
inflected and coined words share. The terms that tell labelled classes apart are chosen on the training sample; whatever the
corpus, a document then is a set of at most ``terms`` known terms, read from its whole text.

Categories come from labels only: from the columns that the caller names, and ``toxic``, which comes last; a row whose category is null or no
number isn't learned from in that category. ``kinds`` makes two kinds of toxic documents from a mark of quality: ``junk`` (toxic, in a document marked as
low) and ``prose`` (toxic, in a good one); the query states these. No category is made from the terms that the models read.

The model is fitted on the driver on a bounded sample: at most ``rows`` labelled documents outside the test fold, of which those are taken in turn
whose distinct terms still fit in ``terms_in_all`` together. The terms of the out-of-fold models are chosen without the fold.

Defined results: null and empty texts have no terms and get the scores of such; equal texts have equal scores; null labels are
ignored, repeated ones averaged; of different texts under one labelled id the one of least hash is learned from; a category of one class only has its mean as probability (0 without labels);
empty tables give no rows; null doc_id stays null; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm.common import Scratch, in_use, map_slices, read, texts_of
from quarrymill.llm.quality import held_out, labelled_texts, training_ids, within

#: Bounds of the sample that the models are fitted on: documents, and their distinct terms together (8 bytes each).
TRAIN_ROWS = 4_000
TRAIN_TERMS = 4_000_000
TERMS = 1_024
FOLDS = 4
THRESHOLD = 0.5
KINDS = ("junk", "prose")
_MARKS = b".,;:!?\"'()[]{}<>*_-/\\|#%&$+="


def terms_of(word: bytes) -> tuple[int, ...]:
    """64-bit names of a word's terms: the word (even), and its stems (odd)."""
    w = word.strip(_MARKS)
    if not w:
        return ()
    name = lambda x, seed: xxhash.xxh3_64_intdigest(x, seed)
    return (name(w, 0) & ~1, *(name(w[:n], n) | 1 for n in (4, 5) if len(w) > n))


class Terms(dict):
    """word -> the places of its known terms; emptied when full."""

    LIMIT = 200_000

    def __init__(self, known: dict[int, int]):
        self.known = known

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= self.LIMIT:
            self.clear()
        out = self[word] = tuple(self.known[t] for t in terms_of(word) if t in self.known)
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Linear:
    """A logistic model; ``constant`` where the labels have one class."""

    w: np.ndarray
    b: float
    constant: float | None = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.constant) if self.constant is not None else _sigmoid(x @ self.w + self.b)


def fit_linear(x: np.ndarray, y: np.ndarray, l2: float = 2e-5, steps: int = 120, miss: float = 3.0) -> Linear:
    """miss: how much worse a missed positive is than a false one."""
    if not len(y) or y.min() == y.max():
        return Linear(np.zeros(x.shape[1]), 0.0, float(y.mean()) if len(y) else 0.0)
    x = x.astype(np.float32)
    w, m, v = (np.zeros(x.shape[1] + 1, np.float64) for _ in range(3))
    w[-1] = np.log(y.mean() / (1 - y.mean()))
    cost = np.where(y > 0.5, miss, 1.0) / len(y)
    for i in range(1, steps + 1):
        d = ((_sigmoid(x @ w[:-1].astype(np.float32) + w[-1]) - y) * cost).astype(np.float32)
        g = np.append(x.T @ d, d.sum()) + l2 * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - 0.25 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-9)
    return Linear(w[:-1], float(w[-1]))


@dataclass
class Chain:
    known: dict[int, int] = field(default_factory=dict)
    names: tuple[str, ...] = ("toxic",)
    models: list[Linear] = field(default_factory=list)
    #: Out-of-fold probabilities of the last category and its labels, of the rows that were learned from.
    apart: tuple[np.ndarray, np.ndarray] | None = None

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), 0))
        for model in self.models:
            out = np.column_stack([out, model.predict(np.column_stack([x, out]))])
        return out


def fit_chain(x: np.ndarray, y: np.ndarray, fold: np.ndarray, folds: int = FOLDS, views: list[np.ndarray] | None = None) -> tuple[list[Linear], np.ndarray]:
    """One model a column of y (nan: no label), and the out-of-fold probabilities of all columns; each model gets those of the columns before its own.

    views: for each fold, x by terms that were chosen without it.
    """
    apart, models = np.empty((len(x), 0)), []
    for c in range(y.shape[1]):
        has, own = ~np.isnan(y[:, c]), np.empty(len(x))
        for k in range(folds):
            z, train = np.column_stack([views[k] if views else x, apart]), (fold != k) & has
            own[fold == k] = fit_linear(z[train], y[train, c]).predict(z[fold == k])
        models.append(fit_linear(np.column_stack([x, apart])[has], y[has, c]))
        apart = np.column_stack([apart, own])
    return models, apart


def choose_terms(docs: list[np.ndarray], y: np.ndarray, most: int = TERMS) -> dict[int, int]:
    """The terms that tell the classes apart best: by signed chi-squared of presence, in three documents at least."""
    if not docs or not len(y) or y.min() == y.max():
        return {}
    flat = np.concatenate(docs)
    of = np.repeat(y, [len(d) for d in docs])
    names, place = np.unique(flat, return_inverse=True)
    pos, all_ = np.bincount(place, weights=of, minlength=len(names)), np.bincount(place, minlength=len(names))
    n, p = len(y), y.sum()
    expected = all_ * p / n
    score = (pos - expected) / np.sqrt(expected * (1 - p / n) + 1)
    odds = np.log((pos + 0.5) / (all_ - pos + 0.5)) - np.log(p / (n - p))
    good = np.flatnonzero((all_ >= 3) & (score > 2) & (odds > 1))
    good = good[np.lexsort((names[good], -score[good]))][:most]
    return {int(t): i for i, t in enumerate(np.sort(names[good]).tolist())}


def choose_all(docs: list[np.ndarray], y: np.ndarray, most: int = TERMS) -> dict[int, int]:
    """The terms that tell the classes of some column of y apart: half of them for the last one, an equal share for each other."""
    names: set[int] = set()
    others = y.shape[1] - 1
    for c, of in enumerate(y.T):
        has = np.flatnonzero(~np.isnan(of))
        share = most if not others else most // 2 if c == others else most // 2 // others
        names |= choose_terms([docs[i] for i in has], of[has], share).keys()
    return {t: i for i, t in enumerate(sorted(names))}


def design(term_sets: list[set[int]], size: int) -> np.ndarray:
    """Presence of each known term. Not their number: one telling word is enough, in a text of any length."""
    x = np.zeros((len(term_sets), size), np.float32)
    for i, s in enumerate(term_sets):
        x[i, list(s)] = 1
    return x


def _training(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = []
    for t in texts_of(batch):
        own = t.lower().split()
        sets.append(np.array(sorted({x for w in set(own) for x in terms_of(w)}), np.uint64).view(np.int64))
    get = lambda n: batch.column(batch.schema.get_field_index(n))
    return pa.RecordBatch.from_arrays([get("doc_id"), get("y"), get("marks"), pa.array([len(v) for v in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "y", "marks", "size", "terms"])


def kinds(labels: DataFrame) -> DataFrame:
    """doc_id, toxic and the kinds of toxic documents by the labels' mark of quality."""
    number = lambda c: F.col(c).try_cast("double")
    return labels.select("doc_id", "toxic", (number("toxic") * (1 - number("quality"))).alias("junk"), (number("toxic") * number("quality")).alias("prose"))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, most: int = TERMS, categories: tuple[str, ...] = (), terms_in_all: int = TRAIN_TERMS) -> Chain:
    """categories: the columns of labels that come before ``toxic`` in the chain."""
    found = {c: F.col(f"`{c}`").try_cast("double") for c in categories}
    ids = training_ids(labels, "toxic", rows)
    own = labels.select(F.col("doc_id").cast("long"), *(c.alias(f"_{i}") for i, c in enumerate(found.values())))
    marks = own.groupBy("doc_id").agg(F.array(*(F.avg(f"_{i}") for i in range(len(found)))).cast("array<double>").alias("marks"))
    scratch = Scratch(docs.sparkSession)
    ids = scratch.put(ids.join(marks, "doc_id"), "ids")
    sample = labelled_texts(docs, ids).select("doc_id", "y", "marks", "text")
    sample = scratch.put(sample.mapInArrow(map_slices(_training), "doc_id long, y double, marks array<double>, size long, terms array<long>"), "sample")
    table = within(sample, terms_in_all).toArrow().sort_by([("doc_id", "ascending")])
    scratch.drop("ids", "sample")
    y = np.round(np.column_stack([np.array(table["marks"].to_pylist(), np.float64).reshape(len(table), len(found)), table["y"].to_numpy()]))
    docs_terms = [np.asarray(v.values, np.int64).view(np.uint64) for v in table["terms"]]

    def view(at: np.ndarray) -> tuple[dict[int, int], np.ndarray]:
        """The terms chosen on the rows ``at``, and all rows by them."""
        known = choose_all([docs_terms[i] for i in np.flatnonzero(at)], y[at], most)
        return known, design([{known[t] for t in d.tolist() if t in known} for d in docs_terms], len(known))

    fold = np.array([xxhash.xxh3_64_intdigest(str(i)) % FOLDS for i in table["doc_id"].to_pylist()], np.int64)
    known, x = view(np.ones(len(fold), bool))
    models, apart = fit_chain(x, y, fold, views=[view(fold != k)[1] for k in range(FOLDS)])
    return Chain(known, (*found, "toxic"), models, (apart[:, -1], y[:, -1]))


_last: list = [None, None]  # the model that this worker scores with, and its terms by word


def _scored(batch: pa.RecordBatch, chain) -> pa.RecordBatch:
    model: Chain = chain.value
    in_use("toxicity", lambda: _last.__setitem__(slice(None), [None, None]))
    if _last[0] is not model:
        _last[:] = [model, Terms(model.known)]
    cache = _last[1]
    sets = [{x for places in map(cache.__getitem__, t.lower().split()) if places for x in places} for t in texts_of(batch)]
    p = model.probabilities(design(sets, len(model.known)))
    ids = batch.column(batch.schema.get_field_index("doc_id"))
    return pa.RecordBatch.from_arrays([ids, *(pa.array(p[:, i].astype(np.float64)) for i in range(p.shape[1]))], ["doc_id", *(f"p_{n}" for n in model.names)])


def score_documents(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, a probability for each category, score (the last one) and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(replace(chain, apart=None))  # ``terms`` weights a category at most
    schema = ", ".join(["doc_id long", *(f"p_{n} double" for n in chain.names)])
    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(map_slices(partial(_scored, chain=shared)), schema)
    score = F.col(f"p_{chain.names[-1]}")
    return scored.select("doc_id", held_out().alias("held_out"), *(f"p_{n}" for n in chain.names), score.alias("score"), (score >= threshold).cast("int").alias("predicted"))


def op6_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score_documents(docs, train(docs, kinds(read(spark, sf_dir, "labels")), categories=KINDS))
