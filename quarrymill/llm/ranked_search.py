"""Ranked lexical search by Fagin's threshold algorithm.

One pass over the documents makes the forward index: for each document its number of terms, and the terms that some query has with their frequencies (a
search reads no other terms). A second, small pass counts the documents of each term. Then each task builds
segments of bounded size: the forward index of some documents, and from it one list a term, sorted by impact. For a query the lists of its
terms are read in turn, a run of postings from each; each document met for the first time gets its whole score by a lookup in the forward index; the
threshold is the score that a document not met yet could still have, the weighted sum of the impacts at which the lists stand. The search of
a segment ends when the threshold falls strictly below the k-th best score so far (a document with that very score may still come first by its id), or with the
lists. A task carries its k best of each query from segment to segment, so later segments end sooner, and hands over only these.

Queries are a stated set; they are taken in blocks of about ``QUERY_BYTES`` of text, whose terms and weights go to all tasks, and a block is one pass over the documents.

Score: sum over the query's terms, repeats included, of w * ((1000000000 tf) div (1000 tf + 12 m)), where w = floor(1000 ln((2N + 2) / (2 df + 1))) and
m = 75 + (25 n N) div L, for n terms in the document, L in all N documents that have any.

Defined results: null and empty texts have no terms and are no documents; equal scores go by ascending doc_id, null last; rows that share a doc_id, and
repeated rows, are documents each on its own; each row of the queries is a query of its own, also where an item_id repeats or is null; a query without
terms, or of which no document has a term of weight above 0, gives no rows; empty tables give no rows; columns other than doc_id, item_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import Scratch, read, text_slices, texts_of

K = 20
#: Query text of one block of queries, in bytes.
QUERY_BYTES = 8_000_000
#: Postings of one segment (about 50 bytes each while it is searched).
SEGMENT = 2_000_000
#: Postings taken from each list in the first round; later rounds take more.
RUN, LONGEST_RUN = 32, 4096

#: Letters, digits and bytes of other characters stay, A-Z become small, all else parts terms.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

FORWARD = "doc_id long, n long, terms array<int>, tfs array<int>"
FOUND = "item int, item_id long, doc_id long, score long"


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: runs of letters, digits and characters beyond ASCII, with A-Z in lower case."""
    return text.translate(_TERM_BYTES).split()


def _forward(batches, known):
    """Rows of the forward index; known: the terms to keep, with their numbers."""
    get, size = known.value.get, len(known.value)
    for batch in text_slices(batches):
        words = [terms(t) for t in texts_of(batch)]
        n = np.fromiter(map(len, words), np.int64, len(words))
        number = np.fromiter((get(w, -1) for w in chain.from_iterable(words)), np.int64, int(n.sum()))
        doc = np.repeat(np.arange(len(n)), n)
        hit = number >= 0
        pair, tf = np.unique(doc[hit] * size + number[hit], return_counts=True)
        doc, number = np.divmod(pair, max(size, 1))
        at = np.searchsorted(doc, np.arange(len(n) + 1))
        lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x, pa.int32())) for x in (number, tf)]
        out = pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), pa.array(n), *lists], ["doc_id", "n", "terms", "tfs"])
        yield out.filter(pa.array(n > 0))


def _documents_of_terms(batches, size: int):
    count = np.zeros(size, np.int64)
    for b in batches:
        count += np.bincount(b.column("terms").flatten().to_numpy(), minlength=size)
    some = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(count[some])], ["term", "df"])


class Segment:
    """Forward index of some documents and their impact-sorted lists. Impacts are those of one occurrence in the query, without the term's weight."""

    def __init__(self, docs: np.ndarray, missing: np.ndarray, at: np.ndarray, term: np.ndarray, impact: np.ndarray, size: int):
        """docs: ids (any where missing); document i has postings at[i] to at[i + 1]; size: number of terms."""
        self.docs, self.missing, self.at, self.term, self.impact = docs, missing, at, term, impact
        order = np.lexsort((-impact, term))
        self.listed = np.repeat(np.arange(len(docs), dtype=np.int32), np.diff(at))[order]
        self.falling = impact[order]
        self.starts = np.searchsorted(term[order], np.arange(size + 1))

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Whole scores by lookups in the forward index; weight: by term, 0 for terms not asked for. Each document has a posting."""
        a, n = self.at[docs], self.at[docs + 1] - self.at[docs]
        begin = np.cumsum(n) - n
        every = np.repeat(a - begin, n) + np.arange(int(n.sum()))
        return np.add.reduceat(weight[self.term[every]] * self.impact[every], begin)


class Best:
    """The k best documents so far: score falling, then doc_id rising, missing ids last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.doc, self.missing = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    @property
    def last(self) -> int:
        """The k-th score; 0 as long as there are fewer."""
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, doc: np.ndarray, missing: np.ndarray) -> None:
        good = (score > 0) & (score >= self.last)
        if good.any():
            score, doc, missing = (np.concatenate(x) for x in ((self.score, score[good]), (self.doc, doc[good]), (self.missing, missing[good])))
            order = np.lexsort((doc, missing, -score))[: self.k]
            self.score, self.doc, self.missing = score[order], doc[order], missing[order]


def threshold_search(segment: Segment, asked: np.ndarray, weights: np.ndarray, weight: np.ndarray, best: Best) -> int:
    """Brings a query's best documents of a segment into ``best``; returns the postings read from the lists.

    asked: the query's terms, without repeats; weights: their weights times their occurrences; weight: zeros, by term, for the lookups.
    """
    start, stop = segment.starts[asked], segment.starts[asked + 1]
    some = (weights > 0) & (stop > start)
    asked, weights, start, stop = asked[some], weights[some], start[some], stop[some]
    weight[asked] = weights
    met = np.zeros(len(segment.docs), bool)
    read_, run = 0, RUN
    while len(asked):
        upto = np.minimum(start + run, stop)
        docs = np.concatenate([segment.listed[a:b] for a, b in zip(start.tolist(), upto.tolist())])
        read_ += len(docs)
        fresh = np.unique(docs[~met[docs]])
        met[fresh] = True
        if len(fresh):
            best.add(segment.scores(fresh, weight), segment.docs[fresh], segment.missing[fresh])
        # Documents not met yet aren't in lists that have ended, and stand below the last impact read in the others.
        threshold = int((weights * segment.falling[upto - 1])[upto < stop].sum())
        if threshold < best.last:
            break
        more = upto < stop
        asked, weights, start, stop = asked[more], weights[more], upto[more], stop[more]
        run = min(2 * run, LONGEST_RUN)
    weight[:] = 0
    return read_


def _segments(batches, n_docs: int, n_terms: int, size: int, limit: int):
    """Segments of about ``limit`` postings; a document with more is in one of its own batch."""
    held, held_postings = [], 0

    def built():
        whole = pa.Table.from_batches(held).combine_chunks()
        lists, tfs = whole.column("terms").combine_chunks(), whole.column("tfs").combine_chunks()
        docs = whole.column("doc_id").combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy())
        term, tf = lists.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.int64)
        m = 75 + (25 * whole.column("n").to_numpy() * n_docs) // n_terms
        impact = (1_000_000_000 * tf) // (1000 * tf + 12 * np.repeat(m, lengths))
        return Segment(docs.fill_null(0).to_numpy(), docs.is_null().to_numpy(zero_copy_only=False), np.cumsum([0, *lengths]), term, impact, size)

    for b in batches:
        for a in range(0, b.num_rows, 1000):
            part = b.slice(a, 1000)
            part = part.filter(pc.greater(pc.list_value_length(part.column("terms")), 0))
            if part.num_rows:
                held.append(part)
                held_postings += len(part.column("terms").flatten())
            if held_postings >= limit:
                yield built()
                held, held_postings = [], 0
    if held:
        yield built()


def _search(batches, queries, n_docs: int, n_terms: int, size: int, k: int, limit: int):
    asked = queries.value
    best = [Best(k) for _ in asked]
    weight = np.zeros(size, np.int64)
    for segment in _segments(batches, n_docs, n_terms, size, limit):
        for (_, numbers, weights), found in zip(asked, best):
            threshold_search(segment, numbers, weights, weight, found)
    for i, ((item_id, *_), found) in enumerate(zip(asked, best)):
        if m := len(found.score):
            columns = pa.array([i] * m, pa.int32()), pa.array([item_id] * m, pa.int64()), pa.array(found.doc, mask=found.missing), pa.array(found.score)
            yield pa.RecordBatch.from_arrays([*columns], ["item", "item_id", "doc_id", "score"])


def _search_block(docs: DataFrame, items: list[tuple[int | None, Counter]], k: int, segment: int, scratch: Scratch, name: str) -> DataFrame:
    spark = docs.sparkSession
    known = {t: i for i, t in enumerate(sorted({t for _, c in items for t in c}))}
    size = len(known)
    index = scratch.put(docs.mapInArrow(partial(_forward, known=spark.sparkContext.broadcast(known)), FORWARD), f"{name}-forward")
    total = index.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = total["docs"], total["terms"] or 1
    df = np.zeros(size, np.int64)
    parts = index.select("terms").mapInArrow(partial(_documents_of_terms, size=size), "term int, df long")
    for r in parts.groupBy("term").agg(F.sum("df").alias("df")).collect():  # one row a term of this block of queries
        df[r["term"]] = r["df"]
    w = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    asked = []
    for item_id, c in items:
        numbers = np.array([known[t] for t in c], np.int64)
        asked.append((item_id, numbers, w[numbers] * np.array(list(c.values()), np.int64)))
    search = partial(_search, queries=spark.sparkContext.broadcast(asked), n_docs=n_docs, n_terms=n_terms, size=size, k=k, limit=segment)
    found = index.mapInArrow(search, FOUND)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    out = scratch.put(found.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"), f"{name}-found")
    scratch.drop(f"{name}-forward")
    return out


def search(docs: DataFrame, items: DataFrame, k: int = K, query_bytes: int = QUERY_BYTES, segment: int = SEGMENT) -> DataFrame:
    """The k best documents of each item: item_id, rank (from 1), doc_id, score. docs: (doc_id, text); items: (item_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    scratch = Scratch(docs.sparkSession)
    blocks = -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // query_bytes)
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block) if blocks > 1 else items
        asked = [(r["item_id"], Counter(terms(r["text"].encode()))) for r in own.toLocalIterator()]  # about query_bytes of text
        if any(c for _, c in asked):
            out = out.unionByName(_search_block(docs, asked, k, segment, scratch, f"block{block}"))
    return out


def op13_threshold_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), b AS (
  SELECT row_number() OVER () AS iid, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark
), tot AS (SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS words FROM d WHERE len(terms) > 0),
q AS (SELECT iid, item_id, term, count(*) AS qtf FROM (SELECT iid, item_id, unnest(terms) AS term FROM b) GROUP BY ALL),
tf AS (
  SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), tot
), impact AS (
  SELECT rid, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // words)))) AS impact FROM tf JOIN w USING (term), tot
), scored AS (SELECT iid, item_id, rid, doc_id, CAST(sum(qtf * impact) AS BIGINT) AS score FROM q JOIN impact USING (term) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0) WHERE rank <= 20
"""
