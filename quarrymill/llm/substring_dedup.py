"""Substring dedup on a compacted De Bruijn graph of token k-mers.

A word k-mer that is the least of its neighbourhood (a minimizer) stands for the run of long windows that
share it; such a run is an edge of a sparse De Bruijn graph, and every long window lies in exactly one
edge of each document that has it. Edges whose k-mer is in one document only are unique text and go at
once. Among the rest, edges that always follow each other form nonbranching paths: two Spark joins find
where a path begins, and each document's own word positions then number its paths. A path is in the same
documents from end to end, so one document comparison settles all its windows. Where different edges
share a k-mer (the graph branches: the texts around a repeat differ), the source coordinates lead back
to the words, and every window there is compared by itself.

The result is exact: a window is a duplicate if the same word sequence starts in a document with a smaller
doc_id. Sequences are compared by two 64-bit hashes together (that of the k-mer and that of the words).

Defined results: null text has no words; texts shorter than a window keep every word; rows with null doc_id
are neither source nor copy and stay whole; rows that repeat a doc_id don't remove each other (no id is
smaller); equal texts under different ids keep only the smallest id's words; empty tables give no rows; columns
other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import Scratch, map_slices, read, texts_of
from quarrymill.llm.words import WordHashes, doc_of, gram_hashes, mix, span_hashes, window_min, word_hashes

WINDOW = 50
KMER = 12

_cache = WordHashes()


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _edges(batch: pa.RecordBatch, window: int, kmer: int) -> pa.RecordBatch:
    """The edges of each document: k-mer, content, first window and number of windows."""
    h, ends = word_hashes(texts_of(batch), _cache)
    names = ["kmer", "body", "doc", "copy", "start", "n"]
    n = len(h) - window + 1
    if n <= 0:
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 4 + [pa.array([], pa.int32())] * 2, names)
    least = window_min(gram_hashes(h, kmer), window - kmer + 1)
    doc = doc_of(ends)
    at = np.flatnonzero(doc[:n] == doc[window - 1 :])  # windows within one document
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (least[at[1:]] != least[at[:-1]]) | (doc[at[1:]] != doc[at[:-1]])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    start = at[first]
    body = span_hashes(h, start, start + count + window - 1)
    of = doc[start]
    ids, copy = _column(batch, "doc").take(pa.array(of)), _column(batch, "copy").take(pa.array(of))
    return pa.RecordBatch.from_arrays([_signed(least[start]), _signed(body), ids, copy, pa.array((start - ends[of]).astype(np.int32)), pa.array(count.astype(np.int32))], names)


def _windows(batch: pa.RecordBatch, window: int) -> pa.RecordBatch:
    """The windows of the wanted edges by k-mer and content, each once: the least and the greatest document that has it, and all places here."""
    h, ends = word_hashes(texts_of(batch), _cache)
    wanted = _column(batch, "wanted")
    per = np.diff(wanted.offsets.to_numpy())
    items = wanted.flatten()
    start, n = (items.field(k).to_numpy().astype(np.int64) for k in ("start", "n"))
    kmer = items.field("kmer").to_numpy()
    row = np.repeat(np.arange(len(per)), per)
    edge = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(edge)) - np.repeat(np.cumsum(n) - n, n)
    pos = start[edge] + inside
    at = pos + ends[row[edge]]
    body = span_hashes(h, at, at + window)
    doc, copy = (_column(batch, c).to_numpy()[row[edge]] for c in ("doc", "copy"))
    kmer, body = kmer[edge], body.view(np.int64)
    order = np.lexsort((doc, body, kmer))  # documents rise within a window
    kmer, body, doc = kmer[order], body[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(kmer) != 0) | (np.diff(body) != 0)])) if len(order) else order
    last = np.append(first[1:], len(order)) - 1 if len(order) else order
    places = pa.StructArray.from_arrays([pa.array(doc), pa.array(copy[order]), pa.array(pos[order].astype(np.int32))], ["doc", "copy", "start"])
    listed = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)).astype(np.int32)), places)
    rows = mix(_column(batch, "doc").to_numpy().view(np.uint64) ^ mix(_column(batch, "copy").to_numpy().view(np.uint64)))
    piece = _signed(np.repeat(mix(rows.sum(keepdims=True)), len(first)))  # the slice's name, made of its rows, so the same on every try
    return pa.RecordBatch.from_arrays([piece, pa.array(kmer[first]), pa.array(body[first]), pa.array(doc[first]), pa.array(doc[last]), listed], ["piece", "kmer", "body", "lo", "hi", "places"])


def _runs(table: pa.Table) -> pa.Table:
    """The windows of a slice that a smaller document has, as runs: a span for consecutive ones of a document."""
    places = table.column("places").combine_chunks()
    lo = np.repeat(table.column("_lo").to_numpy(), np.diff(places.offsets.to_numpy()))
    every = places.flatten()
    doc, copy, start = (every.field(c).to_numpy() for c in ("doc", "copy", "start"))
    keep = doc > lo
    doc, copy, start = doc[keep], copy[keep], start[keep].astype(np.int64)
    order = np.lexsort((start, copy, doc))
    doc, copy, start = doc[order], copy[order], start[order]
    same = (np.diff(doc) == 0) & (np.diff(copy) == 0)
    first = np.flatnonzero(np.concatenate([[True], ~(same & (np.diff(start) <= 1))])) if len(doc) else order
    last = np.append(first[1:], len(doc)) - 1 if len(doc) else order
    n = start[last] - start[first] + 1
    return pa.Table.from_arrays([pa.array(doc[first]), pa.array(copy[first]), pa.array(start[first].astype(np.int32)), pa.array(n.astype(np.int32))], ["doc", "copy", "start", "n"])


def _keyed(docs: DataFrame) -> DataFrame:
    """doc and copy name a row: rows alike in both have the same text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text).alias("copy"), text.alias("text"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, kmer: int = KMER, scratch: Scratch | None = None) -> DataFrame:
    """(doc, copy, start, n): n consecutive windows from word ``start`` that a smaller document has too."""
    scratch = scratch or Scratch(docs.sparkSession)
    keyed = _keyed(docs).where(F.col("doc").isNotNull())
    # A row's repeats (the same in doc and copy) have the same edges; a task makes them once, and what several tasks made is gathered as sets.
    edges = scratch.put(keyed.mapInArrow(map_slices(partial(_edges, window=window, kmer=kmer), once=("doc", "copy")), "kmer long, body long, doc long, copy long, start int, n int"), "edges")

    # Repeated k-mers: in two documents at least. branching: more than one edge holds it.
    # Written, as the minima below, so that the join reads both sides by shuffles of its own and a common k-mer can be split.
    shared = edges.groupBy("kmer").agg(F.min("doc").alias("_lo"), F.max("doc").alias("_hi"), (F.min("body") != F.max("body")).alias("branching")).where("_lo < _hi").drop("_lo", "_hi")
    shared = scratch.put(shared, "shared")
    own = Window.partitionBy("doc", "copy").orderBy("start")
    key = F.struct("kmer", "body")
    end = F.col("start") + F.col("n")
    occurrences = edges.join(shared, "kmer").distinct().withColumns({
        "before": F.when(F.lag(end).over(own) == F.col("start"), F.lag(key).over(own)),
        "after": F.when(F.lead("start").over(own) == end, F.lead(key).over(own)),
    })
    occurrences = scratch.put(occurrences, "occurrences")
    scratch.drop("edges", "shared")

    # An edge continues a path if all its occurrences have one and the same edge before, which always goes on to it.
    n = F.count(F.lit(1))
    only = lambda c: (F.count(c) == n) & (F.min(c) == F.max(c))
    kinds = scratch.put(occurrences.groupBy("kmer", "body").agg(F.min("doc").alias("first"), only("before").alias("one_before"), only("after").alias("one_after")), "kinds")
    known = occurrences.join(kinds, ["kmer", "body"])
    head = ~(F.col("one_before") & F.coalesce(F.lag("one_after").over(own), F.lit(False)))
    paths = known.withColumn("head", F.coalesce(head, F.lit(True)).cast("int")).withColumn("path", F.sum("head").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    paths = paths.groupBy("doc", "copy", "path").agg(F.min("start").alias("start"), F.sum("n").cast("int").alias("n"), F.min("first").alias("first"))
    whole = paths.where("doc > first").select("doc", "copy", "start", "n")

    # Where the graph branches, an edge's first document may still share windows with another edge.
    wanted = known.where("branching and doc = first").groupBy("doc", "copy").agg(F.collect_list(F.struct("kmer", "start", "n")).alias("wanted"))
    wanted = scratch.put(wanted, "wanted")
    windows = keyed.join(wanted, ["doc", "copy"]).select("doc", "copy", "text", "wanted")
    # A window that many documents have is a row for each slice of text that a task reads at once, not for each document.
    schema = "piece long, kmer long, body long, lo long, hi long, places array<struct<doc: long, copy: long, start: int>>"
    windows = scratch.put(windows.mapInArrow(map_slices(partial(_windows, window=window), once=("doc", "copy")), schema), "windows")
    least = windows.groupBy("kmer", "body").agg(F.min("lo").alias("_lo"), F.max("hi").alias("_hi")).where("_lo < _hi").drop("_hi")
    least = scratch.put(least, "least")
    # Back to the slices that the windows are of, where runs of windows become one span each.
    hit = windows.join(least, ["kmer", "body"]).where("hi > _lo").select("piece", "_lo", "places")
    single = hit.groupBy("piece").applyInArrow(_runs, "doc long, copy long, start int, n int").distinct()
    spans = scratch.put(whole.unionByName(single), "spans")
    scratch.drop("occurrences", "kinds", "wanted", "windows", "least")
    return spans


def _cut(text: bytes, spans: list[dict] | None, window: int) -> tuple[list[bytes], list[bytes]]:
    words = text.split()
    if not spans:
        return words, words
    gone = np.zeros(len(words) + 1, np.int32)
    for s in spans:
        gone[s["start"]] += 1
        gone[min(len(words), s["start"] + s["n"] + window - 1)] -= 1
    keep = np.cumsum(gone[:-1]) == 0
    return words, [w for w, k in zip(words, keep.tolist()) if k]


def _digest(batch: pa.RecordBatch, window: int) -> pa.RecordBatch:
    rows = []
    spans = _column(batch, "spans").to_pylist() if "spans" in batch.schema.names else [None] * batch.num_rows
    for text, cut in zip(texts_of(batch), spans):
        words, kept = _cut(text, cut, window)
        rows.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    n, removed, sha = zip(*rows)
    return pa.RecordBatch.from_arrays([_column(batch, "doc"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha)], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def _kept_text(batch: pa.RecordBatch, window: int) -> pa.RecordBatch:
    texts = [b" ".join(_cut(t, s, window)[1]).decode("utf-8", "replace") for t, s in zip(texts_of(batch), _column(batch, "spans").to_pylist())]
    return pa.RecordBatch.from_arrays([_column(batch, "doc"), _column(batch, "copy"), pa.array(texts, pa.string())], ["_doc", "_copy", "_kept"])


def _with_spans(docs: DataFrame, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans gathered by row (a row has as many as its own length allows), and the rows with their spans."""
    gathered = spans.groupBy("doc", "copy").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    return gathered, _keyed(docs).join(gathered, ["doc", "copy"], "left")


def removed_words(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the words kept, for every row."""
    _, rows = _with_spans(docs, repeated_spans(docs, window, kmer))
    return rows.select("doc", "text", "spans").mapInArrow(map_slices(partial(_digest, window=window)), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """The documents without repeated spans, in their own columns.

    A text that loses words becomes its kept words joined by one space, and n_chars, where there is such a
    column, its new length. A document of which nothing is left goes; all others stay as they are.
    """
    spans = repeated_spans(docs, window, kmer)
    gathered, _ = _with_spans(docs, spans)
    hit = _keyed(docs).join(gathered, ["doc", "copy"]).select("doc", "copy", "text", "spans")
    kept = hit.mapInArrow(map_slices(partial(_kept_text, window=window), once=("doc", "copy")), "_doc long, _copy long, _kept string").dropDuplicates(["_doc", "_copy"])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.alias("d")
    joined = d.join(kept.alias("k"), (F.col("d.doc_id").cast("long") == F.col("k._doc")) & (F.xxhash64(F.coalesce(F.col("d.text").cast("string"), F.lit(""))) == F.col("k._copy")), "left")
    joined = joined.where(F.col("k._kept").isNull() | (F.col("k._kept") != ""))
    new = {"text": F.coalesce(F.col("k._kept"), F.col("d.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("k._kept").isNotNull(), F.length("k._kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("d.n_chars"))
    return joined.select(*[new[c].alias(c) if c in new else F.col(f"d.`{c}`") for c in docs.columns])


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_words(read(spark, sf_dir, "documents"))


ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM words WHERE len(w) >= 50
), windows AS (
  SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS k FROM starts
), least AS (
  SELECT k, min(doc_id) AS lo FROM windows GROUP BY k
), hits AS (
  SELECT doc_id, p FROM windows JOIN least USING (k) WHERE doc_id > lo
), gone AS (
  SELECT doc_id, list(DISTINCT q) AS gone FROM (SELECT doc_id, unnest(range(p, p + 50)) AS q FROM hits) GROUP BY doc_id
), spread AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM words
), gone_words AS (
  SELECT doc_id, unnest(gone) AS q FROM gone
), kept AS (
  SELECT s.doc_id, string_agg(word, ' ' ORDER BY q) AS kept, count(*) AS n
  FROM spread s ANTI JOIN gone_words g ON s.doc_id = g.doc_id AND s.q = g.q GROUP BY s.doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""
