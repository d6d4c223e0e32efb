"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document is its set of distinct word shingles. Its sketch has t bins. In rounds i = 0, 1, ... every
element falls in the bin that hash i names with value i + h_i(element), and each bin keeps its least value;
from round t on, round t + j serves bin j alone, so that all bins are full after at most 2t rounds
whatever the size of the set (Dahlgaard, Knudsen, Thorup: Fast Similarity Sketching). Two
sets agree in a bin with the probability of their Jaccard similarity, and the number of agreeing bins is concentrated
like that of independent ones, which single-hash bin placement doesn't give for small sets.

Bins are read in bands of ``rows``; classes (documents of one and the same set) that share a band are candidates.
Every link is confirmed on full sets, without listing a band's pairs. In a round each class goes to
the family of one hub among its bands' members: at first the one that shares most with others (the original of a group of near
copies is in more bands with its copies than they are with one another), in later rounds one by chance. A family is dealt into parts of
bounded number and bytes, each part gets the hub, and a task compares the sets of a part by bit sets and emits a spanning forest of the
links, one row a member at most. So a round sends every set once, whatever the size of the family. A band whose classes
are in one component, or have all met, is done; a hub that has met all others of a band leaves it. What some rounds leave open (many
classes of one band that aren't similar enough) is compared in pairs of blocks by band, so that after it every pair of
classes that shares a band is in one component or has met, and no link that a band shows is lost.

With 252 bins in 42 bands of 6, a pair of similarity s shares no band with probability (1 - s**6)**42: 3e-9 at
0.85, 3e-6 at 0.8.

Defined results: null and empty texts, and texts of white space, have an empty set and link with nothing
(component_id is the document's own doc_id); texts of fewer words than a shingle have one shingle, the whole sequence;
repeated rows are copies; a null doc_id takes part, is never a component's id, and is never kept unless the pipeline
stage says so; empty tables give no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm.common import Scratch, map_slices, read, texts_of
from quarrymill.llm.components import connected_components
from quarrymill.llm.words import WordHashes, gram_hashes, mix, word_hashes

SHINGLE = 5
BANDS = 42
ROWS = 6
#: Classes, and bytes of their sets, that one task compares with each other (or, in pairs of blocks, with as many others).
BLOCK = 512
BLOCK_BYTES = 16_000_000
#: Rounds of families before pairs of blocks.
ROUNDS = 2

U = np.uint64
_cache = WordHashes()
_FULL = U(0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: list[bytes], k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, with ASCII letters in lower case."""
    h, ends = word_hashes([t.lower() for t in texts], _cache)
    grams = gram_hashes(h, k)
    out = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            # A whole sequence shorter than a shingle; its length keeps it apart from longer ones.
            out.append(mix(gram_hashes(h[a:b], b - a) + U(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def sketch(s: np.ndarray, bins: int, seed: int = 0) -> np.ndarray:
    """The fast similarity sketch of a non-empty set of 64-bit hashes.

    A value holds its round in the top 9 bits and a hash below. Rounds are taken several at a time for small
    sets: rounds after a bin is full have larger values and change nothing.
    """
    out = np.full(bins, _FULL)
    n, i = len(s), 0
    step = max(1, min(bins, int(bins * 5 / n)))
    while i < bins:
        rounds = np.arange(i, min(bins, i + step), dtype=np.uint64)
        x = mix(s[None, :] ^ mix(rounds + U(seed * 4096 + 1))[:, None])
        at = ((x >> U(32)) * U(bins)) >> U(32)
        np.minimum.at(out, at.ravel().astype(np.intp), ((rounds[:, None] << U(55)) | (mix(x) >> U(9))).ravel())
        i += len(rounds)
        if out.max() != _FULL:
            return out
    empty = np.flatnonzero(out == _FULL)
    rounds = (empty + bins).astype(np.uint64)
    for r, salt, b in zip(rounds, mix(rounds + U(seed * 4096 + 1)), empty):
        out[b] = (r << U(55)) | (mix(mix(s ^ salt)) >> U(9)).min()
    return out


def band_keys(sk: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key a band, different for different bands."""
    acc = mix(np.arange(1, bands + 1, dtype=np.uint64))
    for r in range(rows):
        acc = mix(acc ^ sk[r * bands : (r + 1) * bands]) * U(0x9E3779B97F4A7C15)
    return mix(acc)


def _sketches(batch: pa.RecordBatch, k: int, bands: int, rows: int, seed: int) -> pa.RecordBatch:
    nodes, checks, sizes, keys = [], [], [], []
    known: dict[bytes, tuple] = {}
    for s in shingle_sets(texts_of(batch), k):
        n = len(s)
        if not n:
            nodes.append(None), checks.append(None), sizes.append(0), keys.append(None)
            continue
        # Sums of mixed elements name the set: two independent ones of 64 bits.
        node = int(mix(np.array([mix(s + U(2 * seed + 1)).sum() ^ U(n)]))[0])
        check = int(mix(s ^ U(0x5851F42D4C957F2D)).sum())
        if (node, check) not in known:
            known[node, check] = band_keys(sketch(s, bands * rows, seed), bands, rows).view(np.int64)
        nodes.append(node), checks.append(check), sizes.append(n), keys.append(known[node, check])
    long = lambda v: pa.array([None if x is None else x - (x >> 63 << 64) for x in v], pa.int64())
    ids = batch.column(batch.schema.get_field_index("doc_id"))
    copy = batch.column(batch.schema.get_field_index("copy"))
    return pa.RecordBatch.from_arrays([ids, copy, long(nodes), long(checks), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "copy", "node", "chk", "n_shingles", "bands"])


def _sets(batch: pa.RecordBatch, k: int) -> pa.RecordBatch:
    sets = shingle_sets(texts_of(batch), k)
    node = batch.column(batch.schema.get_field_index("node"))
    return pa.RecordBatch.from_arrays([node, pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "items"])


def _two(docs: DataFrame) -> DataFrame:
    """doc_id, the text, and copy, which tells texts of one doc_id apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("copy"), text.alias("text"))


def near_duplicates(docs: DataFrame, percent: int = 80, k: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row; links are pairs of sets with
    100 * intersection >= percent * union."""
    return _components(docs, percent, k, bands, rows, block, rounds).drop("copy", "label")


def _components(docs: DataFrame, percent: int, k: int, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK, rounds: int = ROUNDS) -> DataFrame:
    """The columns of ``near_duplicates``, copy, and label (the component, also where ids repeat or are null; null for an empty set)."""
    scratch = Scratch(docs.sparkSession)
    text = _two(docs)
    seed = 0
    while True:
        schema = "doc_id long, copy long, node long, chk long, n_shingles long, bands array<long>"
        marks = scratch.put(text.mapInArrow(map_slices(partial(_sketches, k=k, bands=bands, rows=rows, seed=seed)), schema), "marks")
        # One row a class; all rows of a class have the same bands.
        classes = scratch.put(marks.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), (F.min("chk") != F.max("chk")).alias("clash"), F.first("bands").alias("bands"), F.min(F.struct("doc_id", "copy")).alias("at")), "classes")
        if classes.where("clash").isEmpty():
            break
        seed += 1  # two sets had one name; others under another seed
    members = _shared_bands(classes, scratch)
    labels = _linked(text, classes, members, percent, k, block, rounds, scratch)
    least = labels.join(classes.select("node", "rep"), "node", "right").withColumn("label", F.coalesce("label", "node"))
    ids = scratch.put(least.groupBy("label").agg(F.min("rep").alias("component_id")), "ids")
    least = least.select("node", "label").join(ids, "label").select("node", "label", "component_id")
    out = marks.select("doc_id", "copy", "node", "n_shingles").join(least, "node", "left")
    out = out.select("doc_id", "copy", "label", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    out = scratch.put(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))), "result")
    scratch.drop("marks", "classes", "counts", "members", "items", "ids")
    return out


def _shared_bands(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(band, node, n, shared) for bands with two classes at least; shared is the number of the band's classes."""
    cells = classes.select("node", "n", F.explode("bands").alias("band"))
    # Written, so that the join has shuffles of its own on both sides and a common band can be dealt to several tasks.
    counts = scratch.put(cells.groupBy("band").agg(F.count(F.lit(1)).alias("shared")).where("shared > 1"), "counts")
    return scratch.put(cells.join(counts, "band"), "members")


def _families(open_: DataFrame, turn: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """((band, hub), (node, n, family)): the family of a class is the greatest of its bands' hubs."""
    if turn:
        weighed = open_.select("band", "node", F.xxhash64("node", F.lit(turn)).alias("w"))
    else:
        weighed = open_.select("band", "node").join(open_.groupBy("node").agg(F.sum("shared").alias("w")), "node")
    hubs = scratch.put(weighed.groupBy("band").agg(F.max(F.struct("w", "node")).alias("hub")), f"hubs{turn}")
    families = open_.select("band", "node", "n").join(hubs, "band").groupBy("node").agg(F.max("n").alias("n"), F.max("hub").alias("hub"))
    return hubs.select("band", F.col("hub.node").alias("hub")), scratch.put(families.select("node", "n", F.col("hub.node").alias("family")), f"families{turn}")


def _blocks(n: str, block: int) -> F.Column:
    """How many blocks the rows of a group make, by number and bytes."""
    return F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum(n) * 8 / BLOCK_BYTES)).cast("int")


def _placed(families: DataFrame, turn: int, block: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """((node, family, part) of every class, the same of what is sent: the classes, and each hub once for each part of its family)."""
    sizes = scratch.put(families.groupBy("family").agg(_blocks("n", block).alias("parts")), f"sizes{turn}")
    own = F.pmod(F.xxhash64("node", F.lit(turn)), F.col("parts")).cast("int").alias("part")
    placed = scratch.put(families.join(sizes, "family").select("node", "family", own), f"placed{turn}")
    hubs = sizes.select(F.col("family").alias("node"), "family", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return placed, placed.where("node <> family").union(hubs)


def links_within(sets: list[np.ndarray], percent: int, split: int | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets, as positions; with ``split`` only of those across that position.

    Items in one set only can't be shared, so that bits are kept for the others; bits go in pieces of bounded
    size, whatever the vocabulary.
    """
    n = np.array([len(s) for s in sets])
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = count > 1
    bit = (np.cumsum(common) - 1)[place]
    row = np.repeat(np.arange(len(sets)), n)
    at = common[place]
    row, bit = row[at], bit[at]
    words = max(1, -(-int(common.sum()) // 64))
    step = max(1, 16_000_000 // (8 * len(sets)))  # 16 MB of bits
    order = np.argsort(bit, kind="stable")
    row, bit = row[order], bit[order]
    shared = np.zeros((len(sets), len(sets)), np.int32)
    for w in range(0, words, step):
        a, b = np.searchsorted(bit, [w * 64, (w + step) * 64])
        x = np.zeros((len(sets), min(step, words - w)), np.uint64)
        np.bitwise_or.at(x, (row[a:b], bit[a:b] // 64 - w), U(1) << (bit[a:b] % 64).astype(np.uint64))
        for i in range(len(sets) - 1 if split is None else split):
            lo = i + 1 if split is None else split
            shared[i, lo:] += np.bitwise_count(x[lo:] & x[i]).sum(1, dtype=np.int32)
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    out = []
    for i in range(len(sets) - 1 if split is None else split):
        lo = i + 1 if split is None else split
        s = shared[i, lo:].astype(np.int64)
        for j in (np.flatnonzero((s > 0) & (100 * s >= percent * (n[lo:] + n[i] - s))) + lo).tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[b] = a
                out.append((i, j))
    return out


def _family_links(table: pa.Table, percent: int) -> pa.Table:
    """Links in one family, or between two blocks of it."""
    table = table.combine_chunks().sort_by([("side", "ascending"), ("node", "ascending")])
    nodes = table["node"].to_numpy()
    items = table["items"].combine_chunks()
    flat, offsets = items.flatten().to_numpy().view(np.uint64), items.offsets.to_numpy()
    offsets = offsets - offsets[0]
    sets = [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
    sides = table["side"].to_numpy()
    split = int((sides == 0).sum()) if len(sides) and sides[-1] == 1 else None
    found = links_within(sets, percent, split) if len(sets) > 1 else []
    # As stars around the least node of each tree, which leaves the components fewer rounds.
    least = {}

    def root(i: int) -> int:
        while (up := least.get(i, i)) != i:
            i = up
        return i

    for i, j in found:
        a, b = sorted((root(i), root(j)), key=lambda x: nodes[x])
        least[b] = a
    u = [i for i in least if i != root(i)]
    take = lambda at: pa.array(nodes[at] if at else [], pa.int64())
    return pa.table([take(u), take([root(i) for i in u])], ["u", "v"])


def _linked(text: DataFrame, classes: DataFrame, members: DataFrame, percent: int, k: int, block: int, rounds: int, scratch: Scratch) -> DataFrame:
    """(node, label) of the classes that have links."""
    # Full sets of the candidates only, each read from one document of the class.
    at = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", F.col("at.doc_id").alias("_doc"), F.col("at.copy").alias("_copy"))
    found = text.join(at, text["doc_id"].eqNullSafe(at["_doc"]) & (text["copy"] == at["_copy"])).select("node", "text")
    items = scratch.put(found.mapInArrow(map_slices(partial(_sets, k=k), once=("node",)), "node long, items array<long>").dropDuplicates(["node"]), "items")
    compare = lambda sent, *key: sent.join(items, "node").groupBy(*key).applyInArrow(lambda table: _family_links(table, percent), "u long, v long")

    open_, links = members, None
    for turn in range(rounds):
        hubs, families = _families(open_, turn, scratch)
        placed, sent = _placed(families, turn, block, scratch)
        new = scratch.put(compare(sent.withColumn("side", F.lit(0)), "family", "part"), f"links{turn}")
        if links is None or not new.isEmpty():
            links = new if links is None else links.union(new)
            labels = connected_components(links, scratch, f"cc{turn}")
        named = placed.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        state = scratch.put(open_.select("band", "node", "n").join(named, "node").join(hubs, "band"), f"state{turn}")
        other = F.col("node") != F.col("hub")
        part = F.when(other, F.col("part"))
        bands = state.groupBy("band").agg(
            F.count(F.lit(1)).alias("shared"), (F.min("label") != F.max("label")).alias("mixed"), F.min(~other | (F.col("family") == F.col("hub"))).alias("star"), F.coalesce(F.min(part) == F.max(part), F.lit(True)).alias("met")
        )
        # In a star the hub has met all others of its band; if they were in one part, they have met each other.
        bands = scratch.put(bands.where("mixed and not (star and met)").select("band", "shared", "star"), f"bands{turn}")
        open_ = scratch.put(state.select("band", "node", "n", "hub").join(bands, "band").where("not star or node <> hub").select("band", "node", "n", "shared"), f"open{turn}")
        scratch.drop(f"hubs{turn}", f"families{turn}", f"sizes{turn}", f"placed{turn}", f"state{turn}", f"bands{turn}", *([f"open{turn - 1}"] if turn else []))
        largest = open_.agg(F.max("shared")).first()[0]
        if largest is None:
            return labels
        if largest <= block:
            break  # every band that is left is one block

    sizes = scratch.put(open_.groupBy("band").agg(_blocks("n", block).alias("blocks")), "blocks")
    sent = open_.select("band", "node").join(sizes, "band").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sent = sent.select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", (F.col("own") > F.col("other")).cast("int").alias("side"))
    new = scratch.put(compare(sent, "band", "i", "j"), "links")
    if links is not None and new.isEmpty():
        return labels
    return connected_components(new if links is None else links.union(new), scratch, "cc")


def keep_one(docs: DataFrame, percent: int = 80, k: int = SHINGLE) -> DataFrame:
    """One document of each group of near duplicates, in the documents' own columns.

    The kept row is the least by (doc_id, copy). Rows without a doc_id have a group of their own: one of those of a component
    stays, besides one that has an id. Rows with empty sets link with nothing: one stays for each doc_id and text, and all of null doc_id.
    """
    rows = _components(docs, percent, k)
    least = rows.where("label is not null").groupBy("label", F.col("doc_id").isNull().alias("_none")).agg(F.min(F.struct("doc_id", "copy")).alias("at"))
    kept = least.select("at.doc_id", "at.copy").union(rows.where("label is null and doc_id is not null").select("doc_id", "copy"))
    named = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_copy"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    of = named["_id"].eqNullSafe(kept["doc_id"]) & (named["_copy"] == kept["copy"])
    one = named.join(kept, of, "left_semi").dropDuplicates(["_id", "_copy"]).select("_row.*")
    blank = ~F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return one.unionByName(docs.where(F.col("doc_id").isNull() & blank))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), percent=85)


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT doc_id, array_to_string(w[p:p + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM words WHERE len(w) > 0) GROUP BY ALL
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id
"""
