"""Best-fit packing of token pieces by minimum bin slack.

Pieces are tokenised once, counted by length (the counts are at most ``capacity`` rows, whatever the
corpus), and packed on those counts: for the longest length left, a bitset subset-sum over the lengths
still available finds the fullest bin, which is then removed as often as the counts allow. The bins are
thus kept as a short list of patterns with a repeat count. Each piece finds its place from its rank among
the pieces of its length, so no task ever holds more than its own rows.

Defined results: null text packs as empty text (one piece with only the closing id); equal texts and
repeated rows are packed each on its own; an empty table gives no rows; columns other than doc_id and text
are ignored, whatever their names; null doc_id stays null.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import Scratch, in_use, map_slices, read, texts_of

CAPACITY = 2048
END_ID = 0

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def added_tokens(json_file: str) -> dict[str, int]:
    """The added tokens of a ``tokenizers`` file with their ids."""
    with open(json_file, encoding="utf-8") as f:
        spec = json.load(f)
    added = spec.get("added_tokens") or []
    if any(t.get(flag) for t in added for flag in ("single_word", "lstrip", "rstrip")) or (added and spec.get("normalizer")):
        raise ValueError("added tokens that take in white space, whole words or normalised text aren't supported")
    return {t["content"]: t["id"] for t in added if t["content"]}


def vocabulary_paths() -> tuple[str, str]:
    """The rank file and the JSON file of the same public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


class ChunkEncoder:
    """Byte-level BPE ids of a text, equal to those of the ``tokenizers`` file of the same vocabulary.

    The vocabulary's split pattern never joins text over a single space between two other characters: the
    space always opens the next part. So a text falls into chunks that encode on their own, and
    a bounded cache keeps the ids of chunks. Where white space stands together, the chunks around it stay
    one chunk. The strings of the added tokens are cut out first, the longest where several begin, and have the
    token's own id; without ``json_file`` there are none, and such strings are ordinary text.
    """

    LIMIT = 250_000

    def __init__(self, rank_file: str, json_file: str | None = None):
        import base64

        import public_tokenizers
        import tiktoken

        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode_ordinary = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        added = added_tokens(json_file) if json_file else {}
        self.added = {t: np.array([i], "<u4").tobytes() for t, i in added.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")").split if added else None
        outer = self

        class Chunks(dict):
            def __missing__(self, chunk: str):
                if not chunk or chunk[0].isspace() or chunk[-1].isspace():
                    self[chunk] = None
                    return None
                if len(self) >= outer.LIMIT:
                    self.clear()
                ids = self[chunk] = np.array(outer.encode_ordinary(" " + chunk), "<u4").tobytes()
                return ids

        self.chunks = Chunks()

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if any(t in text for t in self.added):
            return b"".join(self.added[part] if i % 2 else self._between(part) for i, part in enumerate(self.cut(text)))
        return self._between(text)

    def _between(self, text: str) -> bytes:
        """The ids of a text without added tokens."""
        first, *rest = text.split(" ")
        parts = [self.chunks[c] for c in rest] if rest else []
        if None in parts or (rest and (not first or first[-1].isspace())):
            return np.array(self.encode_ordinary(text), "<u4").tobytes()
        return np.array(self.encode_ordinary(first), "<u4").tobytes() + b"".join(parts)


_encoders: dict[tuple[str, str | None], ChunkEncoder] = {}


def encoder(rank_file: str, json_file: str | None = None) -> ChunkEncoder:
    """One encoder a worker process; added tokens are those of ``json_file``."""
    in_use("packing", _encoders.clear)
    key = rank_file, json_file
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(rank_file, json_file)
    return _encoders[key]


def _pieces(batch: pa.RecordBatch, rank_file: str, json_file: str | None, capacity: int, end_id: int) -> pa.RecordBatch:
    enc = encoder(rank_file, json_file)
    end = np.array([end_id], "<u4").tobytes()
    ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
    rows = []
    for doc, text in zip(ids, texts_of(batch)):
        data = enc.encode(text.decode("utf-8", "replace")) + end
        n = len(data) // 4
        # Only the first piece of a long document may be short.
        at, stop = 0, n if n <= capacity else n % capacity or capacity
        piece = 0
        while at < n:
            rows.append((doc, piece, at, stop - at, zlib.crc32(data[4 * at : 4 * stop])))
            piece, at, stop = piece + 1, stop, stop + capacity
    cols = list(zip(*rows)) if rows else [[]] * 5
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])


def token_pieces(docs: DataFrame, rank_file: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: its place in the document, length and the checksum of its ids.

    Added tokens are those of the default vocabulary; a ``rank_file`` of the caller's own has none.
    """
    rank_file, json_file = (rank_file, None) if rank_file else vocabulary_paths()
    make = map_slices(partial(_pieces, rank_file=rank_file, json_file=json_file, capacity=capacity, end_id=end_id))
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(make, PIECES)


def fullest(available: list[tuple[int, int]], room: int) -> list[tuple[int, int]]:
    """The multiset of available lengths with the largest sum that ``room`` holds, as (length, times).

    available: (length, count), longest first. A bitset holds the reachable sums; each count is split
    into powers of two, so one length costs a few shifts. Stops at the first set that fills the room.
    """
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length, count in available:
        if length > room:
            continue
        count = min(count, room // length)
        times = 1
        while count > 0:
            times = min(times, count)
            grown = reach | (reach << (length * times)) & mask
            if grown != reach:
                steps.append((reach, length, times))
                reach = grown
            count -= times
            times *= 2
        if reach >> room & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for before, length, times in reversed(steps):
        if not before >> at & 1:  # this sum needs the step
            used[length] = used.get(length, 0) + times
            at -= length * times
    return list(used.items())


def minimum_bin_slack(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins as (repeats, [(length, times)]): each takes the longest length left and the fullest company.

    Every step uses up what some length can still give to the same pattern, so that the number of patterns
    depends on the capacity, not on the counts.
    """
    left = dict(sorted(((k, n) for k, n in counts.items() if n > 0), reverse=True))
    bins = []
    while left:
        first = next(iter(left))
        room = capacity - first
        left[first] -= 1
        company = dict(fullest([(k, n) for k, n in left.items() if n and k <= room], room)) if room else {}
        left[first] += 1
        company[first] = company.get(first, 0) + 1
        repeats = min(left[k] // t for k, t in company.items())
        bins.append((repeats, sorted(company.items(), reverse=True)))
        for k, t in company.items():
            left[k] -= repeats * t
            if not left[k]:
                del left[k]
    return bins


def slots(bins: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first bin, offset in the bin, times in each bin, length), by rank."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    given: dict[int, int] = {}
    bin_id = 0
    for repeats, company in bins:
        offset = 0
        for length, times in company:
            rank = given.get(length, 0)
            out.setdefault(length, []).append((rank, bin_id, offset, times))
            given[length] = rank + repeats * times
            offset += length * times
        bin_id += repeats
    return {k: np.array(v, np.int64) for k, v in out.items()}


def _placed(batches, table):
    by = table.value
    for b in batches:
        length = b.column(b.schema.get_field_index("length")).to_numpy()
        rank = b.column(b.schema.get_field_index("_rank")).to_numpy()
        seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        cuts = np.flatnonzero(np.diff(length[order])) + 1
        for rows in np.split(order, cuts) if len(order) else []:
            slot = by[int(length[rows[0]])]
            r = rank[rows]
            s = slot[np.searchsorted(slot[:, 0], r, side="right") - 1]
            nth = r - s[:, 0]
            seq[rows] = s[:, 1] + nth // s[:, 3]
            off[rows] = s[:, 2] + nth % s[:, 3] * length[rows]
        keep = [b.column(i) for i in range(5)]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(seq), pa.array(off)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def ranked(pieces: DataFrame, groups: int) -> DataFrame:
    """Adds _rank, from 0, among the pieces of the same length.

    A length may be that of most pieces, so ranks come from two levels: within (length, group), and the sum of
    the groups before. The groups are hashes of the document's id and the piece.
    """
    spread = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).cast("int"))
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    sums = spread.groupBy("length", "_group").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy("length", "_group").orderBy("doc_id", "piece", "ids_crc32")
    return spread.withColumn("_in", F.row_number().over(inside) - 1).join(sums, ["length", "_group"]).withColumn("_rank", (F.col("_in") + F.col("_before")).cast("long"))


def pack(pieces: DataFrame, capacity: int = CAPACITY, rows_a_group: int = 20_000) -> DataFrame:
    """Adds sequence_id and offset to pieces (a table that reads the same each time)."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity rows at most
    if any(k > capacity or k < 1 for k in counts):
        raise ValueError("a piece is longer than a sequence or empty")
    table = spark.sparkContext.broadcast(slots(minimum_bin_slack(counts, capacity)))
    groups = max(1, -(-sum(counts.values()) // rows_a_group))
    out = ranked(pieces, groups).select("doc_id", "piece", "start", "length", "ids_crc32", "_rank")
    return out.mapInArrow(partial(_placed, table=table), PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, rank_file: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenises, cuts and packs documents: one row per piece with its sequence and offset."""
    pieces = Scratch(docs.sparkSession).put(token_pieces(docs, rank_file, capacity, end_id), "pieces")
    return pack(pieces, capacity)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))
