"""Token ids as flat binary files with 64-bit document offsets, for readers that map them into memory.

Documents are dealt into ranges of doc_id; each range is one part, written by one task in ascending order while it encodes. A part is

- ``NNNNN.bin``: the ids of its documents one after another, flat, unsigned little-endian, 16 bits wide where the vocabulary allows, else 32;
- ``NNNNN.idx``: n + 1 unsigned 64-bit offsets, counted in ids of the whole stream: document i is [idx[i], idx[i + 1]);
- ``NNNNN.doc``: n signed 64-bit document ids (0 for null; nulls come first, their number is in the manifest).

The ``.bin`` files in the order of their names are the whole stream. A part's base is the sum of the ids in the parts before it: the tasks that encode
return one row each, a running sum over these rows gives the bases, and a second small job writes the offsets. The rows with their bases are the
manifest, a Parquet table beside the files. Files are written under another name and renamed when whole, so that a repeated task replaces
its own file by the same bytes. The folder is on whatever file system its URI names (local or mounted, or one that pyarrow knows); on local and
mounted ones files are mapped, elsewhere read by ranges.

Texts are encoded in chunks between spaces and line breaks, each once, by the tokenizers library; a bounded cache keeps the ids of chunks. This is exact for
vocabularies whose pre-tokens never hold a space and that drop white space: ``SpacedEncoder`` refuses others.

Defined results: null text counts as empty and has only the closing id; null doc_ids come before all others; rows that share a doc_id come in the order of
their texts' hashes; repeated rows are written each on its own; an empty table gives an empty manifest and no files; columns other than doc_id and text
are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import sys
import uuid
import zlib
from array import array
from contextlib import contextmanager
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import Scratch, in_use, read, text_slices, texts_of

END_ID = 2
#: Ids that a reader takes from a file at once.
BLOCK_IDS = 2_000_000

PART = "part int, n_docs long, n_null long, n_tokens long, width int"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class SpacedEncoder:
    """Ids of texts by a ``tokenizers`` file, equal to those of whole texts at its defaults.

    A space or line break ends a pre-token and is dropped, composes with nothing and changes no character beside it, so a text's ids
    are those of its chunks between them. Each chunk is encoded once, and up to ``LIMIT`` chunks are kept: signs after a last
    letter or digit are a pre-token apart; a word of Latin letters is one pre-token, which normalisation only puts in lower case, so it goes straight to the
    library's model; all else goes through the whole library.
    """

    LIMIT = 500_000
    #: Signs that neither begin a contraction nor are in an added token.
    SIGNS = ".,;:!?&%#$*()"
    WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
    SIGNED = re.compile("(?s:.*)[0-9A-Za-zÀ-ÖØ-öø-ÿ]").fullmatch

    def __init__(self, json_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
        import tokenizers

        with open(json_file, encoding="utf-8") as f:
            spec = json.load(f)
        if any(t.get(flag) or t["content"][-1:] in " \n" + self.SIGNS or " " in t["content"] for t in spec.get("added_tokens") or [] for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that take in white space, signs or whole words aren't supported")
        self.tokenizer = tokenizers.Tokenizer.from_file(json_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        self.tokenize = self.tokenizer.model.tokenize
        self.code = "H" if self.kind == "<u2" else "I"  # of an array in this machine's byte order
        if sys.byteorder != "little":
            raise RuntimeError("the files are written as arrays of a little-endian machine")
        small = [chr(c) for c in (*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100))]
        self.bytes_of = {ord(c): "".join(x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(c)) for c in small}
        self.forget()
        probe = "One two,  don't\nx1. , y Été É*"
        if self.tokenizer.encode(probe, add_special_tokens=False).ids != self.encode([probe])[0].tolist():
            raise ValueError("this vocabulary's ids depend on the spaces between words")

    def forget(self) -> None:
        """Empties the cache. The ids of chunk i are ``flat`` from ends[i] to ends[i + 1]; chunk 0 is kept for what stands after texts."""
        outer = self

        class Numbers(dict):
            def __missing__(self, chunk: str) -> int:
                return outer.add(chunk)

        self.numbers, self.flat, self.ends = Numbers(), array(self.code), array("q", [0, 0])

    def ids(self, chunk: str) -> array:
        i = self.numbers[chunk]
        return self.flat[self.ends[i] : self.ends[i + 1]]

    def add(self, chunk: str) -> int:
        """Encodes a new chunk and returns its number."""
        if chunk.isalpha() and chunk.isascii():
            ids = [t.id for t in self.tokenize(chunk.lower())]
        elif self.WORD(chunk):
            ids = [t.id for t in self.tokenize(chunk.lower().translate(self.bytes_of))]
        else:
            word = chunk.rstrip(self.SIGNS)
            if len(word) < len(chunk) and self.SIGNED(word):
                ids = self.ids(word) + self.ids(chunk[len(word) :])
            else:
                ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        self.flat.extend(ids)
        at = self.numbers[chunk] = len(self.ends) - 1
        self.ends.append(len(self.flat))
        return at

    def encode(self, texts: list[str], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and each text's number of ids; with ``end_id`` after each text, if given."""
        if len(self.ends) > self.LIMIT:
            self.forget()
        chunks = [t.replace("\n", " ").split(" ") for t in texts]
        count = np.fromiter(map(len, chunks), np.int64, len(chunks))
        use = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(chunks)), np.int64, int(count.sum()))
        ends, flat = np.array(self.ends), np.array(self.flat, self.kind)
        start, length = ends[:-1].copy(), np.diff(ends)
        if end_id is not None:
            flat, start[0], length[0] = np.append(flat, np.array(end_id, self.kind)), len(flat), 1
        use, count = np.insert(use, np.cumsum(count), 0), count + 1
        n = length[use]
        after = np.cumsum(n)
        ids = flat[np.repeat(start[use] - after + n, n) + np.arange(int(n.sum()))]
        return ids, np.diff(after[np.cumsum(count) - 1], prepend=0)


_encoders: dict[str, SpacedEncoder] = {}


def encoder(json_file: str) -> SpacedEncoder:
    """One encoder a worker process."""
    in_use("token_files", _encoders.clear)
    if json_file not in _encoders:
        _encoders[json_file] = SpacedEncoder(json_file)
    return _encoders[json_file]


# --- files ----------------------------------------------------------------------------------------------------


class Folder:
    """Files of a folder by its URI; ``write`` gives a file that takes its name only when it is whole."""

    def __init__(self, uri: str):
        from pyarrow import fs

        self.fs, self.path = fs.FileSystem.from_uri(uri) if ":" in uri.split("/")[0] else (fs.LocalFileSystem(), os.path.abspath(uri))
        self.local = isinstance(self.fs, fs.LocalFileSystem)

    def save(self, name: str, data: bytes) -> None:
        with self.write(name) as f:
            f.write(data)

    @contextmanager
    def write(self, name: str):
        at, own = f"{self.path}/{name}", f"{self.path}/_{name.replace('/', '_')}.{uuid.uuid4().hex}"
        self.fs.create_dir(os.path.dirname(at), recursive=True)
        try:
            with self.fs.open_output_stream(own) as f:
                yield f
        except BaseException:
            self.fs.delete_file(own)
            raise
        self.fs.move(own, at)

    def open(self, name: str):
        """A file whose ``read_at`` takes ranges: mapped into memory where that can be, so that nothing is copied."""
        at = f"{self.path}/{name}"
        return pa.memory_map(at) if self.local else self.fs.open_input_file(at)

    def numbers(self, name: str, kind: str, start: int = 0, count: int | None = None) -> np.ndarray:
        width = np.dtype(kind).itemsize
        with self.open(name) as f:
            return np.frombuffer(f.read_at((f.size() // width - start if count is None else count) * width, start * width), kind)


def _write_part(batches, uri: str, json_file: str, end_id: int):
    enc, folder, part = encoder(json_file), Folder(uri), TaskContext.get().partitionId()
    lengths, docs, nulls = [], [], 0
    slices = text_slices(batches)
    if (first := next(slices, None)) is None:
        return
    with folder.write(f"{part:05d}.bin") as out:
        for batch in chain([first], slices):
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            nulls += ids.null_count
            docs.append(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
            data, length = enc.encode([t.decode("utf-8", "replace") for t in texts_of(batch)], end_id)
            lengths.append(length.astype("<u8"))
            out.write(data)
    every = np.concatenate(lengths)
    folder.save(f"{part:05d}.doc", np.concatenate(docs).tobytes())
    folder.save(f"lengths/{part:05d}", every.tobytes())
    row = [[part], [len(every)], [nulls], [int(every.sum())], [int(enc.kind[-1])]]
    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()))], ["part", "n_docs", "n_null", "n_tokens", "width"])


def _write_offsets(batches, uri: str):
    folder = Folder(uri)
    for b in batches:
        for part, base in zip(b.column("part").to_pylist(), b.column("base").to_pylist()):
            lengths = folder.numbers(f"lengths/{part:05d}", "<u8")
            offsets = np.full(len(lengths) + 1, base, "<u8")
            offsets[1:] += np.cumsum(lengths)
            folder.save(f"{part:05d}.idx", offsets.tobytes())
        yield b


def write_token_files(docs: DataFrame, uri: str, json_file: str | None = None, end_id: int = END_ID, parts: int | None = None) -> DataFrame:
    """Encodes documents into the files of the folder ``uri`` and returns the manifest: part, n_docs, n_null, n_tokens, width, base.

    parts: at most so many ranges of doc_id (the session's shuffle partitions, unless given). ``uri`` must name a folder that all executors see.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = "doc_id", "_tie", "_row"  # a doc_id that many rows share is dealt over more than one range
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumns({"_tie": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    dealt = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select("doc_id", "text")
    scratch = Scratch(spark)
    written = scratch.put(dealt.mapInArrow(partial(_write_part, uri=uri, json_file=json_file or vocabulary_path(), end_id=end_id), PART), "written")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    based = written.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    n = max(1, written.count())
    based.repartition(n).mapInArrow(partial(_write_offsets, uri=uri), PART + ", base long").write.mode("overwrite").parquet(f"{uri.rstrip('/')}/manifest")
    scratch.drop("written")
    folder = Folder(uri)
    if folder.fs.get_file_info(f"{folder.path}/lengths").type.name == "Directory":
        folder.fs.delete_dir(f"{folder.path}/lengths")
    return read_manifest(spark, uri)


def read_manifest(spark: SparkSession, uri: str) -> DataFrame:
    return spark.read.schema(PART + ", base long").parquet(f"{uri.rstrip('/')}/manifest")


def _read_part(batches, uri: str):
    folder = Folder(uri)
    for b in batches:
        for part, nulls, width in zip(*(b.column(c).to_pylist() for c in ("part", "n_null", "width"))):
            at, docs = folder.numbers(f"{part:05d}.idx", "<u8").astype(np.int64), folder.numbers(f"{part:05d}.doc", "<i8")
            # Documents in runs of about BLOCK_IDS ids; a longer one is a run of its own.
            cuts = [0, *(np.flatnonzero(np.diff((at[1:] - at[0]) // BLOCK_IDS)) + 1).tolist(), len(docs)]
            with folder.open(f"{part:05d}.bin") as f:
                for i, j in zip(cuts, cuts[1:]):
                    if i == j:
                        continue
                    data = f.read_at(int(at[j] - at[i]) * width, int(at[i] - at[0]) * width)
                    ids = memoryview(np.frombuffer(data, f"<u{width}").astype("<u4")).cast("B")
                    cut = ((at[i : j + 1] - at[i]) * 4).tolist()
                    crc = [zlib.crc32(ids[x:y]) for x, y in zip(cut, cut[1:])]
                    doc = pa.array(docs[i:j], mask=np.arange(i, j) < nulls)
                    yield pa.RecordBatch.from_arrays([doc, pa.array(at[i:j]), pa.array(np.diff(at[i : j + 1])), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, uri: str) -> DataFrame:
    """One row a document from the files: doc_id, start (ids before it), n_tokens and the checksum of its ids as 32-bit integers."""
    parts = read_manifest(spark, uri)
    return parts.select("part", "n_null", "width").repartition(max(1, parts.count())).mapInArrow(partial(_read_part, uri=uri), ROWS)


class TokenReader:
    """Random access to the files of a folder: ``document(i)`` has the ids of the i-th document of the whole stream."""

    def __init__(self, uri: str, manifest: list):
        """manifest: rows of the manifest, in any order."""
        self.folder, self.parts = Folder(uri), sorted(manifest, key=lambda r: r["part"])
        self.first = np.cumsum([0, *(r["n_docs"] for r in self.parts)])

    def document(self, i: int) -> np.ndarray:
        if not 0 <= i < self.first[-1]:
            raise IndexError(i)
        k = int(np.searchsorted(self.first, i, side="right")) - 1
        row, name = self.parts[k], f"{self.parts[k]['part']:05d}"
        a, b = self.folder.numbers(f"{name}.idx", "<u8", i - int(self.first[k]), 2).tolist()
        return self.folder.numbers(f"{name}.bin", f"<u{row['width']}", a - row["base"], b - a)


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = Scratch(spark).path + "/tokens"
    write_token_files(read(spark, sf_dir, "documents"), uri)
    return read_token_files(spark, uri)
