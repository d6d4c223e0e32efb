"""MPEG audio as a media column.

Reading: tags (ID3v2 before, ID3v1 and APE after) are parsed and skipped, frame headers are found again after
foreign bytes (a header counts when the frame it announces is followed by another of the same stream, by a tag or by
the end; directly after a frame one of the same stream whose checksum, if it has one, is right needs nothing after it), variable-bitrate tables (Xing, Info, VBRI) are read, checksums of protected frames are verified, and
the exact duration (samples over the sample rate) and every frame's byte offset are kept.

Writing: a payload is stored losslessly in MPEG-1 Layer I frames at 32 kHz, mono, protected. Layer I gives each of
32 subbands 12 samples a frame at the width that the allocation names; 8 bits are allowed with every code but 255, and
UTF-8 never has the byte 255. So 384 payload bytes are a frame's samples. The last frame allocates only
the subbands that it needs and takes the least bitrate that holds them, so the stream's bitrate varies; a table frame
with Xing fields comes first, and an ID3v2 tag keeps the payload's length.

Defined results: null text stores as the empty text; the payload is padded with zeros to a positive multiple of 64;
media that hold no frame, are null, or are cut short have a frame count of what is whole, and no error; repeated rows
are stored each on its own; empty tables give no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm.common import map_slices, read, texts_of

BLOCK = 64
SUBBANDS, GROUPS = 32, 12
UNIT = SUBBANDS * GROUPS

# Fixed values of ISO 11172-3 and 13818-3: kbit/s by (is MPEG-1, layer), Hz by version bits, samples a frame.
BITRATES = {
    (True, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (True, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (True, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (False, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (False, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (False, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
SAMPLE_RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}


@lru_cache(4096)
def header(h: bytes) -> tuple | None:
    """(size, samples, rate, layer, MPEG-1, protected, mono, mode extension) of a four-byte frame header, None if it isn't one."""
    if len(h) < 4 or h[0] != 0xFF or h[1] & 0xE0 != 0xE0:
        return None
    version, layer, rate = h[1] >> 3 & 3, 4 - (h[1] >> 1 & 3), h[2] >> 2 & 3
    kbit = h[2] >> 4
    if version == 1 or layer == 4 or rate == 3 or kbit in (0, 15) or h[3] & 3 == 2:
        return None
    one = version == 3
    hz = SAMPLE_RATES[version][rate]
    bits = BITRATES[one, layer][kbit] * 1000
    padding = h[2] >> 1 & 1
    samples = 384 if layer == 1 else 1152 if layer == 2 or one else 576
    size = (12 * bits // hz + padding) * 4 if layer == 1 else samples // 8 * bits // hz + padding
    return size, samples, hz, layer, one, not h[1] & 1, h[3] >> 6 == 3, h[3] >> 4 & 3


def _crc_table() -> tuple[int, ...]:
    out = []
    for i in range(256):
        c = i << 8
        for _ in range(8):
            c = (c << 1 ^ 0x8005 if c & 0x8000 else c << 1) & 0xFFFF
        out.append(c)
    return tuple(out)


CRC = _crc_table()


@lru_cache(65536)
def crc16(data: bytes) -> int:
    """The frames' checksum: polynomial 0x8005, from 0xFFFF, most significant bit first."""
    c = 0xFFFF
    for b in data:
        c = (c << 8 & 0xFFFF) ^ CRC[c >> 8 ^ b]
    return c


# Fixed values of ISO 11172-3 (tables B.2a to B.2d) and 13818-3: the bits of Layer II's allocation by subband, as (subbands, bits).
ALLOCATION = {
    "a": ((11, 4), (12, 3), (4, 2)),
    "b": ((11, 4), (12, 3), (7, 2)),
    "c": ((2, 4), (6, 3)),
    "d": ((2, 4), (10, 3)),
    "low": ((4, 4), (7, 3), (19, 2)),
}


def _allocation_bits(frame: bytes, one: bool, mono: bool) -> list[int]:
    """The width of each subband's allocation in a Layer II frame."""
    if not one:
        table = "low"
    else:
        hz, each = SAMPLE_RATES[3][frame[2] >> 2 & 3], BITRATES[True, 2][frame[2] >> 4] // (1 if mono else 2)
        table = ("d" if hz == 32000 else "c") if each < 56 else "a" if hz == 48000 or each <= 80 else "b"
    return [bits for n, bits in ALLOCATION[table] for _ in range(n)]


def protected_part(frame: bytes, layer: int, one: bool, mono: bool, extension: int) -> tuple[bytes, str]:
    """What a frame's checksum covers: whole bytes, and the bits after them."""
    joint = frame[3] >> 6 == 1
    if layer == 3:
        side = (17 if mono else 32) if one else (9 if mono else 17)
        return frame[2:4] + frame[6 : 6 + side], ""
    if layer == 1:
        bound = 4 * (extension + 1) if joint else 32
        nibbles = 32 if mono else 2 * bound + (32 - bound)
        return frame[2:4] + frame[6 : 6 + nibbles // 2], ""
    # Layer II: the allocation, and two bits of scale factor choice for each channel of a subband that has one.
    widths = _allocation_bits(frame, one, mono)
    bound = min(4 * (extension + 1), len(widths)) if joint else len(widths)
    bits, at, chosen = "".join(f"{b:08b}" for b in frame[6:70]), 0, 0
    for sb, width in enumerate(widths):
        for _ in range(1 if mono or sb >= bound else 2):
            used = "1" in bits[at : at + width]
            chosen += used * (2 if not mono and sb >= bound else 1)
            at += width
    at += 2 * chosen
    return frame[2:4] + frame[6 : 6 + at // 8], bits[at - at % 8 : at]


def checksum(part: tuple[bytes, str]) -> int:
    c = crc16(part[0])
    for bit in part[1]:
        c = (c << 1 ^ 0x8005 if (c >> 15) ^ (bit == "1") else c << 1) & 0xFFFF
    return c


@dataclass
class Audio:
    """What a media file holds. offsets: of every frame of sound."""

    offsets: list[int] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    samples: int = 0
    rate: int = 0
    layer: int = 0
    checked: int = 0
    broken: int = 0
    skipped: int = 0
    tags: dict[str, str] = field(default_factory=dict)
    table: dict[str, int] | None = None
    seek: list[int] = field(default_factory=list)

    @property
    def micros(self) -> int:
        return self.samples * 1_000_000 // self.rate if self.rate else 0


def _synchsafe(b: bytes) -> int:
    return (b[0] & 127) << 21 | (b[1] & 127) << 14 | (b[2] & 127) << 7 | b[3] & 127


def read_id3v2(data: bytes, at: int, tags: dict[str, str]) -> int:
    """Reads the tag at ``at`` and returns its size, 0 if there is none."""
    if data[at : at + 3] != b"ID3" or len(data) < at + 10:
        return 0
    major, flags, size = data[at + 3], data[at + 5], _synchsafe(data[at + 6 : at + 10])
    stop, pos = min(len(data), at + 10 + size), at + 10
    if flags & 0x40 and pos + 4 <= stop:  # extended header
        pos += _synchsafe(data[pos : pos + 4]) if major >= 4 else 4 + int.from_bytes(data[pos : pos + 4], "big")
    while major >= 3 and pos + 10 <= stop and data[pos]:
        name = data[pos : pos + 4].decode("latin-1")
        n = _synchsafe(data[pos + 4 : pos + 8]) if major >= 4 else int.from_bytes(data[pos + 4 : pos + 8], "big")
        body = data[pos + 10 : min(stop, pos + 10 + n)]
        if name[0] == "T" and body:
            text = body[1:].decode({0: "latin-1", 1: "utf-16", 2: "utf-16-be"}.get(body[0], "utf-8"), "replace").rstrip("\0")
            if name == "TXXX" and "\0" in text:
                name, text = (lambda k, v: (f"TXXX:{k}", v))(*text.split("\0", 1))
            tags[name] = text
        pos += 10 + n
    return 10 + size + (10 if flags & 0x10 else 0)


def _tail_tag(data: bytes, at: int, tags: dict[str, str]) -> int:
    """The size of an ID3v1 or APE tag at ``at``. ID3v1 has no size of its own, so the end, a header or a tag must come after its 128 bytes."""
    if data[at : at + 3] == b"TAG" and (len(data) == at + 128 or header(data[at + 128 : at + 132]) or data[at + 128 : at + 131] in (b"TAG", b"ID3") or data[at + 128 : at + 136] == b"APETAGEX"):
        for k, a, b in (("TIT2", 3, 33), ("TPE1", 33, 63), ("TALB", 63, 93)):
            if value := data[at + a : at + b].split(b"\0")[0].decode("latin-1").strip():
                tags.setdefault(k, value)
        return 128
    if data[at : at + 8] == b"APETAGEX" and len(data) - at >= 32:
        size, flags = struct.unpack_from("<I", data, at + 12)[0], struct.unpack_from("<I", data, at + 20)[0]
        return size + 32 if flags >> 29 & 1 else 32
    return 0


def _vbr_table(frame: bytes, layer: int, one: bool, protected: bool, mono: bool) -> tuple[dict[str, int], list[int]] | None:
    """A Xing, Info or VBRI table of the first frame, with its seek points."""
    if layer == 3:
        at = 4 + ((17 if mono else 32) if one else (9 if mono else 17))
    else:
        at = 4 + 2 * protected + (16 if mono else 32)
    for pos in (at, at + 2):
        if frame[pos : pos + 4] in (b"Xing", b"Info"):
            flags = int.from_bytes(frame[pos + 4 : pos + 8], "big")
            out, pos, points = {"xing": 1}, pos + 8, []
            for bit, key in ((1, "frames"), (2, "bytes")):
                if flags & bit:
                    out[key] = int.from_bytes(frame[pos : pos + 4], "big")
                    pos += 4
            if flags & 4:
                points = list(frame[pos : pos + 100])
            return out, points
    if frame[36:40] == b"VBRI" and len(frame) >= 62:
        size, frames = struct.unpack_from(">II", frame, 46)
        n, scale, width = struct.unpack_from(">HHH", frame, 54)
        return {"vbri": 1, "frames": frames, "bytes": size}, [int.from_bytes(frame[62 + i * width : 62 + (i + 1) * width], "big") * scale for i in range(n)]
    return None


_BEGIN = re.compile(rb"\xff[\xe0-\xff]|ID3|TAG|APETAGEX")


def parse(data: bytes | None) -> Audio:
    """Reads a whole media file."""
    out, data = Audio(), data or b""
    at, n = 0, len(data)
    stream, in_step = None, False  # in step: a frame ends here
    while at < n:
        h = header(data[at : at + 4])
        key = h and (h[2], h[3], h[4])
        if h and h[0] >= 8 and at + h[0] <= n and stream in (None, key):
            size, samples, rate, layer, one, protected, mono, extension = h
            frame = data[at : at + size]
            right = not protected or checksum(protected_part(frame, layer, one, mono, extension)) == frame[4] << 8 | frame[5]
            if _followed(data, at + size, key) or in_step and right:
                out.checked += protected
                out.broken += not right
                found = _vbr_table(frame, layer, one, protected, mono) if stream is None else None
                stream, in_step = key, True
                if found:
                    out.table, out.seek = found
                else:
                    out.offsets.append(at)
                    out.sizes.append(size)
                    out.samples += samples
                out.rate, out.layer = rate, layer
                at += size
                continue
        in_step = False
        if size := read_id3v2(data, at, out.tags) or _tail_tag(data, at, out.tags):
            at += size
            continue
        # Foreign bytes: on to the next place that may begin a header or tag; each byte is searched once.
        begin = _BEGIN.search(data, at + 1)
        to = begin.start() if begin else n
        out.skipped += to - at
        at = to
    return out


def _followed(data: bytes, at: int, key: tuple) -> bool:
    if at == len(data) or data[at : at + 3] in (b"TAG", b"ID3") or data[at : at + 8] == b"APETAGEX":
        return True
    h = header(data[at : at + 4])
    return bool(h) and (h[2], h[3], h[4]) == key


# --- writing -------------------------------------------------------------------------------------------------


@lru_cache(None)
def _frame_head(bands: int) -> tuple[bytes, int, int]:
    """The bytes before the samples of a frame with ``bands`` subbands of 8 bits, their length, and the frame's size."""
    used = bands + bands % 2  # a whole byte of scale factors and samples needs no bit offset below
    need = 4 + 2 + SUBBANDS // 2 + used * 6 // 8 + (used * 6 % 8 > 0) + bands * GROUPS
    index = next(i for i, k in enumerate(BITRATES[True, 1]) if i and 12 * k * 1000 // 32000 * 4 >= need)
    head = bytes([0xFF, 0xFE, index << 4 | 2 << 2, 0xC0])
    allocation = bytes([0x77] * (bands // 2) + [0x70] * (bands % 2)).ljust(SUBBANDS // 2, b"\0")  # 7: 8 bits a sample
    crc = crc16(head[2:4] + allocation).to_bytes(2, "big")
    return head + crc + allocation, (bands * 6 + 7) // 8, 12 * BITRATES[True, 1][index] * 1000 // 32000 * 4


def _bands_for(n: int) -> int:
    """Subbands for n samples: a multiple of 4, whose scale factors fill whole bytes."""
    return -(-n // (4 * GROUPS)) * 4


def payload_of(text: bytes) -> bytes:
    return text.ljust(max(BLOCK, -(-len(text) // BLOCK) * BLOCK), b"\0")


def encode(payload: bytes, length: int) -> bytes:
    """The payload (no byte 255) as a tagged, protected Layer I stream. length: the bytes before padding."""
    full, rest = divmod(len(payload), UNIT)
    head, scale, size = _frame_head(SUBBANDS)
    body = np.zeros((full, size), np.uint8)
    body[:, : len(head)] = np.frombuffer(head, np.uint8)
    at = len(head) + scale
    body[:, at : at + UNIT] = np.frombuffer(payload, np.uint8, full * UNIT).reshape(full, UNIT)
    frames, sizes = [body.tobytes()], [size] * full
    if rest:
        bands = _bands_for(rest)
        head, scale, last = _frame_head(bands)
        frames.append((head + bytes(scale) + payload[full * UNIT :].ljust(bands * GROUPS, b"\0")).ljust(last, b"\0"))
        sizes.append(last)
    sound = b"".join(frames)
    # The table frame: silent (nothing is allocated), with the fields in its ancillary bytes.
    head, _, size = _frame_head(SUBBANDS)
    quiet = head[:4]
    blank = bytes(SUBBANDS // 2)
    ends = np.cumsum([0, *sizes])
    total = size + int(ends[-1])
    points = [min(255, (size + int(ends[len(sizes) * p // 100])) * 256 // total) for p in range(100)]
    fields = b"Xing" + struct.pack(">III", 7, len(sizes), total) + bytes(points)
    table = (quiet + crc16(quiet[2:4] + blank).to_bytes(2, "big") + blank + fields).ljust(size, b"\0")
    return _tag({"payload": len(payload), "length": length}) + table + sound


def _tag(values: dict[str, int]) -> bytes:
    frames = b""
    for k, v in values.items():
        body = b"\3" + f"{k}\0{v}".encode()
        frames += b"TXXX" + bytes([len(body) >> 21 & 127, len(body) >> 14 & 127, len(body) >> 7 & 127, len(body) & 127]) + b"\0\0" + body
    n = len(frames)
    return b"ID3\4\0\0" + bytes([n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127]) + frames


def decode(data: bytes, audio: Audio) -> bytes:
    """The payload of a stream that ``encode`` made, from its frames' samples."""
    want = int(audio.tags["TXXX:payload"])
    out, i = [], 0
    while i < len(audio.offsets):
        # Frames of one size and one head, one after another, are read as a block.
        at, size = audio.offsets[i], audio.sizes[i]
        bands = 2 * data[at + 6 : at + 22].count(0x77)
        head, scale, _ = _frame_head(bands)
        j = i
        while j < len(audio.offsets) and audio.offsets[j] == at + (j - i) * size and audio.sizes[j] == size and data.startswith(head, audio.offsets[j]):
            j += 1
        if j == i:
            raise ValueError("a frame of another encoder")
        block = np.frombuffer(data, np.uint8, (j - i) * size, at).reshape(j - i, size)
        out.append(block[:, len(head) + scale : len(head) + scale + bands * GROUPS].tobytes())
        i = j
    return b"".join(out)[:want]


def features(audio: Audio) -> str:
    """Exact durations and a digest of the seek offsets, as text."""
    seek = hashlib.sha256(np.array(audio.offsets, "<i8").tobytes()).hexdigest()[:16]
    table = audio.table or {}
    return (
        f"layer={audio.layer};rate={audio.rate};frames={len(audio.offsets)};samples={audio.samples};micros={audio.micros};"
        f"checked={audio.checked};broken={audio.broken};skipped={audio.skipped};table_frames={table.get('frames', 0)};table_bytes={table.get('bytes', 0)};seek={seek}"
    )


# --- columns -------------------------------------------------------------------------------------------------


def _encoded(batch: pa.RecordBatch) -> pa.RecordBatch:
    media = [encode(payload_of(t), len(t)) for t in texts_of(batch)]
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(media, pa.binary())], ["doc_id", "media"])


def _probe(batch: pa.RecordBatch) -> pa.RecordBatch:
    media = texts_of(batch, "media")
    found = [parse(m) for m in media]
    cols = {
        "frames": [len(a.offsets) for a in found], "samples": [a.samples for a in found], "sample_rate": [a.rate for a in found], "micros": [a.micros for a in found],
        "checked": [a.checked for a in found], "broken": [a.broken for a in found], "skipped": [a.skipped for a in found],
        "seek_offsets": [a.offsets for a in found], "tags": [list(a.tags.items()) for a in found],
    }
    kinds = [pa.int64()] * 7 + [pa.list_(pa.int64()), pa.map_(pa.string(), pa.string())]
    return pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("media_id")), *(pa.array(v, k) for v, k in zip(cols.values(), kinds))], ["media_id", *cols])


PROBE = "media_id long, frames long, samples long, sample_rate long, micros long, checked long, broken long, skipped long, seek_offsets array<long>, tags map<string,string>"


def probe_media(df: DataFrame, media: str = "media", key: str = "media_id") -> DataFrame:
    """Durations, seek offsets, checksum counts and tags of a binary column of MPEG audio."""
    return df.select(F.col(key).cast("long").alias("media_id"), F.col(media).alias("media")).mapInArrow(map_slices(_probe, "media"), PROBE)


def _digest(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    for data in texts_of(batch, "media"):
        audio = parse(data)
        payload = decode(data, audio)
        rows.append((int(audio.tags["TXXX:length"]), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-BLOCK:]), len(data), hashlib.sha256(data).hexdigest(), features(audio), audio.micros, audio.offsets))
    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "duration_micros", "seek_offsets"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], ["doc_id", *names])


def stored_documents(docs: DataFrame) -> DataFrame:
    """doc_id and the text's stored media."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(map_slices(_encoded), "doc_id long, media binary")


DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, duration_micros long, seek_offsets array<long>"


def op2_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is read back from the stored media, with each stream's exact duration and the byte offset of every frame."""
    return stored_documents(read(spark, sf_dir, "documents")).mapInArrow(map_slices(_digest, "media"), DIGEST)
