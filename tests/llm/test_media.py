import hashlib
import time
import zlib

import cases
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from quarrymill.llm import media as op


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=3000))
def test_round_trip(text):
    raw = text.encode("utf-8", "replace")
    payload = op.payload_of(raw)
    stored = op.encode(payload, len(raw))
    audio = op.parse(stored)
    assert op.decode(stored, audio) == payload
    assert audio.broken == audio.skipped == 0 and audio.checked == len(audio.offsets) + 1
    assert audio.samples == 384 * len(audio.offsets) == 384 * -(-len(payload) // 384)
    assert audio.table["frames"] == len(audio.offsets) and all(stored[o] == 0xFF for o in audio.offsets)


def test_resynchronises_and_counts_damage():
    stored = op.encode(op.payload_of(b"text " * 500), 2500)
    clean = op.parse(stored)
    tag = b"TAG" + b"title".ljust(125, b"\0")
    dirty = op.parse(b"\xff\xfb junk" + stored + tag)
    assert len(dirty.offsets) == len(clean.offsets) and dirty.skipped == 7 and dirty.tags["TIT2"] == "title"
    cut = op.parse(stored[: clean.offsets[-1] + 10])
    assert len(cut.offsets) == len(clean.offsets) - 1 and cut.skipped > 0
    bad = bytearray(stored)
    bad[clean.offsets[2] + 8] ^= 1
    assert op.parse(bytes(bad)).broken == 1
    at = clean.offsets[3]
    wedged = op.parse(stored[:at] + b"\xff\xe0wedge" + stored[at:])
    assert len(wedged.offsets) == len(clean.offsets) and wedged.skipped == 7
    assert op.parse(None).micros == 0 and op.parse(b"").offsets == [] and op.parse(b"no audio").skipped == 8


@pytest.mark.parametrize("foreign", [b"junk", b"", b"\xff\xff\xff", b"ID", b"TAGAPETAGE\xff"])
def test_foreign_bytes_with_headers_of_the_stream(foreign):
    stored = op.encode(op.payload_of(bytes(range(1, 250)) * 20), 4980)
    clean = op.parse(stored)
    head = stored[clean.offsets[0] : clean.offsets[0] + 4]
    for k in (1, 4, len(clean.offsets) - 1):
        at = clean.offsets[k]
        wedge = foreign + head + bytes(18 - len(foreign) - 4)
        audio = op.parse(stored[:at] + wedge + stored[at:])
        # The true places: those before the wedge, and those after it, moved by its length.
        assert audio.offsets == clean.offsets[:k] + [o + len(wedge) for o in clean.offsets[k:]]
        assert audio.skipped == len(wedge) and audio.broken == 0
        assert op.decode(stored[:at] + wedge + stored[at:], audio) == op.payload_of(bytes(range(1, 250)) * 20)


def test_long_foreign_runs_take_linear_time():
    stored = op.encode(op.payload_of(b"text " * 500), 2500)
    clean = op.parse(stored)
    at = clean.offsets[2]
    began = time.process_time()
    for filling in (b"\xff" * 2_000_000, b"ID" * 1_000_000, b"\xff\xfe" * 1_000_000):
        audio = op.parse(stored[:at] + filling + stored[at:])
        assert audio.offsets == clean.offsets[:2] + [o + len(filling) for o in clean.offsets[2:]] and audio.skipped == len(filling)
    assert time.process_time() - began < 60


def test_layer_three_header_and_tables():
    head = bytes([0xFF, 0xFB, 0x90, 0x00])  # MPEG-1 Layer III, 128 kbit/s, 44.1 kHz
    size, samples, rate, layer, *_ = op.header(head)
    assert (size, samples, rate, layer) == (417, 1152, 44100, 3)
    info = (head + bytes(32) + b"Xing" + (3).to_bytes(4, "big") + (9).to_bytes(4, "big") + (3753).to_bytes(4, "big")).ljust(417, b"\0")
    audio = op.parse(info + 9 * head.ljust(417, b"\1"))
    assert len(audio.offsets) == 9 and audio.table == {"xing": 1, "frames": 9, "bytes": 3753} and audio.micros == 9 * 1152 * 1_000_000 // 44100


def test_odd_cases(spark):
    docs = cases.documents(spark)
    out = op.stored_documents(docs).mapInArrow(op.map_slices(op._digest, "media"), op.DIGEST).collect()
    want = []
    for i, t, *_ in cases.rows():
        raw = (t or "").encode()
        p = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        want.append((i, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:5]) for r in out)
    assert op.stored_documents(cases.empty(spark)).count() == 0
    probed = op.probe_media(op.stored_documents(docs).where("doc_id is not null"), "media", "doc_id").collect()
    assert all(r.frames == len(r.seek_offsets) and r.broken == 0 for r in probed)


def bit_crc(bits):
    c = 0xFFFF
    for b in bits:
        c = (c << 1 ^ 0x8005 if (c >> 15) ^ (b == "1") else c << 1) & 0xFFFF
    return c


def layer_two(kbit_index, hz_index, mode, allocation, scfsi, damage=False):
    """A protected MPEG-1 Layer II frame, bit by bit."""
    head = "1" * 12 + "1" + "10" + "0" + f"{kbit_index:04b}{hz_index:02b}00{mode:02b}00" + "0000"
    covered = head[16:] + allocation + scfsi
    crc = bit_crc(covered) ^ damage
    size = 144 * op.BITRATES[True, 2][kbit_index] * 1000 // op.SAMPLE_RATES[3][hz_index]
    bits = head + f"{crc:016b}" + allocation + scfsi
    return int(bits.ljust(size * 8, "0"), 2).to_bytes(size, "big")


def test_layer_two_checksums():
    # 192 kbit/s, 44.1 kHz, stereo: 96 a channel, 30 subbands of 4, 3 and 2 bits for both channels.
    widths = [4] * 11 + [3] * 12 + [2] * 7
    allocation = "".join(("1" if sb % 3 == 0 else "0").rjust(w, "0") + "0" * w for sb, w in enumerate(widths))
    good = layer_two(10, 0, 0, allocation, "01" * 10)
    bad = layer_two(10, 0, 0, allocation, "01" * 10, damage=True)
    audio = op.parse(good + bad + good)
    assert (len(audio.offsets), audio.checked, audio.broken, audio.layer, audio.samples) == (3, 3, 1, 2, 3 * 1152)
    # 32 kbit/s, 48 kHz, mono: 8 subbands.
    mono = layer_two(1, 1, 3, "0001" + "0000" + "001" * 6, "10" * 7)
    assert op.parse(mono + mono).broken == 0 and op.parse(mono + mono).checked == 2


def plain_stream(text):
    """The stored form of a text by the format's rules, field by field."""
    payload = text + bytes(max(64, (len(text) + 63) // 64 * 64) - len(text))
    tag = b""
    for k, v in (("payload", len(payload)), ("length", len(text))):
        body = b"\x03" + k.encode() + b"\0" + str(v).encode()
        tag += b"TXXX\0\0\0" + bytes([len(body)]) + b"\0\0" + body
    out = [b"ID3\x04\0\0\0\0" + bytes([len(tag) >> 7, len(tag) & 127]) + tag, b""]
    for at in range(0, len(payload), 384):
        part = payload[at : at + 384]
        bands = 4 * ((len(part) + 47) // 48)
        need = 4 + 2 + 16 + (6 * bands + 7) // 8 + 12 * bands
        index = min(i for i in range(1, 15) if 48 * op.BITRATES[True, 1][i] * 1000 // 32000 >= need and 48 * op.BITRATES[True, 1][i] * 1000 // 32000 % 4 == 0)
        head = f"{0xFFFE:016b}{index:04b}1000" + "11000000"
        allocation = "0111" * bands + "0000" * (32 - bands)
        bits = head + f"{bit_crc(head[16:] + allocation):016b}" + allocation + "0" * 6 * bands
        frame = int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big") + part
        out.append(frame + bytes(48 * op.BITRATES[True, 1][index] * 1000 // 32000 - len(frame)))
    return out, payload


def test_query_equals_plain_encoder(spark):
    """op2's stored form, frame by frame, apart from the table frame, whose fields are compared."""
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in op.op2_mpeg_audio(spark, sf).collect()}
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        text = (d.text or "").encode()
        (tag, _, *frames), payload = plain_stream(text)
        stored = op.encode(op.payload_of(text), len(text))
        table = stored[len(tag) : len(stored) - sum(map(len, frames))]
        assert stored == tag + table + b"".join(frames)
        assert table[22:26] == b"Xing" and int.from_bytes(table[30:34], "big") == len(frames) and int.from_bytes(table[34:38], "big") == len(table) + sum(map(len, frames))
        r = got[d.doc_id]
        assert (r.n_bytes, r.payload_bytes, r.media_bytes, r.media_sha256) == (len(text), len(payload), len(stored), hashlib.sha256(stored).hexdigest())
        ends = [len(tag) + len(table)]
        for f in frames:
            ends.append(ends[-1] + len(f))
        assert r.seek_offsets == ends[:-1] and r.duration_micros == 384 * len(frames) * 1_000_000 // 32000
        assert f"layer=1;rate=32000;frames={len(frames)};" in r.feature and f"checked={len(frames) + 1};broken=0;skipped=0;" in r.feature
