import zlib

import cases
import numpy as np
import pytest
from quarrymill.llm import packing as op

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    t = tokenizers.Tokenizer.from_file(op.vocabulary_paths()[1])
    t.encode_special_tokens = True
    return t


def test_ids_are_the_tokenizers_ids(tokenizer):
    enc = op.encoder(op.vocabulary_paths()[0])
    texts = ["", " ", "a", " a", "a ", "a  b", "a \n b", "don't stop", "x\ny z", "naïve café x   y", "tab\there", "1 22 333, 4!", "<|endoftext|> it", "日本 語", "a" * 500 + " b", "\n\n a", "x \u0085y", "q\x1c r s"]
    for t in texts:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.fixture(scope="module")
def default_tokenizer():
    return tokenizers.Tokenizer.from_file(op.vocabulary_paths()[1])


SPECIAL = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "end  <|endoftext|>  \n b", "one two<|endoftext|>three four", "<|endoftext|", "<|endoftext<|endoftext|>|>", " <|endoftext|> ", "no token here"]


def test_added_tokens_have_their_own_ids(default_tokenizer):
    enc = op.encoder(*op.vocabulary_paths())
    for t in SPECIAL:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == default_tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_pieces_with_added_tokens(spark, default_tokenizer):
    out = op.pack_documents(spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id bigint, text string").repartition(2)).collect()
    ids = [np.array([*default_tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4") for t in SPECIAL]
    assert sorted((r.doc_id, r.length, r.ids_crc32) for r in out) == [(i, len(x), zlib.crc32(x.tobytes())) for i, x in enumerate(ids)]


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pieces_and_bins(spark, tokenizer, capacity):
    rows = cases.rows()
    out = op.pack_documents(cases.documents(spark), capacity=capacity).collect()
    want = []
    for i, t, *_ in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        cuts = [0, len(ids)] if len(ids) <= capacity else [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in out)
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) <= -(-sum(r.length for r in out) // capacity) + 1


def test_empty_table(spark):
    assert op.pack_documents(cases.empty(spark)).count() == 0


def test_fullest_is_the_best_subset():
    r = np.random.default_rng(1)
    for _ in range(200):
        lengths = sorted({int(x) for x in r.integers(1, 40, 8)}, reverse=True)
        counts = [(x, int(r.integers(1, 4))) for x in lengths]
        room = int(r.integers(1, 90))
        sums = {0}
        for x, n in counts:
            sums |= {s + x * k for s in sums for k in range(1, n + 1) if s + x * k <= room}
        used = op.fullest(counts, room)
        assert sum(x * k for x, k in used) == max(sums)
        assert all(k <= dict(counts)[x] for x, k in used)


def test_bins_use_everything_once():
    counts = {5: 7, 3: 100, 2: 1, 8: 4}
    bins = op.minimum_bin_slack(counts, 8)
    used = {}
    for repeats, company in bins:
        assert sum(x * t for x, t in company) <= 8
        for x, t in company:
            used[x] = used.get(x, 0) + repeats * t
    assert used == counts
