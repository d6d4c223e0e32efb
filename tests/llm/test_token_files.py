import zlib

import cases
import numpy as np
import pytest
from quarrymill.llm import token_files as op

tokenizers = pytest.importorskip("tokenizers")

ODD = [
    "", " ", "  a  ", "One two", "don't  DON'T it's", "tab\there\nnew\u0085line x", "é e ́x", "naïve café İI ΑΣ Σ", "1 22 333, 4!", "日本 語 한국", "<|endoftext|> it", "a<|startoftext|>b c",
    "👍🏽 ok", "x" * 300 + " " + "y" * 120, "​ ﻿ z", "a  \n  b", "'s 'll ' ' s", "ﬁ ǅ ß", "\x00 a\x00b",
]


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(op.vocabulary_path())


def test_ids_are_those_of_whole_texts(tokenizer):
    enc = op.SpacedEncoder(op.vocabulary_path())
    r = np.random.default_rng(3)
    letters = list("aB1é '<|>.&*)(\n\t́Σİ日") + ["endoftext", "<|endoftext|>", "  "]
    texts = ODD + ["".join(r.choice(letters, int(r.integers(1, 40)))) for _ in range(4000)]
    texts += [f"{a}{chr(c)}{b} {chr(c)}" for c in range(0x2000) for a, b in (("é", "."), ("&", "*"))]  # every such character before and after signs and letters
    ids, length = enc.encode(texts)
    assert length.sum() == len(ids) == len(np.concatenate(np.split(ids, np.cumsum(length)[:-1])))
    for t, got in zip(texts, np.split(ids, np.cumsum(length)[:-1])):
        assert got.tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_full_cache_changes_nothing():
    enc = op.SpacedEncoder(op.vocabulary_path())
    once = enc.encode(ODD, 2)
    enc.LIMIT = 3
    for _ in range(2):
        assert all((a == b).all() for a, b in zip(enc.encode(ODD, 2), once))


def test_other_vocabularies_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="spaces"):
        op.SpacedEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def _wanted(rows, tokenizer):
    """By plain code: (doc_id, n_tokens, crc) in order of doc_id, and the whole stream's ids by document."""
    ids = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows]
    return sorted(ids, key=lambda x: (x[0] is not None, x[0] or 0))


@pytest.mark.parametrize("parts", [1, 4])
def test_files_read_back(spark, tokenizer, tmp_path, parts):
    rows = [(i, t) for i, t, *_ in cases.rows()] + [(100 + i, t) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame([(*r, "w", 0, "p") for r in rows], "doc_id bigint, text string, width string, part int, base string").repartition(3)
    uri = f"file://{tmp_path}/files"
    manifest = op.write_token_files(docs, uri, parts=parts).collect()
    assert len(manifest) == parts or parts > 1
    got = op.read_token_files(spark, uri).collect()
    want = _wanted(rows, tokenizer)
    key = lambda x: (x[0] is not None, x[0] or 0, *x[1:])
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=key) == sorted(((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want), key=key)
    by_start = sorted(got, key=lambda r: r.start)
    assert [r.start for r in by_start] == np.cumsum([0, *(r.n_tokens for r in by_start)])[:-1].tolist()
    assert [r.doc_id for r in by_start] == [i for i, _ in want]
    # The flat files, one after another, are the whole stream; the reader finds each document in it.
    flat = np.concatenate([np.fromfile(f, "<u2") for f in sorted((tmp_path / "files").glob("*.bin"))])
    reader = op.TokenReader(uri, manifest)
    for k, r in enumerate(by_start):
        assert reader.document(k).tolist() == flat[r.start : r.start + r.n_tokens].tolist()
        assert zlib.crc32(flat[r.start : r.start + r.n_tokens].astype("<u4").tobytes()) == r.ids_crc32
    with pytest.raises(IndexError):
        reader.document(len(rows))
    left = {p.name.split(".")[-1] for p in (tmp_path / "files").iterdir()}
    assert left == {"bin", "doc", "idx", "manifest"}


def test_one_id_for_most_rows_is_dealt_over_parts(spark, tmp_path):
    docs = spark.createDataFrame([(7 if i % 3 else i, "same text") for i in range(600)], "doc_id bigint, text string").repartition(4)
    uri = f"file://{tmp_path}/hot"
    sizes = [r.n_docs for r in op.write_token_files(docs, uri, parts=6).collect()]
    assert sum(sizes) == 600 and max(sizes) <= 250
    assert op.read_token_files(spark, uri).where("doc_id = 7").count() == 400


def test_blocks_of_a_part(spark, tmp_path, tokenizer, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_IDS", 5)
    rows = [(i, "word " * (i % 9)) for i in range(40)]
    uri = f"file://{tmp_path}/blocks"
    op.write_token_files(spark.createDataFrame(rows, "doc_id bigint, text string"), uri, parts=2)
    parts = op.read_manifest(spark, uri).toPandas()
    import pyarrow as pa

    out = list(op._read_part([pa.RecordBatch.from_pandas(parts)], uri))
    assert len(out) > 10 and sum(b.num_rows for b in out) == 40
    assert {r["doc_id"]: r["n_tokens"] for b in out for r in b.to_pylist()} == {i: len(x) for i, x in _wanted(rows, tokenizer)}


def test_empty_table(spark, tmp_path):
    uri = f"file://{tmp_path}/none"
    assert op.write_token_files(cases.empty(spark), uri).count() == 0
    assert op.read_token_files(spark, uri).count() == 0
