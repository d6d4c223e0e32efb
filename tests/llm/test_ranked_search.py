import math
import re
from collections import Counter

import cases
import duckdb
import numpy as np
import pytest
from quarrymill.llm import ranked_search as op

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return TERM.findall((text or "").translate(SMALL))


def brute(docs, items, k):
    """By plain code: every document against every item."""
    counts = [(i, Counter(_terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, words = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for i, c in counts:
            m = 100 - 25 + (25 * sum(c.values()) * n) // words
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in _terms(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item_id, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return out


def _got(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_terms():
    for t in ["", "a-b_c", "ÀB éÉ x9", "日本 語!Z", "\x00\x7fq\x80r", "It's 3.14", "ſK"]:
        assert [x.decode() for x in op.terms(t.encode())] == _terms(t)


@pytest.mark.parametrize("segment", [1, 50, 2_000_000])
def test_against_brute_force(spark, segment):
    rows = [(i, t) for i, t, *_ in cases.rows()]
    items = [(1, "w1 w2 W3 changed w1"), (2, "one TWO"), (3, ""), (None, "x1 tail é"), (5, None), (2, "a w399"), (7, "nowhere")]
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id bigint, text string, rank int, score string").repartition(3)
    got = op.search(docs, spark.createDataFrame([(*r, 9) for r in items], "item_id bigint, text string, doc_id int"), k=4, segment=segment)
    assert _got(got) == sorted(brute(rows, items, 4), key=repr)


def _random(seed, n_docs, n_words):
    r = np.random.default_rng(seed)
    p = 1 / np.arange(1, n_words + 1)
    word = lambda k: " ".join(f"t{x}" for x in r.choice(n_words, k, p=p / p.sum()))
    docs = [(int(i), word(int(r.integers(1, 60)))) for i in range(n_docs)]
    return docs + [(i + n_docs, t) for i, t in docs[:40]], [(j, word(int(r.integers(1, 12)))) for j in range(25)]  # copies make ties


@pytest.mark.parametrize("run", [1, 32])
def test_random_corpora(spark, monkeypatch, run):
    monkeypatch.setattr(op, "RUN", run)
    docs, items = _random(run, 400, 150)
    got = op.search(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4), spark.createDataFrame(items, "item_id bigint, text string"), k=20, segment=900)
    assert _got(got) == sorted(brute(docs, items, 20), key=repr)


def test_blocks_of_queries(spark):
    docs, items = _random(5, 100, 60)
    got = op.search(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), k=5, query_bytes=300)
    assert _got(got) == sorted(brute(docs, items, 5), key=repr)


def test_search_ends_early():
    """Documents sorted by impact in every list: the first run decides, ties at the k-th place are all read."""
    n, size = 50_000, 3
    impact = np.repeat(np.arange(n, 0, -1, dtype=np.int64), size)
    seg = op.Segment(np.arange(n), np.zeros(n, bool), np.arange(n + 1) * size, np.tile(np.arange(size), n), impact, size)
    best = op.Best(10)
    read = op.threshold_search(seg, np.arange(size), np.ones(size, np.int64), np.zeros(size, np.int64), best)
    assert best.doc.tolist() == list(range(10)) and read <= size * op.RUN
    seg = op.Segment(np.arange(n)[::-1].copy(), np.zeros(n, bool), np.arange(n + 1) * size, np.tile(np.arange(size), n), np.full(n * size, 7, np.int64), size)
    best = op.Best(10)
    op.threshold_search(seg, np.arange(size), np.ones(size, np.int64), np.zeros(size, np.int64), best)
    assert best.doc.tolist() == list(range(10))  # all score alike: the least ids, though they stand last in the lists


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "w1")], "item_id bigint, text string")
    assert op.search(cases.documents(spark), none).count() == 0
    assert op.search(cases.empty(spark), some).count() == 0


def test_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as from '/root/testdata/sf0.001/{t}.parquet'")
    want = con.sql(f"select item_id, rank, doc_id, score from ({op.ORACLE})").fetchall()
    assert _got(op.op13_threshold_search(spark, "/root/testdata/sf0.001")) == sorted(want, key=repr) and want
