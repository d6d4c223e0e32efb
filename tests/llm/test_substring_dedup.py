import hashlib
import random

import cases
import pytest
from quarrymill.llm import substring_dedup as op
from quarrymill.llm.common import Scratch


def brute(rows, window=50):
    """(doc_id, n_words, n_removed, digest) of each row, by comparing every window."""
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for p in range(len(w) - window + 1):
            if i is not None:
                k = tuple(w[p : p + window])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        kept = [x for q, x in enumerate(w) if q not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr)


def test_odd_cases(spark):
    assert got(op.removed_words(cases.documents(spark))) == brute([(r[0], r[1]) for r in cases.rows()])
    assert op.removed_words(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts(spark, seed):
    r = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(6)]
    pool = [[r.choice(vocabulary) for _ in range(r.randint(4, 40))] for _ in range(12)]
    rows = []
    for i in range(60):
        text = [w for _ in range(r.randint(0, 6)) for w in r.choice(pool)]
        rows.append((r.randint(0, 45), " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert got(op.removed_words(df, window=12, kmer=4)) == brute(rows, 12)


def test_texts_keep_their_columns(spark):
    docs = cases.documents(spark)
    out = op.remove_repeats(docs)
    assert out.columns == docs.columns
    texts = {(r.doc_id, r.text, r.n_chars) for r in out.collect()}
    ids = {t[0] for t in texts}
    assert 2 not in ids and {1, 3, 4, 5, 6, 8, 10, None} <= ids  # 2 has nothing left; the empty ones stay
    assert (11, "tail", 4) in texts and out.where("doc_id = 4").count() == 3


def test_repeats_of_a_row_add_no_windows(spark, monkeypatch):
    r = random.Random(4)
    shared = [f"s{i}" for i in range(80)]
    texts = [" ".join([f"a{r.random()}" for _ in range(30)] + shared + [f"b{r.random()}" for _ in range(30)]) for _ in range(2)]
    sizes = {}
    for copies in (1, 250):
        made, put = {}, Scratch.put
        with monkeypatch.context() as m:
            m.setattr(Scratch, "put", lambda self, df, name: made.setdefault(name, put(self, df, name)))
            m.setattr(Scratch, "drop", lambda self, *names: None)
            rows = [(i, texts[i]) for i in range(2) for _ in range(copies)]
            out = op.removed_words(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
            assert got(out) == brute(rows)
            sizes[copies] = {k: v.count() for k, v in made.items()}
    once, often = sizes[1], sizes[250]
    assert often["occurrences"] == once["occurrences"] and often["wanted"] == once["wanted"] and often["spans"] == once["spans"]
    assert often["windows"] <= 4 * once["windows"] and often["edges"] <= 4 * once["edges"]  # once a task
