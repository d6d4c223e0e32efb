import random

import cases
import numpy as np
import pytest
from quarrymill.llm import components
from quarrymill.llm import near_dedup as op
from quarrymill.llm.common import Scratch


def sets_of(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows, percent):
    """(doc_id, n_shingles, component_id, kept) of each row."""
    sets = [sets_of(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
                label[root(a)] = root(b)
    least = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            least[root(x)] = min(least.get(root(x), i), i)
    comp = [least.get(root(x), i) for x, (i, _) in enumerate(rows)]
    return sorted(((i, len(s), c, i is not None and i == c) for (i, _), s, c in zip(rows, sets, comp)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def test_odd_cases(spark):
    assert got(op.near_duplicates(cases.documents(spark), 85)) == brute([(r[0], r[1]) for r in cases.rows()], 85)
    assert op.near_duplicates(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("percent,block", [(85, 512), (80, 8)])
def test_groups_of_copies(spark, percent, block):
    r = random.Random(percent)
    rows, i = [], 0
    for _ in range(6):
        base = [f"b{r.randint(0, 10**6)}" for _ in range(120)]
        for _ in range(r.choice([1, 3, 25])):
            text = list(base)
            for _ in range(r.randint(0, 4)):
                text[r.randrange(len(text))] = f"e{r.randint(0, 10**6)}"
            rows.append((i, " ".join(text)))
            i += 1
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert got(op.near_duplicates(df, percent, block=block)) == brute(rows, percent)


def copies_of(base, n, r, changes):
    rows = []
    for i in range(n):
        text = list(base)
        for _ in range(changes):
            text[r.randrange(len(text))] = f"e{i}x{r.randint(0, 10**6)}"
        rows.append(" ".join(text))
    return rows


def test_pairs_of_blocks_decide_what_the_rounds_leave(spark):
    """Copies too far apart to link with most others, and no round of families at all."""
    r = random.Random(8)
    base = [f"b{i}" for i in range(150)]
    rows = list(enumerate([*copies_of(base, 30, r, 2), *copies_of(base, 30, r, 5)]))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert got(op.near_duplicates(df, 85, block=8, rounds=0)) == brute(rows, 85)
    assert got(op.near_duplicates(df, 85, block=4, rounds=1)) == brute(rows, 85)


def test_a_large_family_sends_rows_in_proportion(spark, monkeypatch):
    """Near copies of one text: the rows sent to comparisons grow with their number, not with its square."""
    sent = {}
    for n in (500, 4000):
        r = random.Random(n)
        base = [f"b{i}" for i in range(60)]
        df = spark.createDataFrame(list(enumerate([" ".join(base), *copies_of(base, n, r, 1)])), "doc_id bigint, text string").repartition(4)
        made, put = {}, Scratch.put
        with monkeypatch.context() as m:
            m.setattr(Scratch, "put", lambda self, df, name: made.setdefault(name, put(self, df, name)))
            m.setattr(Scratch, "drop", lambda self, *names: None)
            out = op.near_duplicates(df, 80, block=64)
            assert {row.component_id for row in out.collect()} == {0}
            sent[n] = {k: v.count() for k, v in made.items() if k.startswith(("placed", "links", "open", "blocks"))}
    rows = {n: sum(c for k, c in v.items() if k.startswith(("placed", "links"))) for n, v in sent.items()}
    assert rows[4000] <= 12 * rows[500] and rows[4000] <= 4 * 4001, sent
    assert "blocks" not in sent[4000], sent


def test_one_of_each_group_stays(spark):
    docs = cases.documents(spark)
    out = op.keep_one(docs)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert ids.count(None) == 2 and ids.count(4) == 1 and {1, 5, 6, 7, 8, 10, 12} <= set(ids) and not {2, 3, 9, 11} & set(ids)


def test_repeated_and_null_ids_keep_a_row_of_each_component(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(1, a, "x"), (1, b, "x"), (1, b, "y"), (2, a, "x"), (3, b + " tail", "x"), (4, c, "x"), (None, d, "x"), (None, d, "y"), (None, d + " tail", "z"), (None, " ", "x"), (None, None, "x"), (5, "", "x"), (5, "", "y")]
    out = op.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string, label string").repartition(3)).collect()
    assert sorted((r.doc_id, r.text) for r in out if r.doc_id) == [(1, a), (1, b), (4, c), (5, "")]
    none = [r.text for r in out if r.doc_id is None]
    assert len(none) == 3 and len([t for t in none if t and t.strip()]) == 1


def test_sketch_agrees_as_often_as_sets():
    r = np.random.default_rng(3)
    for n in (1, 3, 40, 800):
        both = r.integers(0, 2**63, 3 * n, dtype=np.uint64)
        a, b = np.unique(both[: 2 * n]), np.unique(both[n:])
        sa, sb = op.sketch(a, 252), op.sketch(b, 252)
        assert (sa != np.uint64(2**64 - 1)).all()
        assert (sa == op.sketch(a, 252)).all()
        if n > 3:
            assert abs((sa == sb).mean() - 1 / 3) < 0.15


def test_links_within():
    r = np.random.default_rng(5)
    sets = [np.unique(r.integers(0, 30, 25, dtype=np.uint64)) for _ in range(40)]
    want = {(i, j) for j in range(40) for i in range(j) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 60 * len(np.union1d(sets[i], sets[j]))}
    found = op.links_within(sets, 60)
    assert set(found) <= want

    def parts(edges):
        label = list(range(40))
        for a, b in edges:
            label = [label[a] if x == label[b] else x for x in label]
        return [label.index(x) for x in label]

    assert parts(found) == parts(want)
    across = op.links_within(sets, 60, split=15)
    assert set(across) <= {(i, j) for i, j in want if i < 15 <= j}


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 101), (105, 101), (7, 7), (300, 299)]
    df = spark.createDataFrame(edges, "u bigint, v bigint")
    out = {r.node: r.label for r in components.connected_components(df, Scratch(spark), "t").collect()}
    assert all(out[i] == 0 for i in range(21)) and out[105] == out[100] == 100 and out[300] == 299
