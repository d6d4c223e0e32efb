import hashlib

import cases
import numpy as np
import pytest
from quarrymill.llm import mixing, sharding


def brute_shards(rows, limit):
    bits = [(f"{int(hashlib.md5(('' if i is None else str(i)).encode()).hexdigest()[:15], 16):060b}", len((t or "").encode())) for i, t in rows]
    out = []
    for h, n in bits:
        for d in range(61):
            total = sum(m for g, m in bits if g[:d] == h[:d])
            if total <= limit:
                out.append((h[:d], n, total))
                break
        else:
            out.append((h, n, None))
    return out


def test_extendible_hashing(spark):
    rows = [(i, "x" * (i * 37 % 200)) for i in range(300)] + [(i, None) for i in range(300, 305)]
    df = spark.createDataFrame([(*r, "p", 0) for r in rows], "doc_id bigint, text string, prefix string, depth int").repartition(3)
    for limit in (10**9, 3000, 250):
        out = sharding.assign(df, limit).collect()
        assert sorted((r.prefix, r.n_bytes, r.shard_bytes) for r in out) == sorted(brute_shards(rows, limit))
        assert all(r.page == 0 and r.depth == len(r.prefix) for r in out)


def test_equal_hashes_go_on_pages(spark):
    rows = [(1, "x" * 30)] * 40 + [(None, "y" * 20)] * 30 + [(2, "z" * 500), (3, ""), (3, "")]
    out = sharding.assign(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), 100).collect()
    assert len(out) == len(rows)
    sums = {}
    for r in out:
        sums.setdefault(r.shard_id, []).append(r.n_bytes)
    assert all(sum(v) <= 100 or len(v) == 1 for v in sums.values())
    assert all(sum(sums[r.shard_id]) == r.shard_bytes for r in out)
    assert sharding.assign(cases.empty(spark)).count() == 0
    assert sharding.assign(cases.documents(spark)).count() == len(cases.rows())


def test_write_shards(spark, tmp_path):
    docs = cases.documents(spark)
    sharding.write_shards(docs, str(tmp_path / "s"), 2000)
    assert spark.read.parquet(str(tmp_path / "s")).count() == docs.count()


def test_written_shards_keep_the_limit(spark, tmp_path):
    rows = [(1, "x" * 30, i) for i in range(40)] + [(None, "y" * 20, i) for i in range(30)] + [(2, "z" * 500, 0), (3, "", 0), (3, None, 1), (4, "w" * 60, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _h int").repartition(4)
    sharding.write_shards(docs, str(tmp_path / "s"), 100)
    out = spark.read.parquet(str(tmp_path / "s")).collect()
    assert sorted(map(repr, rows)) == sorted(repr((r.doc_id, r.text, r["_h"])) for r in out)
    sums = {}
    for r in out:
        sums.setdefault(r.shard_id, []).append(len(r.text or ""))
    assert all(sum(v) <= 100 or len(v) == 1 for v in sums.values())


def test_a_column_of_the_folders_name(spark, tmp_path):
    rows = [(i, "x" * 40, f"own{i}", i) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, Shard_id string, shard_id_ int")
    assert sharding.write_shards(docs, str(tmp_path / "s"), 200) == "shard_id__"
    out = spark.read.parquet(str(tmp_path / "s"))
    assert sorted((r[0], r[1], r[2], r[3]) for r in out.select(*docs.columns).collect()) == rows and out.select("shard_id__").distinct().count() > 1


def test_directory_covers_every_slot_once(spark):
    rows = [(i, "x" * (i * 37 % 200)) for i in range(300)]
    out = sharding.directory(sharding.assign(spark.createDataFrame(rows, "doc_id bigint, text string"), 900)).collect()
    depth = out[0].global_depth
    slots = [s for r in out for s in range(r.first_slot, r.first_slot + r.slots)]
    assert depth > 2 and len(slots) == len(set(slots)) and set(slots) <= set(range(2**depth)) and sum(r.n_docs for r in out) == 300
    assert all(r.prefix == f"{r.first_slot:0{depth}b}"[: r.depth] and r.shard_bytes <= 900 for r in out)
    assert sharding.directory(sharding.assign(cases.empty(spark))).count() == 0


def test_rake_meets_every_margin():
    r = np.random.default_rng(0)
    counts = r.integers(1, 100, 60).astype(float)
    axes = [np.arange(60) % 3, np.arange(60) % 4, np.arange(60) % 5]
    targets = [np.array([0.5, 0.3, 0.2]), np.full(4, 0.25), np.array([0.1, 0.1, 0.2, 0.3, 0.3])]
    w = mixing.rake(counts, axes, targets)
    for at, target in zip(axes, targets):
        assert np.allclose(np.bincount(at, weights=w), target, atol=1e-8)


def test_probabilities_spend_the_budget():
    r = np.random.default_rng(0)
    for _ in range(50):
        n, w = r.integers(1, 1000, 12).astype(float), r.random(12)
        budget = r.random() * n.sum()
        p = mixing.probabilities(n, w / w.sum(), budget)
        assert (p >= 0).all() and (p <= 1).all() and np.isclose((p * n).sum(), budget)
        free = p < 1
        assert np.ptp((p * n / w)[free]) < 1e-6 * budget if free.sum() > 1 else True


def test_mixing(spark):
    rows = [(i, "word " * (1 + i % 7), ["en", "fr"][i % 5 == 0], f"s{i % 3 if i % 2 else 0}", 0.5, 1) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, probability double, tokens int").repartition(4)
    out = mixing.mixing_weights(df, {"lang": {"en": 0.5, "fr": 0.5}}, budget=0.3).collect()
    total = sum(1 + i % 7 for i in range(2000))
    assert len(out) == 2000 and abs(sum(r.probability * r.tokens for r in out) - 0.3 * total) < 1e-6 * total
    assert abs(sum(r.tokens for r in out if r.kept) - 0.3 * total) < 0.05 * total
    u = lambda i: int(hashlib.md5(f"{i}/mix".encode()).hexdigest()[:13], 16) / 2**52
    assert all(r.kept == (u(r.doc_id) < r.probability) for r in out)
    kept = mixing.sample(df, {"lang": {"en": 0.5, "fr": 0.5}}, budget=0.3)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in out if r.kept}


def brute_mix(rows, targets, budget, temper=mixing.TEMPER):
    """(weight, probability) of each (source, lang, topic, tokens) row, by plain loops and bisection."""
    n = {}
    for *cell, tokens in rows:
        n[tuple(cell)] = n.get(tuple(cell), 0) + tokens
    total = sum(n.values())
    w = {c: m / total for c, m in n.items() if m}
    wish = []
    for a, axis in enumerate(mixing.AXES):
        seen = {}
        for c, m in n.items():
            if m:
                seen[c[a]] = seen.get(c[a], 0) + m / total
        t = targets.get(axis, temper)
        want = {k: t.get(k, v) if isinstance(t, dict) else v**t for k, v in seen.items()}
        wish.append({k: v / sum(want.values()) for k, v in want.items()})
    for _ in range(400):
        for a in range(3):
            now = {}
            for c, v in w.items():
                now[c[a]] = now.get(c[a], 0) + v
            w = {c: v * wish[a][c[a]] / now[c[a]] for c, v in w.items()}
    low, high = 0.0, 1e12
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(n[c], w[c] * mid) for c in w) < budget * total else (low, mid)
    return [(w.get((s, g, t), 0.0), min(1.0, w[s, g, t] * low / n[s, g, t]) if (s, g, t) in w else budget) for s, g, t, _ in rows]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = mixing.op8_ipf_mixing(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r for r in docs.collect()}
    assert len(out) == len(texts) and all(r.tokens == len((texts[r.doc_id].text or "").encode().split()) for r in out)
    assert all((r.source, r.lang) == (texts[r.doc_id].source or "", texts[r.doc_id].lang or "") for r in out)
    topics = mixing.fit_topics(docs)
    for r in out[:40]:  # the nearest centre, one text at a time
        words, x = mixing.profiles([(texts[r.doc_id].text or "").encode()])
        far = ((x[0] - topics.means[r.lang] - topics.centres) ** 2).sum(1)
        assert far[int(r.topic[5:])] <= far.min() + 1e-6
    assert len({r.topic for r in out}) > 2
    want = brute_mix([(r.source, r.lang, r.topic, r.tokens) for r in out], mixing.TARGETS, mixing.BUDGET)
    u = lambda i: int(hashlib.md5(f"{i}/mix".encode()).hexdigest()[:13], 16) / 2**52
    for r, (w, p) in zip(out, want):
        assert abs(r.weight - w) < 1e-6 and abs(r.probability - p) < 1e-4 and r.kept == (u(r.doc_id) < r.probability)


def test_many_cells_are_raked_on_the_executors(spark):
    rows = [(i, "word " * (1 + i % 7), ["en", "fr"][i % 5 == 0], f"s{i % 9 if i % 2 else 0}") for i in range(600)] + [(700, "", "en", "s0"), (701, "", "xx", "s0")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(4)
    targets, topics = {"lang": {"en": 0.5, "fr": 0.5}, "source": 0.3}, mixing.fit_topics(df)
    near = {r.doc_id: r for r in mixing.mixing_weights(df, targets, topics=topics).collect()}
    far = mixing.mixing_weights(df, targets, topics=topics, max_cells=1).collect()
    assert len(far) == len(near) == 602
    assert all(abs(r.weight - near[r.doc_id].weight) < 1e-5 and abs(r.probability - near[r.doc_id].probability) < 1e-4 for r in far)


@pytest.mark.parametrize("rounds", [1, 12])
def test_both_ways_of_raking_stop_alike(spark, rounds):
    """Targets that no weights meet (a source in one language only), or that are met slowly: the same weights after the same rounds."""
    rows = [("a", "en", 900), ("b", "en", 90), ("b", "fr", 9), ("c", "fr", 1), ("c", "en", 700)]
    df = spark.createDataFrame([(i, "w " * n, lang, source) for i, (source, lang, n) in enumerate(rows)], "doc_id bigint, text string, lang string, source string").repartition(2)
    targets, topics = {"source": {"a": 0.7, "b": 0.2, "c": 0.1}, "lang": {"en": 0.2, "fr": 0.8}, "topic": 1.0}, mixing.fit_topics(df)
    near, far = ({r.doc_id: r for r in mixing.mixing_weights(df, targets, topics=topics, rounds=rounds, max_cells=most).collect()} for most in (100, 1))
    w = {k: n for k, n in zip(range(5), (x[2] for x in rows))}
    for _ in range(rounds):  # by plain code; all texts are of one word, hence of one topic
        for axis, goal in ((0, targets["source"]), (1, targets["lang"])):
            have = {c: sum(w[k] for k in w if rows[k][axis] == c) for c in goal}
            w = {k: w[k] * goal[rows[k][axis]] / have[rows[k][axis]] for k in w}
    assert len({r.topic for r in near.values()}) == 1
    for k, want in w.items():
        assert abs(near[k].weight - want) < 1e-6 and abs(far[k].weight - want) < 1e-6 and abs(near[k].probability - far[k].probability) < 1e-6


def test_odd_cases(spark):
    out = mixing.mixing_weights(cases.documents(spark)).collect()
    assert len(out) == len(cases.rows()) and {r.tokens for r in out if r.doc_id in (5, 6, 7)} == {0}
    assert all(0 <= r.probability <= 1 for r in out) and len({r.kept for r in out if r.doc_id == 4}) == 1
    assert mixing.mixing_weights(cases.empty(spark)).count() == 0 and mixing.sample(cases.empty(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, None, None)], "doc_id bigint, text string, lang string, source string")
    assert mixing.mixing_weights(blank).first().tokens == 0


def test_topics_are_fitted_on_all_rows(spark):
    """The means and the centres are those of all rows, whatever the partitions; more rows than any sample, and repeated ones."""
    kinds = ["red green blue", "one two three four", "sun moon"]
    rows = [(i if i % 9 else None, " ".join([kinds[i % 3]] * (1 + i % 4)) + f" w{i % 50}", ["en", "fr"][i % 5 == 0], "s") for i in range(3000)]
    rows += [(i, "late words only here", "en", "s") for i in range(3000, 6000)] + [(9000, "", "en", "s"), (9001, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    topics = mixing.fit_topics(df.repartition(5), 4)
    again = mixing.fit_topics(df.repartition(2, "text"), 4)
    assert np.array_equal(topics.centres, again.centres) and np.array_equal(topics.mean, again.mean)
    own = [r for r in rows if r[1]]
    x, langs = mixing.profiles([r[1].encode() for r in own])[1], np.array([r[2] for r in own])
    for g in ("en", "fr"):
        assert np.allclose(topics.means[g], x[langs == g].mean(0), atol=1e-6)
    y = topics.less_language(x, langs.tolist())
    near = mixing.nearest(y, topics.centres)
    assert len(topics.centres) == 4 and all(np.allclose(topics.centres[i], y[near == i].mean(0), atol=1e-6) for i in range(4))
    assert list(np.bincount(near)) == sorted(np.bincount(near), reverse=True)


def test_sums_are_repeated_for_few_lengths(spark, monkeypatch):
    """Not each sum for each length of a prefix: small limits have nearly as many sums as documents."""
    rows = [(i, "x" * (3000 if i == 7 else i * 37 % 200)) for i in range(3000)]
    sizes, put = {}, sharding.Scratch.put
    monkeypatch.setattr(sharding.Scratch, "put", lambda self, df, name: (out := put(self, df, name), sizes.__setitem__(name, out.count()))[0])
    out = sharding.assign(spark.createDataFrame(rows, "doc_id bigint, text string"), 3000).collect()
    monkeypatch.undo()
    levels = sorted((int(k[5:]), n) for k, n in sizes.items() if k.startswith("level"))
    repeated = sum(n * (at - before) for (at, n), before in zip(levels, [-1, *(at for at, _ in levels)]))
    assert len(levels) > 2 and repeated < 6 * len(rows)
    few = [r for r in out if r.doc_id < 60]
    bits = [(f"{int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16):060b}", len(t)) for i, t in rows]
    assert len(out) == 3000 and all(r.shard_bytes == sum(n for b, n in bits if b.startswith(r.prefix)) <= 3000 for r in few)
    assert all(r.depth == 0 or sum(n for b, n in bits if b.startswith(r.prefix[:-1])) > 3000 for r in few)
