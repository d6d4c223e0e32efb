import random

import cases
import numpy as np
from quarrymill.llm import quality, toxicity


def corpus(spark):
    r = random.Random(2)
    docs, labels = [], []
    for i in range(240):
        good, bad_words = i % 3 > 0, i % 4 == 0
        words = [r.choice(["alpha", "beta", "gamma", "delta", "of", "the"]) + r.choice(["", "s", "ed"]) for _ in range(r.randint(5, 260))]
        if not good:
            words = [w.upper() + "!!" for w in words] if i % 2 else ["### $$$"] + [words[0]] * len(words)
        if bad_words:
            words[len(words) // 2] = r.choice(["dreadful", "awful", "dreadness"])
        docs.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, int(good), int(bad_words), "x"))
    labels += [(None, 1, 1, "x"), (5, None, None, "x")]
    return spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, text string")


def test_quality_held_out(spark):
    docs, labels = corpus(spark)
    model = quality.train(docs, labels)
    out = quality.score_documents(docs, model).collect()
    wrong = [r for r in out if r.held_out and r.predicted != (r.doc_id % 3 > 0)]
    assert len(out) == 240 and len([r for r in out if r.held_out]) > 30 and len(wrong) <= 2
    odd = quality.score_documents(cases.documents(spark), model).collect()
    assert len(odd) == len(cases.rows()) and all(0 <= r.score <= 1 and r.held_out is not None for r in odd)
    by = {}
    for r, (i, t, *_) in zip(sorted(odd, key=lambda r: repr(r.doc_id)), sorted(cases.rows(), key=lambda r: repr(r[0]))):
        by.setdefault(i, set()).add(r.score)
    assert len(by[4]) == 1 and by[1] == by[2] and by[5] == by[6]
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in out)
    assert quality.keep_good(cases.empty(spark), model).count() == 0


def test_quality_without_labels(spark):
    docs, labels = corpus(spark)
    assert {r.score for r in quality.score_documents(docs, quality.train(docs, labels.limit(0))).collect()} == {0.5}
    assert {r.score for r in quality.score_documents(docs, quality.train(docs, labels.where("quality = 1"))).collect()} == {1.0}
    assert quality.score_documents(cases.empty(spark), quality.train(docs, labels.limit(0))).count() == 0


def test_quality_learns_from_every_labelled_document(spark):
    """More labelled documents than any sample, one of many passages: the model is that of a plain fit to all of them, on the driver and on executors, whatever the partitions."""
    good = lambda i: i % 3 > 0
    rows = [(i, " ".join([f"word{i % 7}" if good(i) else "WORD!!"] * (1 + i % 11)) + f" n{i}") for i in range(4400)]
    rows += [(4400, "word " * 5_000), (4400, "other text"), (None, "no id")] + [(4401, "same again")] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = [(i, int(good(i))) for i in range(4403)] + [(1, 0), (None, 1), (7, None)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int")
    own = sorted((r.doc_id, r.text) for r in docs.where("doc_id < 4400 or text = 'same again'").distinct().where(~quality.held_out()).collect())
    two = [x.text for x in docs.where("doc_id = 4400").where(~quality.held_out()).selectExpr("text", "xxhash64(text) h").orderBy("h").limit(1).collect()]
    own = sorted(own + [(4400, t) for t in two])
    x, first = quality.passages([t.encode() for _, t in own])
    x = x.astype(np.float64)
    assert len(own) > 3_200
    whole = quality.train(docs, labels)
    assert np.allclose(whole.mean, x.mean(0), atol=1e-6) and np.allclose(whole.scale, x.std(0) + 0.02, atol=1e-6)
    here, there = quality.train(docs.repartition(5), labels, epochs=3), quality.train(docs.repartition(2, "text"), labels.repartition(3), epochs=3, local=0)
    y = np.array([0.5 if i == 1 else float(good(i)) for i, _ in own])
    r = np.random.default_rng(7)
    shapes = {"E": (quality.FEATURES, quality.HIDDEN), "V": (quality.HIDDEN, quality.GATE), "U": (quality.HIDDEN, quality.GATE), "a": (quality.GATE,), "c": (quality.HIDDEN,)}
    w = {k: r.normal(0, s[0] ** -0.5, s) for k, s in shapes.items()} | {"e": np.zeros(quality.HIDDEN), "b": np.zeros(1)}
    m, v = ({k: 0.0 for k in w} for _ in range(2))
    for i in range(1, 4):
        for k, d in quality.gradients(w, (x - x.mean(0)) / (x.std(0) + 0.02), first, y).items():
            d = d + 1e-4 * w[k] * (k != "b")
            m[k], v[k] = 0.9 * m[k] + 0.1 * d, 0.999 * v[k] + 0.001 * d * d
            w[k] = w[k] - 0.03 * (m[k] / (1 - 0.9**i)) / (np.sqrt(v[k] / (1 - 0.999**i)) + 1e-8)
    for k in w:
        assert np.allclose(here.weights[k], w[k], atol=1e-4) and np.allclose(here.weights[k], there.weights[k], atol=1e-9), k


def test_attention_gradients():
    r = np.random.default_rng(0)
    x, first, y = r.normal(size=(7, quality.FEATURES)), np.array([0, 3, 4, 7]), np.array([1.0, 0.0, 1.0])
    init = lambda *s: r.normal(0, 0.5, s)
    w = {"E": init(quality.FEATURES, 4), "e": init(4), "V": init(4, 3), "U": init(4, 3), "a": init(3), "c": init(4), "b": init(1)}

    def loss(w):
        p = quality.forward(w, x, first)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for k, g in quality.gradients(w, x, first, y).items():
        for at in [tuple(r.integers(0, n) for n in w[k].shape) for _ in range(3)]:
            v = {**w, k: w[k].copy()}
            v[k][at] += 1e-6
            u = {**w, k: w[k].copy()}
            u[k][at] -= 1e-6
            assert abs((loss(v) - loss(u)) / 2e-6 - g[at]) < 1e-5, k
    share = quality.forward(w, x, first)["share"]
    assert np.allclose(np.add.reduceat(share, first[:-1]), 1)


def test_passage_counts():
    x, first = quality.passages([b"", b" \n", b"a b c", b"w " * 250, b"Abc, def. 12"])
    assert np.diff(first).tolist() == [1, 1, 1, 3, 1] and x.shape == (7, quality.FEATURES) and np.isfinite(x).all()


def test_toxicity_held_out(spark):
    docs, labels = corpus(spark)
    chain = toxicity.train(docs, toxicity.kinds(labels), categories=toxicity.KINDS)
    out = toxicity.score_documents(docs, chain).collect()
    wrong = [r for r in out if r.held_out and r.predicted != (r.doc_id % 4 == 0)]
    assert len(out) == 240 and len(wrong) <= 2 and all(0 <= r[f"p_{n}"] <= 1 for r in out for n in (*toxicity.KINDS, "toxic"))
    odd = toxicity.score_documents(cases.documents(spark), chain).collect()
    assert len(odd) == len(cases.rows()) and not any(r.predicted for r in odd)
    assert toxicity.score_documents(cases.empty(spark), chain).count() == 0
    none = toxicity.train(docs, toxicity.kinds(labels.limit(0)), categories=toxicity.KINDS)
    assert {r.score for r in toxicity.score_documents(docs, none).collect()} == {0.0}


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(y))
    rank[order] = np.arange(1, len(y) + 1)
    for v in np.unique(score):  # ties share their rank
        rank[score == v] = rank[score == v].mean()
    n = y.sum()
    return (rank[y > 0].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


def test_chain_sees_out_of_fold():
    r = np.random.default_rng(1)
    x = r.normal(size=(200, 3)).astype(np.float32)
    y = np.column_stack([x[:, 0] > 0, (x[:, 0] > 0) & (x[:, 1] > 0)]).astype(float)
    models, apart = toxicity.fit_chain(x, y, np.arange(200) % 4)
    assert [len(m.w) for m in models] == [3, 4] and apart.shape == (200, 2)
    p = toxicity.Chain({}, ("a", "b"), models).probabilities(x)
    assert ((p > 0.5) == y).mean() > 0.9


def test_shuffled_labels_teach_nothing(spark):
    """Terms, categories and earlier probabilities are out of fold: labels dealt by chance can't be told."""
    docs, labels = corpus(spark)
    rows = [r for r in labels.collect() if r.doc_id is not None and r.toxic is not None]
    real, found = toxicity.train(docs, toxicity.kinds(labels), categories=toxicity.KINDS).apart, []
    for seed in range(3):
        marks = [(r.quality, r.toxic) for r in rows]
        random.Random(seed).shuffle(marks)
        dealt = spark.createDataFrame([(r.doc_id, q, t) for r, (q, t) in zip(rows, marks)], "doc_id bigint, quality int, toxic int")
        found.append(auc(*toxicity.train(docs, toxicity.kinds(dealt), categories=toxicity.KINDS).apart))
    assert auc(*real) > 0.97 and abs(np.mean(found) - 0.5) < 0.1, found


def test_a_labelled_id_that_repeats_is_one_row(spark):
    docs, labels = corpus(spark)
    more = docs.union(spark.range(2000).selectExpr("8L", "'some other text ' || id % 3", "'en'", "'s'", "1L")).repartition(4)
    ids = quality.training_ids(labels, "quality", 100)
    assert quality.labelled_texts(more, ids).count() == ids.count()
    a, b = (quality.labelled_texts(more.repartition(n), ids).where("doc_id = 8").collect() for n in (2, 5))
    assert a == b
    kept = quality.within(spark.createDataFrame([(1, 5), (2, 3), (3, 9)], "doc_id bigint, size bigint"), 8).collect()
    assert sum(r["size"] for r in kept) <= 8 and kept
    assert len(toxicity.train(docs, toxicity.kinds(labels), categories=toxicity.KINDS, terms_in_all=600).apart[0]) < len(toxicity.train(docs, toxicity.kinds(labels), categories=toxicity.KINDS).apart[0])


def plain_score(m, text):
    """A document's score by a loop over its passages, from their features."""
    code, raw = [], []
    for x in quality.passages([text])[0]:
        z = np.tanh(((x - m.mean) / m.scale) @ m.weights["E"] + m.weights["e"])
        gate = 1 / (1 + np.exp(-(z @ m.weights["U"])))
        code.append(z), raw.append(float((np.tanh(z @ m.weights["V"]) * gate) @ m.weights["a"]))
    share = np.exp(np.array(raw) - max(raw))
    bag = sum(s * z for s, z in zip(share / share.sum(), code))
    return 1 / (1 + np.exp(-(bag @ m.weights["c"] + m.weights["b"][0])))


def test_query_scores_equal_plain_loops(spark):
    """op3: the attention one text and one passage at a time."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    out = quality.op3_attention_mil_quality(spark, sf).collect()
    assert sorted(r.doc_id for r in out) == sorted(texts) and max(len(t.split()) for t in texts.values()) > 5 * quality.PASSAGE
    for r in out:
        assert abs(plain_score(model, texts[r.doc_id]) - r.score) < 1e-6 and r.predicted == (r.score >= 0.7)


def test_query_probabilities_equal_plain_loops(spark):
    """op6: the chain by a loop over each text's terms."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    chain = toxicity.train(docs, toxicity.kinds(spark.read.parquet(f"{sf}/labels.parquet")), categories=toxicity.KINDS)
    assert chain.names == ("junk", "prose", "toxic")
    out = {r.doc_id: r for r in toxicity.op6_toxicity_chain(spark, sf).collect()}
    for d in docs.collect():
        terms = {t for w in (d.text or "").encode().lower().split() for t in toxicity.terms_of(w)}
        p = []
        for m in chain.models:
            z = m.b + sum(m.w[i] for t, i in chain.known.items() if t in terms) + sum(m.w[len(chain.known) + j] * q for j, q in enumerate(p))
            p.append(m.constant if m.constant is not None else 1 / (1 + np.exp(-z)))
        r = out[d.doc_id]
        assert np.allclose([r.p_junk, r.p_prose, r.p_toxic], p, atol=1e-6) and r.predicted == (r.score >= 0.5)


def test_chain_learns_category_columns(spark):
    rows = [(i, " ".join(["plain", "words"] + ["filthy"] * (i % 3 == 0) + ["dreadful"] * (i % 4 == 0))) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, None if i % 7 == 1 else int(i % 3 == 0), int(i % 4 == 0)) for i in range(240)], "doc_id bigint, obscene int, toxic int")
    chain = toxicity.train(docs, labels, categories=("obscene",))
    assert chain.names == ("obscene", "toxic")
    for r in toxicity.score_documents(docs, chain).collect():
        assert (r.p_obscene > 0.5) == (r.doc_id % 3 == 0) and r.predicted == (r.doc_id % 4 == 0)


def test_label_columns_of_any_name(spark):
    """Only the columns that the caller names are categories; what isn't a number in them isn't learned from."""
    rows = [(i, "plain words" + " filthy" * (i % 3 == 0)) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = [(i, int(i % 3 == 0), i % 2, "no number", [], "x" if i % 5 else str(int(i % 3 == 0))) for i in range(120)]
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int, quality int, junk string, prose array<int>, insult string")
    assert toxicity.train(docs, labels).names == ("toxic",)
    assert toxicity.train(docs, toxicity.kinds(labels), categories=toxicity.KINDS).names == ("junk", "prose", "toxic")
    chain = toxicity.train(docs, labels, categories=("insult",))
    out = toxicity.score_documents(docs, chain).collect()
    assert chain.names == ("insult", "toxic") and all(r.predicted == (r.doc_id % 3 == 0) == (r.p_insult > 0.5) for r in out)


def test_terms_are_chosen_inside_the_folds(spark, monkeypatch):
    docs, labels = corpus(spark)
    sizes, choose = [], toxicity.choose_terms
    monkeypatch.setattr(toxicity, "choose_terms", lambda d, y, most: sizes.append(len(d)) or choose(d, y, most))
    toxicity.train(docs, toxicity.kinds(labels), categories=toxicity.KINDS)
    n = len((*toxicity.KINDS, "toxic"))
    assert len(sizes) == n * (toxicity.FOLDS + 1) and sum(sizes) == n * toxicity.FOLDS * max(sizes)
