"""Every stage on a small corpus with the odd cases in it, and the whole run."""

import os

import cases
import corpus_pipeline
import duckdb
import pytest
from quarrymill.llm import queries
from test_models import corpus
from test_near_dedup import brute as brute_near
from test_substring_dedup import brute as brute_spans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("corpus"))
    docs, labels = corpus(spark)
    odd = [(None if r[0] is None else 1000 + r[0], r[1], r[2], r[3], r[4], "x", 1) for r in cases.rows()]
    extra = docs.selectExpr("*", "'x' as node", "1 as _kept_id").union(spark.createDataFrame(odd, "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, _kept_id int"))
    extra.repartition(3).write.parquet(f"{at}/documents.parquet")
    labels.write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([], extra.schema).write.parquet(f"{at}/empty/documents.parquet")
    labels.limit(0).write.parquet(f"{at}/empty/labels.parquet")
    return at


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if i < 4:
            assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / str(i)))
        seen[name] = (docs, docs := spark.read.parquet(str(tmp_path / str(i))))
    pairs = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    before, after = seen["quality classifier"]
    kept = {r.doc_id for r in after.collect()}
    good = {i for i in range(240) if i % 3}
    assert len(good - kept) <= 2 and len(kept & (set(range(240)) - good)) <= 4
    before, after = seen["MinHash near-dedup"]
    rows = pairs(before)
    want = {c for i, _, c, _ in brute_near([r for r in rows if r[0] is not None], 80)}
    assert sorted(i for i, _ in pairs(after) if i is not None) == sorted(want)
    assert sum(i is None for i, _ in pairs(after)) == sum(i is None for i, _ in rows)
    before, after = seen["substring dedup"]
    left = {i: (n, gone) for i, n, gone, _ in brute_spans(pairs(before))}
    texts = dict(pairs(after))
    for i, t in pairs(before):
        n, gone = left[i]
        if i is not None and n > gone > 0:
            assert len(texts[i].split()) == n - gone
        elif i is not None:
            assert (i in texts) == (gone == 0) and (gone or texts[i] == t)
    before, after = seen["mixing sources to target weights"]
    assert {*pairs(after)} <= {*pairs(before)} and 0 < after.count() < before.count()
    before, after = seen["best-fit packing"]
    assert sorted(map(repr, (r.doc_id for r in after.where("piece = 0").collect()))) == sorted(map(repr, (i for i, _ in pairs(before))))
    ran = corpus_pipeline.run(spark, sf_dir)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(repr, ran.select(*key).collect())) == sorted(map(repr, after.select(*key).collect()))


def test_empty_tables(spark, sf_dir):
    assert corpus_pipeline.run(spark, f"{sf_dir}/empty").count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.execute(f"create view {t.removesuffix('.parquet')} as from '{SF}/{t}'")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = con.sql(f"select {', '.join(cols)} from ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(repr, map(tuple, df.select(*cols).collect()))) == sorted(map(repr, want))
