"""Every registered report query against its SQL."""

import math
import os

import duckdb
import pytest

from quarrymill.plans import catalogue, catalogue_files  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.execute(f"create view {t.removesuffix('.parquet')} as from '{SF}/{t}'")
    return con


def _rows(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) and math.isfinite(x) else x for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, db, name):
    df = catalogue.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    sql = catalogue.ORACLES[name]
    assert cols == sorted(x[0] for x in db.sql(f"describe {sql}").fetchall())
    want = db.sql(f"select {', '.join(f'\"{c}\"' for c in cols)} from ({sql})").fetchall()
    assert _rows(df.select(*cols).collect()) == _rows(want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_places_of_large_keys(spark, tmp_path):
    """Keys above 16 and 32 bits, negative ones and nulls have their places too."""
    keys = [1, 32767, 32768, 50_000, 3_000_000_000, -4, None]
    events = [(None if e is None else e + 7 * i, None if k is None else 2 * k) for i, k in enumerate(keys) for e in (5, 40_000, -9, None)] + [(1, 3), (2, 100_001)]
    spark.createDataFrame(events, "event_id bigint, user_id bigint").write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    for more in (0, 300):  # few ranges, and more of them
        suppliers, d = [(k,) for k in [*keys, *range(200_000, 200_000 + more)]], f"{tmp_path}/{more}"
        os.makedirs(d)
        os.symlink(f"{tmp_path}/events.parquet", f"{d}/events.parquet")
        spark.createDataFrame(suppliers, "s_suppkey bigint").write.parquet(f"{d}/supplier.parquet")
        for t in ("events", "supplier"):
            con.execute(f"create or replace view {t} as from '{d}/{t}.parquet/*.parquet'")
        got = catalogue.QUERIES["q_address_places_v6"](spark, d).select("event_id", "place").collect()
        assert _rows(got) == _rows(con.sql(f"select event_id, place from ({catalogue.ORACLES['q_address_places_v6']})").fetchall())
