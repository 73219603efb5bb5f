"""Each query against its SQL in DuckDB, over whole tables."""

import os

import duckdb
import pytest

from granary.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def rows(table):
    def plain(v):
        if v is None or v != v:
            return "null"
        return round(v + 0.0, 6) if isinstance(v, float) else v

    return sorted((tuple(plain(v) for v in r) for r in table), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_against_sql(spark, duck, name):
    got = catalog.queries()[name](spark, FOLDER)
    columns = sorted(got.columns)
    want = duck.execute(f"select {', '.join(columns)} from ({catalog.oracle_sql()[name]})").fetchall()
    assert rows(tuple(r) for r in got.select(*columns).collect()) == rows(want)


def test_entry():
    import __spark_entry__

    assert set(catalog.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_leaders_and_greedy_boxes_keep_every_row(spark):
    assert catalog.queries()["near_dup_leaders"](spark, FOLDER).count() == spark.read.parquet(f"{FOLDER}/embeddings.parquet").count()
    boxes = catalog._boxes(spark, FOLDER).count()
    assert catalog.queries()["box_dedupe_greedy"](spark, FOLDER).count() == boxes
