"""Every query against its SQL on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

if not os.path.isdir(FOLDER):
    pytest.skip("no test tables", allow_module_level=True)


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, sql, name):
    found = entry.queries()[name](spark, FOLDER)
    result = sql.execute(entry.oracle_sql()[name])
    wanted = table([c[0] for c in result.description], result.fetchall())
    assert table(found.columns, found.collect()) == wanted


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, name):
    rows = entry.queries()[name](spark, FOLDER).collect()
    assert rows
    if "recall" in name:
        assert rows[0]["recall"] > 0.5


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and all(r["prompt"] and r["nb_events_retrieved"] == 5 for r in rows)
