"""Every registered query of the engine runs on the smallest tables; those with SQL agree with DuckDB on every row."""

from pathlib import Path

import pytest

from atomweft.plans import catalogue

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def rows(table):
    names = sorted(table.column_names)
    return sorted(repr(tuple(r[n] for n in names)) for r in table.to_pylist())


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    got = catalogue.queries()[name](spark, str(DATA)).toArrow()
    assert got.num_rows
    if sql := catalogue.oracle_sql().get(name):
        want = duck.execute(sql).to_arrow_table()
        assert sorted(got.column_names) == sorted(want.column_names)
        assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() and set(entry.oracle_sql()) <= set(entry.queries())
