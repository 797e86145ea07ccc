"""Every registered query against its SQL, on the smallest tables."""

import glob
import os

import pytest

import __spark_entry__ as driver
from notewright.catalog.oracles import ORACLES
from notewright.catalog.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cut = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(cut(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= driver.queries().keys()
    assert ORACLES.keys() <= driver.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = driver.queries()[name](spark, SF_DIR)
    want = con.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert table(df.columns, df.collect()) == table(columns, want.fetchall())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_a_table_that_is_a_folder_of_files(spark, tmp_path):
    path = f"{tmp_path}/documents.parquet"
    spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(3).write.parquet(path)
    found = [QUERIES["resume_two_runs"](spark, d) for d in (SF_DIR, str(tmp_path))]
    rows = [table(df.columns, df.collect()) for df in found]
    assert rows[0] and rows[0] == rows[1]
