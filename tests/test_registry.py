"""Every registered query against its SQL twin on the smallest tables."""

import glob
import importlib.util
import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
contract = importlib.util.module_from_spec(spec)
spec.loader.exec_module(contract)

pytestmark = pytest.mark.skipif(not glob.glob(f"{DATA}/*.parquet"), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def test_contract():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["qid", "rank", "id", "distance"]


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    ours = contract.queries()[name](spark, DATA).toPandas()
    theirs = duck.execute(contract.oracle_sql()[name]).df()
    columns = sorted(theirs.columns)
    assert sorted(ours.columns) == columns

    def table(df):
        df = df[columns].astype(object)
        return sorted(df.where(df.notna(), None).itertuples(index=False, name=None), key=repr)

    assert table(ours) == table(theirs)
