import glob
import os

import duckdb
import pandas as pd
import pytest

from sluiceway.plans import catalog

ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def ordered(df):
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    got = catalog.queries()[name](spark, sf_dir).toPandas()
    pd.testing.assert_frame_equal(ordered(got), ordered(duck.sql(ORACLES[name]).df()), check_dtype=False)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1500
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
