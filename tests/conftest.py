import glob
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false").config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("wh"))).getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return s


@pytest.fixture
def rows():
    """The rows of a frame as sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(type(x)), x) if not isinstance(x, (list, dict)) else (False, "", str(x)) for x in t))


DATA = "/root/testdata/sf0.001"


def _plain(x):
    return f"{x:.9g}" if isinstance(x, float) else str(x)


@pytest.fixture(scope="session")
def same_as_sql(spark):
    """Runs a query over the smallest data; with SQL, its rows must be those of the SQL."""
    import duckdb

    if not os.path.isdir(DATA):
        pytest.skip("no data")
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")

    def run(query, sql=None):
        df = query(spark, DATA)
        cols = sorted(df.columns)
        got = sorted(tuple(_plain(r[c]) for c in cols) for r in df.collect())
        if sql:
            cur = con.execute(sql)
            names = [c[0] for c in cur.description]
            assert sorted(names) == cols
            assert got == sorted(tuple(_plain(r[names.index(c)]) for c in cols) for r in cur.fetchall())

    return run
