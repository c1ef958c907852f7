import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COUNT = os.path.join(os.path.dirname(os.path.abspath(__file__)), "count.toml")
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="session")
def sf():
    return SF


def plain(rows):
    """Rows in an order of their own, floats to nine digits."""
    return sorted(tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


def same_as_sql(df, con, sql):
    names = sorted(df.columns)
    got = plain(tuple(r[n] for n in names) for r in df.collect())
    answer = con.execute(sql)
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == names
    at = [columns.index(n) for n in names]
    assert got == plain(tuple(r[i] for i in at) for r in answer.fetchall())
    return got
