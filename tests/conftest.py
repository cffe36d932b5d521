import decimal
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .config("spark.local.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return c


def normal(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if v != v else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(normal(x) for x in v)
    return v


def same(df, duck, sql):
    """The frame's rows are the SQL's, columns by name."""
    found = duck.execute(sql)
    names = [x[0] for x in found.description]
    want = found.fetchall()
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    a = sorted(repr([normal(r[c]) for c in order]) for r in df.collect())
    b = sorted(repr([normal(r[names.index(c)]) for c in order]) for r in want)
    assert a == b
