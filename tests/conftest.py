import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def sf():
    return SF


@pytest.fixture
def same():
    """Holds a query's rows against its SQL on the same files."""
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")

    def plain(v):
        if hasattr(v, "isoformat"):
            return v.isoformat()[:19].replace("T", " ")
        return round(v, 6) if isinstance(v, float) else v

    def check(df, sql):
        got = con.execute(sql)
        names = [d[0] for d in got.description]
        assert sorted(df.columns) == sorted(names)
        want = sorted(repr(tuple(plain(r[names.index(c)]) for c in sorted(names))) for r in got.fetchall())
        have = sorted(repr(tuple(plain(r[c]) for c in sorted(names))) for r in df.collect())
        assert have == want

    return check
