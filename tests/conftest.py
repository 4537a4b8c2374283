import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (sys.path[0], os.environ.get("PYTHONPATH", "")) if p)
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
    session = builder.config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck(sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    """Values of both engines in one form."""
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return str(v) if hasattr(v, "isoformat") else v


@pytest.fixture(scope="session")
def same_rows(duck):
    def check(df, sql):
        names = sorted(df.columns)
        found = sorted(repr([plain(v) for v in r]) for r in df.select(*names).collect())
        r = duck.sql(sql)
        at = {d[0]: i for i, d in enumerate(r.description)}
        assert sorted(at) == names
        assert found == sorted(repr([plain(row[at[n]]) for n in names]) for row in r.fetchall())

    return check
