import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def normal(rows):
    """Rows of plain values as a sorted list that compares across engines."""
    import decimal

    def one(v):
        if v is None or v != v:
            return None
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float, decimal.Decimal)):
            return round(float(v), 6)
        return str(v)

    return sorted((tuple(one(v) for v in r) for r in rows), key=repr)


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    c = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        c.execute(f"create view {f.stem} as select * from '{f}'")

    def run(sql):
        out = c.sql(sql)
        return list(out.columns), out.fetchall()

    return run
