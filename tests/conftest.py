import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from recordlink.session import build_session

    session = build_session("local[8]", "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def one(spark):
    """Evaluate an expression over one row of named string values."""

    def run(expr, **values):
        names = list(values) or ["x"]
        row = tuple(values.get(n) for n in names)
        df = spark.createDataFrame([row], ", ".join(f"{n} string" for n in names))
        return df.select(expr.alias("r")).first()["r"]

    return run


@pytest.fixture
def many(spark):
    """Evaluate an expression of column `x` over a list of strings."""

    def run(expr, values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
        return [r["r"] for r in df.select("i", expr.alias("r")).orderBy("i").collect()]

    return run
