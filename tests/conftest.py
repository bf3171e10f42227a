import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from hailstat.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "hailstat-tests",
        "local[8]",
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "2",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """A DataFrame from tuples and a DDL schema; ISO texts become timestamps."""
    def make(data, ddl):
        import datetime as dt

        from hailstat.sources.tables import column_types

        types = list(column_types(ddl).values())
        def value(v, t):
            if t == "timestamp" and isinstance(v, str):
                return dt.datetime.fromisoformat(v).replace(tzinfo=dt.timezone.utc)
            return v
        return spark.createDataFrame([tuple(value(v, t) for v, t in zip(r, types)) for r in data], ddl)

    return make
