import os
import sys
from datetime import datetime, timedelta

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from footfall import schemas  # noqa: E402
from footfall.runtime import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[4]", {
        "spark.sql.shuffle.partitions": "2",
        "spark.driver.memory": "4g",
        "spark.driver.host": "127.0.0.1",
        "spark.sql.warehouse.dir": str(root / "warehouse"),
        "spark.checkpoint.dir": str(root / "shared"),
        "spark.sql.streaming.numRecentProgressUpdates": "50",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def actions(spark):
    """Build visit actions from ``(session_id, seconds after 10:00, {column: value})``."""
    base = datetime(2024, 1, 10, 10, 0, 0)
    schema = T.StructType([*schemas.VISIT_ACTION, T.StructField("event_id", T.LongType())])

    def make(rows, user=1):
        out = []
        for i, (session, seconds, values) in enumerate(rows):
            at = base + timedelta(seconds=seconds)
            row = {name: "" for name in schema.names}
            row.update(date=at.strftime("%Y-%m-%d"), user_id=user, session_id=session, page_id="0",
                       action_time=at, city_id=0, event_id=i)
            out.append(tuple({**row, **values}[name] for name in schema.names))
        return spark.createDataFrame(out, schema)

    return make


@pytest.fixture(scope="session")
def users(spark):
    def make(*rows):
        """``(user_id, age, professional, city, sex)``"""
        return spark.createDataFrame(
            [(u, f"u{u}", f"n{u}", age, job, city, sex) for u, age, job, city, sex in rows], schemas.USER_INFO)

    return make


@pytest.fixture(scope="session")
def clicks(spark):
    """Build ad clicks from ``(time text, userid, adid)``, all in one place, or ``(..., province, city)``."""
    def make(*rows):
        full = [(datetime.fromisoformat(r[0]), *(r[3:] or (1, 10)), r[1], r[2]) for r in rows]
        return spark.createDataFrame(full, schemas.AD_CLICK)

    return make


@pytest.fixture(scope="session")
def rows():
    """The rows of a DataFrame as sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=str)
