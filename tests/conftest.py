from __future__ import annotations

import pytest

from metroscope import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a small frame built from a list, after a function of columns."""

    def build(values, schema, *columns):
        df = spark.createDataFrame(values, schema)
        out = df.select(*columns) if columns else df
        return [tuple(r) for r in out.collect()]

    return build
