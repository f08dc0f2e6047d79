import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tenderloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", "tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def column(spark):
    """column(builder, values) -> results of a one-column builder, in input order."""
    def run(build, values, schema="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {schema}")
        rows = df.select("i", build("v").alias("r")).collect()
        return [r.r for r in sorted(rows, key=lambda r: r.i)]
    return run


@pytest.fixture(scope="session")
def columns(spark):
    """columns(builder, rows, names) -> results of a builder over several text columns."""
    def run(build, rows, names):
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "_i int, " + ", ".join(names))
        got = df.select("_i", build().alias("r")).collect()
        return [r.r for r in sorted(got, key=lambda r: r._i)]
    return run
