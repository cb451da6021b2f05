import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from plumbline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "plumbline-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def frame(spark):
    """Rows and a schema string -> DataFrame."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def values(df, *columns):
    """Sorted tuples of the chosen columns, or all."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.fixture(name="values")
def values_fixture():
    return values
