from __future__ import annotations

import pytest

from vulnatlas.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__sql__maxMetadataStringLength="2000", spark__driver__memory="6g",
        spark__sql__warehouse__dir=str(base / "warehouse"), spark__checkpoint__dir=str(base / "shared"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""
    return lambda df: sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.fixture
def plan():
    """The optimized and physical plan of a DataFrame as text."""
    return lambda df: df._jdf.queryExecution().toString()
