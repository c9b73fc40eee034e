import os

import pytest

from platewise.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples of the named columns."""
    def collect(df, *columns):
        found = [tuple(r[c] for c in (columns or df.columns)) for r in df.collect()]
        return sorted(found, key=lambda r: tuple((v is None, str(type(v)), v) if v is not None else (True,) for v in r))

    return collect


@pytest.fixture
def write():
    def file(path, text, mode="w"):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, mode, newline="") as f:
            f.write(text)
        return str(path)

    return file
