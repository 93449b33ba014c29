import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"

from docketlake.session import local_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck():
    import duckdb

    connection = duckdb.connect()
    for file in sorted(Path(SF).iterdir()):
        pattern = f"{file}/*.parquet" if file.is_dir() else str(file)
        connection.sql(f"CREATE VIEW {file.name.split('.')[0]} AS SELECT * FROM '{pattern}'")
    return connection


def rows_of(frame):
    """Rows as sorted tuples of text, columns by name: null, NaN and NaT look the same."""
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object).where(frame[columns].notna(), None)
    return columns, sorted(tuple("" if v is None else str(v).removesuffix(".0").removesuffix(" 00:00:00") for v in row) for row in plain.itertuples(index=False))


@pytest.fixture(scope="session")
def same_rows():
    def check(ours, theirs):
        a, b = rows_of(ours), rows_of(theirs)
        assert a[0] == b[0]
        assert len(a[1]) == len(b[1])
        assert a[1] == b[1]

    return check
