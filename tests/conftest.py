import os
import tempfile

import pytest

from vejrkraft.session import build_session

# Executors import the package and the stand-in services from here.
_HERE = os.path.dirname(os.path.abspath(__file__))
_PATHS = [os.path.dirname(_HERE), _HERE, os.environ.get("PYTHONPATH", "")]
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in _PATHS if p)
os.environ.setdefault("PYSPARK_PYTHON", "python")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "vejrkraft-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows(df, *order):
    """Rows as plain tuples, sorted by their text so that nulls can be mixed in."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
