import os
import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path.insert(0, str(HERE.parent))
# Tasks import the test modules; the package itself travels with its functions.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [str(HERE), os.environ.get("PYTHONPATH")]))

from shiftwell.session import build_session  # noqa: E402
from shiftwell.workspace import Workspace  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def workspace(spark, tmp_path):
    """Databases of their own for each test."""
    label = tmp_path.name.replace("-", "_")
    return Workspace(
        spark, str(tmp_path / "tables"), staging=f"staging_{label}", marts=f"marts_{label}"
    )


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    old = {}

    def change(**options):
        for key, value in options.items():
            key = key.replace("__", ".")
            old.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in old.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def rows(frame):
    """The rows as sorted tuples."""
    return sorted((tuple(row) for row in frame.collect()), key=repr)
