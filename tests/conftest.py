import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripflow.session import build_session  # noqa: E402

TABLE_ROOT = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("session")
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(work / "warehouse"),
        spark__checkpoint__dir=str(work / "shared"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test and put the old ones back."""
    saved = {}

    def change(**options):
        for key, value in options.items():
            name = key.replace("__", ".")
            saved.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in saved.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture(scope="session")
def tables():
    path = f"{TABLE_ROOT}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path
