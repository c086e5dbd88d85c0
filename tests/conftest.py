import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from cohortloom.session import local_session  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return FOLDER


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    old = {}

    def change(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            old.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
