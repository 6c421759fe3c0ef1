import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.compare import connect, session  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    spark = session("8")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def db():
    return connect(FOLDER)


@pytest.fixture(scope="session")
def readings(spark, folder):
    from skyledger.sources import star
    return star.readings(spark, folder)


@pytest.fixture(scope="session")
def cleaned(readings):
    from skyledger.operators.cleaning import clean_readings
    return clean_readings(readings)
