"""Every registered query against its SQL, over whole tables."""

import sys
from pathlib import Path

import pytest

from paperward.queries import all_queries

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))
import check_oracles

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return check_oracles.database(FOLDER)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, database, name):
    result = check_oracles.compare(spark, database, FOLDER, name)
    assert result.startswith("ok"), result
