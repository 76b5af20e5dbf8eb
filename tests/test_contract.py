"""Every registered query against its SQL counterpart on the smallest data."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT / "tools"))
sys.path.insert(0, str(ROOT))

import __spark_entry__ as contract  # noqa: E402
import compare  # noqa: E402

from gaugeflow.workload.queries import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def database():
    return compare.connect(SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, database, name):
    found = contract.queries()[name](spark, SF_DIR)
    result = database.execute(contract.oracle_sql()[name])
    names = [part[0] for part in result.description]
    found_rows = [tuple(row) for row in found.collect()]
    assert compare.type_differences(found, result.description) == ""
    assert compare.differences(found_rows, found.columns, result.fetchall(), names) == ""


def test_entry(spark):
    assert contract.entry(spark).count() > 0
