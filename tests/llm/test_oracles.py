"""Registered queries against their SQL on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT / "tools"))

import compare  # noqa: E402

from gaugeflow.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    result = compare.connect(SF_DIR).execute(ORACLE_SQL[name])
    names = [part[0] for part in result.description]
    rows = [tuple(row) for row in found.collect()]
    assert compare.type_differences(found, result.description) == ""
    assert compare.differences(rows, found.columns, result.fetchall(), names) == ""
