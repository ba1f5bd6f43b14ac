"""Every registered query against its SQL, over the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as contract
from lakegauge.checks.oracles import ORACLES
from lakegauge.checks.queries import QUERIES
from oracle import differences

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test tables are not here")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, name):
    assert differences(spark, SF_DIR, QUERIES[name], ORACLES[name]) == ""


def test_entry(spark):
    row = contract.entry(spark).first()
    assert row.units > 0 and row.reference_units >= row.missing_units
