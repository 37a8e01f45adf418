"""Queries that use a derived view several times make it once and read it as a stored table."""

import pytest

from quantloom.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["a1_late_events", "a3_late_events"])
def test_bars_come_from_a_stored_table(spark, name):
    files = catalog.QUERIES[name](spark, SF).inputFiles()
    assert files and not [f for f in files if "lineitem" in f]
