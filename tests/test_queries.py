"""Every catalogue query against its SQL twin on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from docketry.queries.catalogue import oracle_sql, queries
from tools.check import compare, connect

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF, name).startswith("ok")


def test_every_query_has_sql():
    assert set(oracle_sql()) == set(queries())


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
