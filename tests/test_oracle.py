"""Every registered query against its SQL on the driver's tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__
from checks.compare import check
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equal_to_sql(spark, name):
    verdict, rows, _ = check(spark, name, SF_DIR)
    assert verdict == "equal"
    assert rows > 0


def test_entry_and_registry(spark):
    assert set(ORACLE) <= set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    features = __spark_entry__.entry(spark)
    assert len(features.columns) == 14
    assert features.count() > 0
