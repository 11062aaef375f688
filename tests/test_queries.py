"""Registered queries against their SQL counterparts at the smallest scale.

The quick ones run by default; `ALL_QUERIES=1` runs every one.
"""

import os

import pytest
from oracle_compare import connect, difference

from __spark_entry__ import entry, queries
from tributary.plans.oracles import ORACLES
from tributary.plans.registered import QUERIES

SF = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
SLOW = ("A10", "F9", "F10", "F13", "F18", "G", "J11", "J5", "O3", "P22", "S13", "S15", "T1_", "T2", "T6", "T9", "X")
NAMES = [n for n in QUERIES if os.environ.get("ALL_QUERIES") or not n.startswith(SLOW)]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    assert difference(QUERIES[name](spark, SF), duck, ORACLES[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0
