"""Every registered query against its SQL oracle."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as entry
from tests.compare import differences, duck

DATA = "/root/testdata/sf0.001"
NAMES = sorted(entry.queries())


@pytest.fixture(scope="module")
def outcomes(spark):
    def check(name):
        return name, differences(spark, duck(DATA), name, DATA)

    with ThreadPoolExecutor(4) as pool:
        return dict(pool.map(check, NAMES))


@pytest.mark.parametrize("name", NAMES)
def test_query(outcomes, name):
    _, differing = outcomes[name]
    assert not differing


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(NAMES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
