"""Every registered query against its SQL twin on the smallest sample."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from tallymark.checks.oracles import ORACLES
from tallymark.checks.queries import REGISTERED
from oracle_check import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(REGISTERED) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query_equals_its_twin(spark, db, name):
    df = REGISTERED[name](spark, FOLDER)
    assert differences(df, db, ORACLES[name]) == []


def test_entry_runs(spark):
    assert driver.entry(spark).columns[:2] == ["CODE", "COSTCENTER"]
