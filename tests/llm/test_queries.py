"""The queries of the subpackage against their SQL twins on the smallest sample."""

from __future__ import annotations

import pytest

from oracle_check import connect, differences
from tallymark.llm.oracles import ORACLES
from tallymark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_twin(spark, db, name):
    assert differences(QUERIES[name](spark, FOLDER), db, ORACLES[name]) == []
