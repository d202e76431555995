"""Every registered query against its independent SQL, on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from oracles import ORACLES
from sunledger.plans.catalog import QUERIES
from tests.conftest import SMALL
from tools.check_oracles import difference, rows_of


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(name, spark, duck):
    df = QUERIES[name](spark, SMALL)
    ours = rows_of(df.columns, [tuple(row) for row in df.collect()])
    result = duck.execute(ORACLES[name])
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    assert difference(ours, theirs) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
