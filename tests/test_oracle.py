"""Every catalogued query against DuckDB, on whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from compare import connect, duck_rows, spark_rows
from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracle import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


def test_every_oracle_has_a_query():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == duck_rows(duck, ORACLES[name])


def test_flagship(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["doc_id", "label", "prediction", "p_positive"]
    rows = df.collect()
    assert len(rows) == len({r.doc_id for r in rows}) > 0
    assert all(r.prediction == float(r.p_positive > 0.5) for r in rows)
