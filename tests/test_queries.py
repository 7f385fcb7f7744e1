"""Every query against its SQL counterpart on the smallest source tables."""

import os

import pytest
from compare import connect, duck_rows, spark_rows

from salesloom.plans.catalogue import QUERIES
from salesloom.plans.oracle import ORACLE

BASE = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return connect(BASE)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, db, name):
    names, types, rows = spark_rows(QUERIES[name](spark, BASE))
    want_names, want_types, want_rows = duck_rows(db, ORACLE[name])
    assert names == want_names
    assert types == want_types
    assert len(rows) == len(want_rows)
    assert rows == want_rows


def test_entry_has_rows(spark):
    import __spark_entry__

    assert set(__spark_entry__.queries()) >= set(QUERIES)
    assert set(__spark_entry__.oracle_sql()) >= set(ORACLE)
    assert __spark_entry__.entry(spark).count() == 5
