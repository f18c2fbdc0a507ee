"""Every query of the library against its SQL."""

from __future__ import annotations

import pytest

from landrank.plans import feeds, files, landed, places, ranking, staging
from tests.oracle import SF, answer, assert_same

QUERIES, SQL = ranking.QUERIES | feeds.QUERIES | files.QUERIES | landed.QUERIES | places.QUERIES | staging.QUERIES, ranking.SQL | feeds.SQL | files.SQL | landed.SQL | places.SQL | staging.SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert_same(QUERIES[name](spark, SF).toPandas(), answer(SQL[name]))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(SQL) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
