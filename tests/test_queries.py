"""Every query of the library that SQL can express equals its SQL."""

from __future__ import annotations

import pytest

from reelspark.plans.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(name, spark, data, same):
    same(QUERIES[name](spark, data), SQL[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
