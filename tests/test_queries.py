"""Every registered query with SQL gives that SQL's rows."""

import pytest
from tests.conftest import same_as_sql

from tallyforge.plans import registry

#: Queries whose result can be empty on the smallest tables.
MAY_BE_EMPTY = {"modal_quarantine", "modal_share_roles"}


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(name, spark, duck, sf):
    assert name in registry.ORACLE_SQL
    rows = same_as_sql(registry.QUERIES[name](spark, sf), duck, registry.ORACLE_SQL[name])
    assert rows or name in MAY_BE_EMPTY


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
