"""Twins are SQL texts, never the query itself."""

import __spark_entry__


def test_every_twin_is_sql():
    twins = __spark_entry__.oracle_sql()
    assert twins and all(isinstance(sql, str) for sql in twins.values())
    assert set(twins) <= set(__spark_entry__.queries())
