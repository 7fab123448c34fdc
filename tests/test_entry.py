"""The driver contract: entry runs, every query has a key, SQL keys match."""

import re

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert set(df.columns) == {"drop_reason", "n", "pct"}
    assert len(rows) >= 1


def test_registry_and_oracles():
    q, s = E.queries(), E.oracle_sql()
    assert len(q) >= 60
    assert set(s) <= set(q)
    # the training-data operators give SQL only where SQL can express them
    missing = {k for k in set(q) - set(s) if not re.match(r"op\d+_|pipeline$", k)}
    assert not missing, missing
