"""Odd tables that every operator must take."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from odd import SCHEMA, SF, odd_rows  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark):
    """The odd rows with further columns that bear inner names."""
    from pyspark.sql import functions as F

    names = ["_row_key", "row", "size", "fp", "shard", "spans", "blob", "idx", "cum", "_pid", "kept", "target", "copies", "a.b", "n_words", "norm"]
    return spark.createDataFrame(odd_rows(), SCHEMA).select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])


@pytest.fixture(scope="session")
def corpus(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
