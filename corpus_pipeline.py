"""The corpus pipeline: five operators over ``documents``, each over what
its predecessor kept.  Needs the ``llm`` subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import block_naming, mixing, packing, quality, simhash
from quarry.llm.common import stash
from quarry.llm.queries import TOKENIZER, documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.quality_filter(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return block_naming.exact_dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near fingerprints."""
    return simhash.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows, with their ids."""
    return packing.pack(docs, TOKENIZER)


STAGES = [("quality rules", quality_rules), ("exact dedup", exact_dedup), ("near dedup", near_dedup),
          ("source mixing", mix_sources), ("packing", pack)]

#: The tokenizer and the fingerprints are beyond SQL; tests/llm holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each but the last is stored before the next reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
