"""Harvest (A7): patch and fill-in-the-middle examples of several
repositories as one job.

Patch examples of all repositories are written to one output, spans are
drawn with ``seed``, ``seed + 1``, ... per repository and share one
de-duplication, for which no span is moved.  The report counts the written files, so nothing is
computed twice.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from .diffs import fold_assistant, patch_examples
from .fim import fim_example, fim_unique


def repo_spans(files: DataFrame, repos: Sequence[str], seed: int = K.DEFAULT_SEED, **draw) -> DataFrame:
    """De-duplicated spans of ``files`` (repo, path, text): the n-th of
    ``repos`` draws with ``seed + n``; the first copy in (repository order,
    path, draw) stays.  Files of other repositories are left out."""
    place = F.array_position(F.array(*[F.lit(r) for r in repos]), F.col("repo"))
    known = files.where(place > 0)
    return fim_unique(known.withColumn("_place", place), F.col("_place"), seed=F.lit(seed) + F.col("_place").cast("int") - 1, **draw)


def harvest(commits: DataFrame, diffs: DataFrame, files: DataFrame, repos: Sequence[str], out_sft: str, out_fim: str,
            seed: int = K.DEFAULT_SEED, reason_from_subject: bool = True, **gates) -> DataFrame:
    """Append both kinds as JSONL, one folder per run and repository below
    ``out_sft`` and ``out_fim``, and return (kind, repo, n) of this run,
    counted from the files it wrote."""
    spark = commits.sparkSession
    known = F.col("repo").isin(list(repos))
    patches = fold_assistant(patch_examples(commits.where(known), diffs, reason_from_subject=reason_from_subject, **gates))
    spans = fim_example(repo_spans(files, repos, seed))
    counts = []
    for kind, rows, out in (("patch", patches, out_sft), ("fim", spans, out_fim)):
        run = f"{out.rstrip('/')}/run={uuid.uuid4().hex}"
        rows.select("repo", F.to_json(F.struct("messages"), {"ignoreNullFields": "false"}).alias("value")) \
            .write.partitionBy("repo").text(run)
        written = spark.read.schema("value string, repo string").text(run)
        counts.append(written.groupBy("repo").agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "repo", "n"))
    return counts[0].unionByName(counts[1])
