"""Preference, rejection-sampling and evaluation tables.

Per-group choices (chosen/rejected reply, winner, baseline, best run) are
``min``/``max`` over structs - partial aggregates that collapse a hot
group map-side - never a window over the group.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import materialize
from .quality import packed_order


# ------------------------------------------------------------------- E1
def unary_prefs(examples: DataFrame, votes: DataFrame, key: str = "id",
                vote: str = "vote", good: Sequence = ("good", 1)) -> DataFrame:
    """``(messages, assistant, label)`` rows: label 1 for a good vote."""
    v = votes.select(key, F.when(F.col(vote).isin(list(good)), F.lit(1)).otherwise(F.lit(0)).alias("label"))
    return examples.join(v, key, "inner")


# ------------------------------------------------------------------- E2
def pair_prefs(df: DataFrame, sig: str = "sig", reply: str = "assistant",
               label: str = "label", order: str = "ord") -> DataFrame:
    """Per prompt signature one chosen (first label-1 reply) and one
    rejected (first label-0 reply); one-sided signatures are dropped.
    ``order`` must be unique per row."""
    # the choice is made on orders alone: one fixed-width minimum a side, no reply is sorted or carried
    rows = materialize(df.select(sig, order, label, reply), "replies").withColumn("_o", packed_order(df, order))
    first = rows.groupBy(sig).agg(F.min(F.when(F.col(label) == 1, F.col("_o"))).alias("_c"), F.min(F.when(F.col(label) == 0, F.col("_o"))).alias("_r"))
    sides = materialize(first.where(F.col("_c").isNotNull() & F.col("_r").isNotNull()), "sides")
    text = rows.select(F.col("_o"), F.col(reply).alias("_text"))
    chosen = sides.join(text, F.col("_c") == F.col("_o")).select(sig, F.col("_text").alias("chosen"))
    rejected = sides.join(text, F.col("_r") == F.col("_o")).select(F.col(sig).alias("_sig"), F.col("_text").alias("rejected"))
    return chosen.join(rejected, F.col(sig).eqNullSafe(F.col("_sig"))).select(sig, "chosen", "rejected")


# ------------------------------------------------------------------- E3
def rft_winners(candidates: DataFrame, prompt: str = "prompt", size: str = "patch_len",
                cid: str = "cand_id", max_files: int = 2) -> DataFrame:
    """Candidates that pass tests, typecheck and lint with at most
    ``max_files`` files; the winner per prompt is the smallest patch
    (ties: lowest candidate id)."""
    ok = candidates.where(F.col("tests") & F.col("typecheck") & F.col("lint")
                          & (F.col("files_touched") <= max_files))
    best = ok.groupBy(prompt).agg(F.min(F.struct(F.col(size).alias("s"), F.col(cid).alias("c"))).alias("_w"))
    return best.select(prompt, F.col("_w.c").alias(cid), F.col("_w.s").alias(size))


# ------------------------------------------------------------------- E4
DEFAULT_REWARD = {"tests": 1.0, "typecheck": 0.2, "lint": 0.2,
                  "patch_len": 0.001, "files_touched": 0.1, "n_tok": 0.0005}


def reward(df: DataFrame, weights: dict | None = None) -> DataFrame:
    """+tests, +typecheck, +lint bonuses minus weighted patch size, files
    and tokens (weights are parameters)."""
    w = dict(DEFAULT_REWARD, **(weights or {}))
    r = (F.col("tests").cast("double") * w["tests"]
         + F.col("typecheck").cast("double") * w["typecheck"]
         + F.col("lint").cast("double") * w["lint"]
         - F.col("patch_len").cast("double") * w["patch_len"]
         - F.col("files_touched").cast("double") * w["files_touched"]
         - F.col("n_tok").cast("double") * w["n_tok"])
    return df.withColumn("reward", r)


# ------------------------------------------------------------- E5 / E7 / E11
def throughput(tokens, seconds) -> Column:
    """``tokens / seconds``, 0 when seconds is 0."""
    return F.when(T.col(seconds) > 0, T.col(tokens) / T.col(seconds)).otherwise(F.lit(0.0))


def top_runs(runs: DataFrame, by: str, k: int = 3, ascending: bool = False,
             order: str = "ord") -> DataFrame:
    """Successful runs, best ``k`` by a metric (input order breaks ties);
    the memory ranking keeps runs with memory > 0."""
    r = runs.where(F.col("success"))
    if ascending:
        r = r.where(F.col(by) > 0)
    o = F.col(by).asc() if ascending else F.col(by).desc()
    return r.orderBy(o, F.col(order).asc()).limit(k)


def score(speed: str = "short_tps", memory: str = "model_memory") -> Column:
    return (F.col(speed) / 10.0 * 0.4 + F.lit(10.0) / F.greatest(F.col(memory), F.lit(1.0)) * 0.3 + F.lit(3.0))


def best_run(runs: DataFrame, order: str = "ord") -> DataFrame:
    """Argmax of the composite score over successful runs, first wins ties."""
    s = runs.where(F.col("success")).withColumn("score", score())
    return s.orderBy(F.col("score").desc(), F.col(order).asc()).limit(1)


# ------------------------------------------------------------------- E6
def vs_baseline(runs: DataFrame, baseline: DataFrame, on: Sequence[str]) -> DataFrame:
    """Extra memory over the baseline (never negative) and slowdown percent
    (null when either speed is 0 or they are equal).  ``baseline`` has one
    row per ``on`` key; a run without one keeps its row against zeros."""
    b = baseline.select(*on, F.col("peak_cpu_memory").alias("_bmem"), F.col("short_tps").alias("_btps"))
    j = runs.join(b, list(on), "left").withColumns({
        "_bmem": F.coalesce("_bmem", F.lit(0.0)), "_btps": F.coalesce("_btps", F.lit(0.0))})
    slow = F.when((F.col("short_tps") > 0) & (F.col("_btps") > 0) & (F.col("short_tps") != F.col("_btps")),
                  (F.col("_btps") - F.col("short_tps")) / F.col("_btps") * 100.0)
    return j.withColumn("extra_memory", F.greatest(F.lit(0.0), F.col("peak_cpu_memory") - F.col("_bmem"))) \
            .withColumn("slowdown_pct", slow).drop("_bmem", "_btps")


# ------------------------------------------------------------------- E8
def compare_generations(a: DataFrame, b: DataFrame, on: str = "prompt_id",
                        text: str = "generated") -> DataFrame:
    """Side by side: each generation has tool markers cut (P24), then the
    last assistant turn extracted (P23)."""
    def clean(df, name):
        return df.select(on, T.extract_assistant(T.strip_tool_markers(text)).alias(name))
    return clean(a, "baseline").join(clean(b, "tuned"), on, "inner")


# ------------------------------------------------------------- E9 / E10
def eval_metrics(df: DataFrame, by: Sequence[str], loss: str = "loss", passed: str = "passed") -> DataFrame:
    """Mean eval loss and pass@1 per group (task, step)."""
    return df.groupBy(*by).agg(F.avg(loss).alias("eval_loss"),
                               F.avg(F.col(passed).cast("double")).alias("pass_at_1"),
                               F.count(F.lit(1)).alias("n"))


def canary_gate(df: DataFrame, version: str = "version", passed: str = "passed") -> DataFrame:
    """A version is promotable only when every canary prompt passes."""
    return df.groupBy(version).agg(F.bool_and(passed).alias("promote"), F.count(F.lit(1)).alias("n"))
