"""Command line: the original dataset steps as Spark jobs.

    python -m quarry.cli pairs   --src LOGS --out OUT [--limit N] [--max_tool_chars 6000] [--checkpoint CK]
    python -m quarry.cli follow  --src LOGS --out OUT [--follow_k 50] [--follow_minutes 0] ...
    python -m quarry.cli qc      --in IN --out OUT [--min_user_chars 80] [--max_tokens 4096]
    python -m quarry.cli merge   IN [IN ...] [--out_dir data] [--name N] [--eval_frac F] ...
    python -m quarry.cli fim     --repo DIR --out OUT [--per_file 6] [--max_len 1600] [--seed 42]
    python -m quarry.cli git     --commits C --diffs D --out OUT [--max-files 20] ...
    python -m quarry.cli len-scan PATH [--tokenizer tokenizer.json]
    python -m quarry.cli len-clip IN OUT CAP [truncate|drop] [--tokenizer tokenizer.json]
    python -m quarry.cli peek    --path P [--n 3] [--max_chars 600] [--seed 0] [--contains S]

Paths are anything Spark reads (local, HDFS, object stores).  Outputs are
Spark output folders of JSONL part files.  Only small reports (counts per
reason, length statistics, the peeked sample) reach the driver.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions import constants as K
from .functions import text as T
from .operators import diffs as DF
from .operators import fim as FM
from .operators import harvest as H
from .operators import quality as Q
from .operators import segments as SG
from .operators import sessions as W
from .operators import split as SP
from .operators import stats as ST
from .session import ensure_checkpoint_dir, materialize
from .sources import code as C
from .sources import jsonl as J
from .sources import sinks as KS


def _spark() -> SparkSession:
    spark = SparkSession.builder.appName("quarry").getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _counter(tokenizer: str | None, special: bool):
    if not tokenizer:
        return None
    from .functions.tokenizer import token_count
    return token_count(tokenizer, special=special)


def cmd_pairs(spark, a):
    if a.checkpoint:
        # nightly loop: only logs not seen by earlier runs, pending user text
        # kept in the stream's state between runs
        from .streaming.incremental import incremental_pairs
        n = incremental_pairs(spark, a.src, a.out, a.checkpoint, max_tool_chars=a.max_tool_chars)
        print(json.dumps({"pairs": n}))
        return
    turns = SG.normalise(J.read_logs(spark, a.src), max_tool_chars=a.max_tool_chars, tool_fallback=True)
    pairs = W.build_pairs(turns, limit=a.limit)
    KS.write_chat(pairs, a.out, mode="overwrite")


def cmd_follow(spark, a):
    turns = SG.normalise(J.read_logs(spark, a.src), max_tool_chars=a.max_tool_chars, tool_fallback=False)
    if a.cwd_contains:
        turns = W.cwd_contains(turns, a.cwd_contains)
    win = W.follow_windows(turns, follow_k=a.follow_k, follow_minutes=a.follow_minutes,
                           min_user_chars=a.min_user_chars, limit=a.limit)
    KS.write_chat(win, a.out, mode="overwrite")


def cmd_qc(spark, a):
    rows = J.read_chat(spark, getattr(a, "in"))
    counter = "char4"
    if a.tokenizer:
        from .functions.tokenizer import messages_counter
        counter = messages_counter(a.tokenizer)
    groups = materialize(Q.with_counter(rows, Q.qc_groups(rows, a.min_user_chars), counter), "qc")
    KS.write_chat(Q.qc_clean(rows, groups, a.max_tokens), a.out, mode="overwrite")
    report = Q.qc_report(groups, a.max_tokens, include_kept=True).orderBy(F.desc("n")).collect()
    kept = Q.qc_reasons(groups, a.max_tokens).where(F.col("drop_reason") == "kept")
    tokens = ST.length_stats(kept, "n_tok", (0.5, 0.75, 0.9, 0.95), "floor").first().asDict()
    print(json.dumps({**{r["drop_reason"]: {"n": r["n"], "pct": r["pct"]} for r in report}, "kept_tokens": tokens}))


def cmd_merge(spark, a):
    df = J.read_chat_many(spark, a.inputs)
    flags = SP.merge_flags(df)
    # the unique set feeds the count, the split threshold and two writes:
    # materialise it once in the shared checkpoint folder
    uniq = materialize(df.join(flags.where(~F.col("is_dup")).select(F.col("ord").alias("_ord"), "sig"),
                               F.col("ord") == F.col("_ord")).drop("_ord"))
    n = uniq.count()
    k = SP.eval_size(n, a.eval_frac, a.eval_size, a.min_eval)
    train, ev = SP.split(uniq, "sig", k, seed=a.seed)
    tp, ep = KS.write_split(train, ev, a.out_dir, a.name, a.force)
    per = flags.groupBy(F.col("ord.src").alias("src")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per input
    rows = {a.inputs[r.src]: r.n for r in per}
    print(json.dumps({"inputs": rows, "unique": n, "duplicates": sum(rows.values()) - n, "train": n - k, "eval": k,
                      "train_path": tp, "eval_path": ep}))


def cmd_fim(spark, a):
    files = C.read_code(spark, a.repo)
    spans = FM.fim_unique(files, per_file=a.per_file, max_len=a.max_len, seed=a.seed)
    KS.write_chat(FM.fim_example(spans), a.out, mode="overwrite")


def cmd_git(spark, a):
    commits = C.read_commits(spark, a.commits, a.format)
    diffs = C.read_diffs(spark, a.diffs, a.format)
    ex = DF.patch_examples(commits, diffs, max_commits=a.max_commits, max_files=a.max_files,
                           max_lines=a.max_lines, before_budget=a.before_budget,
                           reason_from_subject=a.reason_from_subject, branch=a.branch,
                           all_branches=a.all_branches, include_remotes=a.include_remotes)
    if a.fold:
        ex = DF.fold_assistant(ex)
    out = ex.select(F.to_json(F.struct("messages", "assistant")).alias("value"))
    out.write.mode("overwrite").text(a.out)


def cmd_harvest(spark, a):
    names = [r.partition("=")[0] for r in a.repo]
    files = None
    for name, path in (r.split("=", 1) for r in a.repo):
        part = C.read_code(spark, path).withColumn("repo", F.lit(name))
        files = part if files is None else files.unionByName(part)
    report = H.harvest(C.read_commits(spark, a.commits, a.format), C.read_diffs(spark, a.diffs, a.format), files, names,
                       a.out_sft, a.out_fim, seed=a.seed, reason_from_subject=a.reason_from_subject, max_commits=a.max_commits,
                       max_files=a.max_files, max_lines=a.max_lines, before_budget=a.before_budget, branch=a.branch,
                       all_branches=a.all_branches, include_remotes=a.include_remotes)
    print(json.dumps([r.asDict() for r in report.collect()]))  # one row per kind and repository


def cmd_len_scan(spark, a):
    ex = J.read_examples(spark, a.path)
    udf = _counter(a.tokenizer, special=False)
    n_tok = udf(F.col("text")) if udf else T.text_token_estimate("text")
    row = ST.length_stats(ex.withColumn("n_tok", n_tok), "n_tok", (50, 90, 95, 99), "scan").collect()[0]
    print(json.dumps(row.asDict()))


def cmd_len_clip(spark, a):
    ex = J.read_examples(spark, a.inp, keep_empty=True)
    if a.tokenizer:
        from .functions.tokenizer import token_clip, token_count
        n_tok = token_count(a.tokenizer)(F.col("text"))
        status = (F.when(F.col("text") == "", F.lit("dropped")).when(n_tok <= a.cap, F.lit("kept"))
                  .otherwise(F.lit("dropped" if a.mode == "drop" else "clipped")))
        out = ex.withColumn("clip_status", status).withColumn(
            "text", F.when(F.col("clip_status") == "clipped", token_clip(a.tokenizer, a.cap)(F.col("text")))
            .otherwise(F.col("text")))
    else:
        out = ST.clip_tokens(ex, a.cap, "text", mode=a.mode)
    # the report needs the status alone: stored narrow instead of holding texts
    status = materialize(out.select("clip_status"), "clip")
    KS.write_examples(out.where(F.col("clip_status") != "dropped").drop("clip_status", "n_tok"),
                      a.out, mode="overwrite")
    print(json.dumps(ST.clip_report(status).collect()[0].asDict()))


def cmd_peek(spark, a):
    ex = J.read_chat(spark, a.path).where(~F.col("bad_json"))
    if a.contains:
        ex = Q.anchor_contains(ex, a.contains)
    ex = ex.withColumn("key", F.to_json(F.col("ord")))
    picks = SP.sample_n(ex, "key", a.n, seed=a.seed).select(
        T.turns("messages").alias("turns"), T.extra_turns("messages").alias("extra"),
        T.preview(T.first_content("messages", "user"), a.max_chars).alias("user"),
        T.preview(T.first_content("messages", "assistant"), a.max_chars).alias("assistant")).collect()
    for i, r in enumerate(picks, 1):
        print("=" * 88)
        print(f"Example {i}  |  turns={r['turns']}  |  extra_turns={r['extra']}")
        print("-" * 88)
        print("USER ▶\n" + (r["user"] or "") + "\n")
        print("ASSISTANT ▶\n" + (r["assistant"] or "") + "\n")


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="quarry")
    sub = ap.add_subparsers(dest="cmd", required=True)

    p = sub.add_parser("pairs")
    p.add_argument("--src", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--limit", type=int, default=None)
    p.add_argument("--max_tool_chars", type=int, default=K.DEFAULT_PAIR_TOOL_CHARS)
    p.add_argument("--checkpoint", default=None,
                   help="run incrementally (Structured Streaming, availableNow) with this checkpoint")
    p.set_defaults(fn=cmd_pairs)

    p = sub.add_parser("follow")
    p.add_argument("--src", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--follow_k", type=int, default=K.DEFAULT_FOLLOW_K)
    p.add_argument("--follow_minutes", type=int, default=0)
    p.add_argument("--limit", type=int, default=None)
    p.add_argument("--max_tool_chars", type=int, default=K.DEFAULT_FOLLOW_TOOL_CHARS)
    p.add_argument("--min_user_chars", type=int, default=K.DEFAULT_MIN_USER_CHARS)
    p.add_argument("--cwd_contains", default=None)
    p.set_defaults(fn=cmd_follow)

    p = sub.add_parser("qc")
    p.add_argument("--in", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--min_user_chars", type=int, default=K.DEFAULT_MIN_USER_CHARS)
    p.add_argument("--max_tokens", type=int, default=K.DEFAULT_MAX_TOKENS)
    p.add_argument("--tokenizer", default=None)
    p.set_defaults(fn=cmd_qc)

    p = sub.add_parser("merge")
    p.add_argument("inputs", nargs="+")
    p.add_argument("--out_dir", default="data")
    p.add_argument("--name", default=None)
    p.add_argument("--eval_frac", type=float, default=None)
    p.add_argument("--eval_size", type=int, default=None)
    p.add_argument("--min_eval", type=int, default=K.DEFAULT_MIN_EVAL)
    p.add_argument("--seed", type=int, default=K.DEFAULT_SEED)
    p.add_argument("--force", action="store_true")
    p.set_defaults(fn=cmd_merge)

    p = sub.add_parser("fim")
    p.add_argument("--repo", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--per_file", type=int, default=K.DEFAULT_FIM_PER_FILE)
    p.add_argument("--max_len", type=int, default=K.DEFAULT_FIM_MAX_LEN)
    p.add_argument("--seed", type=int, default=K.DEFAULT_SEED)
    p.set_defaults(fn=cmd_fim)

    p = sub.add_parser("git")
    p.add_argument("--commits", required=True)
    p.add_argument("--diffs", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--format", default="parquet")
    p.add_argument("--branch", default="main")
    p.add_argument("--max-commits", type=int, default=None)
    p.add_argument("--max-files", type=int, default=20)
    p.add_argument("--max-lines", type=int, default=1200)
    p.add_argument("--before-budget", type=int, default=8000)
    p.add_argument("--reason-from-subject", action="store_true")
    p.add_argument("--all-branches", action="store_true")
    p.add_argument("--include-remotes", action="store_true")
    p.add_argument("--fold", action="store_true", help="append the assistant turn to messages")
    p.set_defaults(fn=cmd_git)

    p = sub.add_parser("harvest", help="patch and FIM examples of several repositories as one job")
    p.add_argument("--repo", action="append", required=True, metavar="NAME=PATH", help="source tree; repeat in seed order")
    p.add_argument("--commits", required=True)
    p.add_argument("--diffs", required=True)
    p.add_argument("--format", default="parquet")
    p.add_argument("--out-sft", dest="out_sft", required=True)
    p.add_argument("--out-fim", dest="out_fim", required=True)
    p.add_argument("--branch", default="main")
    p.add_argument("--all-branches", dest="all_branches", action="store_true")
    p.add_argument("--include-remotes", dest="include_remotes", action="store_true")
    p.add_argument("--max-commits", dest="max_commits", type=int, default=50000)
    p.add_argument("--max-files", dest="max_files", type=int, default=8)
    p.add_argument("--max-lines", dest="max_lines", type=int, default=600)
    p.add_argument("--before-budget", dest="before_budget", type=int, default=6000)
    p.add_argument("--reason-from-subject", dest="reason_from_subject", action="store_true")
    p.add_argument("--seed", type=int, default=K.DEFAULT_SEED)
    p.set_defaults(fn=cmd_harvest)

    p = sub.add_parser("len-scan")
    p.add_argument("path")
    p.add_argument("--tokenizer", default=None)
    p.set_defaults(fn=cmd_len_scan)

    p = sub.add_parser("len-clip")
    p.add_argument("inp")
    p.add_argument("out")
    p.add_argument("cap", type=int)
    p.add_argument("mode", nargs="?", default="truncate", choices=["truncate", "drop"])
    p.add_argument("--tokenizer", default=None)
    p.set_defaults(fn=cmd_len_clip)

    p = sub.add_parser("peek")
    p.add_argument("--path", required=True)
    p.add_argument("--n", type=int, default=3)
    p.add_argument("--max_chars", type=int, default=600)
    p.add_argument("--seed", type=int, default=0)
    p.add_argument("--contains", default=None)
    p.set_defaults(fn=cmd_peek)
    return ap


def main(argv=None) -> None:
    a = parser().parse_args(argv)
    a.fn(_spark(), a)


if __name__ == "__main__":
    main(sys.argv[1:])
