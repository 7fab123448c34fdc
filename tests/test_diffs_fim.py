"""Diff parsing literals (G1-G4, F5-F7, D3, P22) and FIM invariants."""

from pyspark.sql import functions as F

from quarry.operators import diffs as DF
from quarry.operators import fim as FM

DIFF = "\n".join([
    "diff --git a/src/a.py b/src/a.py",
    "index 111..222 100644",
    "--- a/src/a.py",
    "+++ b/src/a.py",
    "@@ -1,3 +1,3 @@",
    " keep",
    "--- removed line that starts with dashes",
    "+added",
    "@@ -10,2 +10,2 @@",
    " ctx",
    "-old",
    "+new",
    "\\ No newline at end of file",
    "diff --git a/gone.txt b/gone.txt",
    "deleted file mode 100644",
    "--- a/gone.txt",
    "+++ /dev/null",
    "@@ -1 +0,0 @@",
    "-bye",
    "diff --git a/old.py b/new.py",
    "similarity index 100%",
    "rename from old.py",
    "rename to new.py",
    "diff --git a/img.png b/img.png",
    "Binary files a/img.png and b/img.png differ",
])


def test_diff_lines_and_paths(spark):
    df = spark.createDataFrame([("s1", DIFF)], "sha string, diff string")
    files = DF.diff_files(df).orderBy("file_no").collect()
    assert [f["path"] for f in files] == ["src/a.py", "gone.txt", "new.py", "img.png"]
    assert [len(f["hunks"]) for f in files] == [2, 1, 0, 0]
    ln = DF.diff_lines(df).where(F.col("file_no") == 0).orderBy("hunk_no", "pos").collect()
    kinds = [(r["hunk_no"], r["kind"]) for r in ln if r["hunk_no"] > 0]
    assert kinds == [(1, "hunk"), (1, "context"), (1, "removed"), (1, "added"),
                     (2, "hunk"), (2, "context"), (2, "removed"), (2, "added"), (2, "marker")]
    removed = [r["value"] for r in ln if r["kind"] == "removed"]
    assert removed[0] == "-- removed line that starts with dashes"


def test_before_after_and_blocks(spark):
    df = spark.createDataFrame([("s1", DIFF)], "sha string, diff string")
    ba = DF.before_after(DF.diff_files(df)).orderBy("file_no").collect()
    assert [r["path"] for r in ba] == ["src/a.py", "gone.txt"]     # hunk-less files dropped
    a = ba[0]
    assert a["before"] == "keep\n-- removed line that starts with dashes\nctx\nold\n"
    assert a["after"] == "keep\nadded\nctx\nnew\n"
    assert a["patch_block"].startswith("diff --git a/src/a.py") and a["patch_block"].endswith("file")
    assert ba[1]["before"] == "bye\n" and ba[1]["after"] == ""


def test_patch_examples_gates(spark):
    commits = spark.createDataFrame([
        ("r", "s1", ["p0"], "fix: parser\n\nbody", 2, 10, ["main", "dev"]),
        ("r", "s2", ["p0", "p1"], "fix merge", 1, 1, ["main"]),          # merge commit
        ("r", "s3", [], "add root", 1, 1, ["main"]),                     # root commit
        ("r", "s4", ["p0"], "chore: fix", 1, 1, ["main"]),               # boring
        ("r", "s5", ["p0"], "update docs", 50, 10, ["main"]),            # too many files
    ], "repo string, sha string, parents array<string>, message string, n_files int, n_lines int, refs array<string>")
    diffs = spark.createDataFrame([(s, DIFF) for s in ("s1", "s2", "s3", "s4", "s5")], "sha string, diff string")
    ex = DF.patch_examples(commits, diffs, reason_from_subject=True, all_branches=True).collect()
    assert sorted((r["sha"], r["path"]) for r in ex) == [("s1", "gone.txt"), ("s1", "src/a.py")]
    a = [r for r in ex if r["path"] == "src/a.py"][0]
    assert a["messages"][1]["content"].startswith("Commit intent: fix: parser\nFile: src/a.py\n<BEFORE>\nkeep")
    assert a["assistant"].endswith("```\nReason: fix: parser")
    folded = DF.fold_assistant(spark.createDataFrame(ex)).collect()
    assert all(len(r["messages"]) == 3 for r in folded)


def test_unique_commits_refs(spark):
    c = spark.createDataFrame([
        ("r", "a", ["main", "dev", "origin/main", "origin/HEAD"]),
        ("r", "b", ["origin/feature"]),
        ("r", "c", ["origin/HEAD"]),
    ], "repo string, sha string, refs array<string>")
    assert {r["sha"] for r in DF.unique_commits(c, all_branches=True).collect()} == {"a"}
    assert {r["sha"] for r in DF.unique_commits(c, all_branches=True, include_remotes=True).collect()} == {"a", "b"}
    assert {r["sha"] for r in DF.unique_commits(c, branch="dev").collect()} == {"a"}


def test_fim_invariants(spark):
    texts = [("p199", "a\n" * 99 + "b"), ("p200", "a\n" * 100), ("crlf", "x\r\n" * 300),
             ("oneline", "z" * 20001), ("long", ("line of code\n" * 400))]
    df = spark.createDataFrame(texts, "path string, text string")
    spans = FM.fim_spans(df, per_file=6, max_len=1600, seed=42).collect()
    paths = {r["path"] for r in spans}
    assert "p199" not in paths and "oneline" not in paths
    src = dict(texts)
    for r in spans:
        whole = r["prefix"] + r["middle"] + r["suffix"]
        code = src[r["path"]].replace("\r\n", "\n")
        assert whole in code and len(whole) <= 1600
        assert len(r["prefix"]) >= 20 and len(r["suffix"]) >= 20 and len(r["middle"]) >= 80
    again = FM.fim_spans(df.repartition(3), per_file=6, max_len=1600, seed=42).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, spans))
    later = [r.asDict() | {"sample_no": r["sample_no"] + 100} for r in spans[:3]]
    d = FM.fim_dedupe(spark.createDataFrame([r.asDict() for r in spans] + later))
    assert d.count() == len({(r["prefix"], r["middle"], r["suffix"]) for r in spans})


def test_spans_are_deduplicated_without_moving_texts(spark):
    body = "".join(f"line {i} of the file\n" for i in range(40))
    long = "".join(f"row {i * 7919 % 1000} and {i}\n" for i in range(400))
    files = spark.createDataFrame(
        [("b", "p", body), ("a", "p", body), ("a", "p", long), ("a", "p", body), ("a", None, body), ("a", None, body), ("b", "q", long), ("b", "r", None)],
        "repo string, path string, text string")
    for rank in (None, F.when(F.col("repo") == "b", 1).otherwise(2)):
        spans = FM.fim_spans(files.withColumn("repo", F.col("repo")))
        order = None if rank is None else F.struct(rank.alias("n"), F.col("path"), F.col("sample_no"))
        want = sorted(map(str, FM.fim_dedupe(spans, order).collect()))
        got = FM.fim_unique(files, rank)
        assert sorted(map(str, got.collect())) == want and (len(want) < spans.count() or rank is not None)
    from quarry.operators import harvest as H
    plan = H.repo_spans(files, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Broadcast" in plan


def test_diffs_stay_where_they_are_read(spark):
    commits = spark.createDataFrame([("r", str(i), ["p"], "Fix the parser so that it reads all lines", 1, 1) for i in range(50)],
                                    "repo string, sha string, parents array<string>, message string, n_files int, n_lines int")
    diffs = spark.range(500).select(F.lit("r").alias("repo"), F.col("id").cast("string").alias("sha"), F.lit(
        "diff --git a/x.py b/x.py\n--- a/x.py\n+++ b/x.py\n@@ -1 +1 @@\n-a\n+b\n").alias("diff"))
    got = DF.patch_examples(commits, diffs)
    assert "hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 50
