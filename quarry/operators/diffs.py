"""Commits and unified diffs as DataFrame jobs (S6 consumers, F3-F7, D3,
L5, P18-P20, P22, G1-G6).

A diff is parsed inside its own row: the text is split into file chunks
at ``diff --git`` headers and each file into hunks at ``@@`` headers
(regex look-aheads, so the header stays with its chunk).  Before/after
excerpts are regex passes over each hunk's text; patch blocks are the
raw file chunks.  Line rows (G1) are produced only when asked for, by exploding.
Parsing never shuffles diff text.  The one join that meets it (gated
commits with diffs, on repository and ``sha``) carries no hint: the planner
measures the narrow commit side in bytes and broadcasts it only below its
threshold.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T
from ..session import materialize
from .frames import once
from .ranking import top_n_per_group

FILE_SPLIT = r"\n(?=diff --(?:git|cc|combined) )"
HUNK_SPLIT = r"\n(?=@@)"
_RSTRIP = "(?U)" + K.JAVA_SPACE_CLASS + r"+\z"


def rstrip(c) -> Column:
    """Python ``str.rstrip()``; the regex runs only when the last character
    is whitespace."""
    x = T.col(c)
    return F.when(F.substring(x, -1, 1).rlike("(?U)" + K.JAVA_SPACE_CLASS),
                  F.regexp_replace(x, _RSTRIP, "")).otherwise(x)


# ------------------------------------------------------------- F3 / F4 / F5
def small_commits(df: DataFrame, max_files: int = 20, max_lines: int = 1200) -> DataFrame:
    return df.where((F.col("n_files") <= max_files) & (F.col("n_lines") <= max_lines))


def single_parent(df: DataFrame) -> DataFrame:
    """Non-merge commits that have a first parent (roots and merges out)."""
    return df.where(F.size("parents") == 1)


def intentful_commits(df: DataFrame, message: str = "message") -> DataFrame:
    return df.where(T.intentful(message))


# ------------------------------------------------------------- D3 / L5
def walk_refs(df: DataFrame, branch: str = "main", all_branches: bool = False,
              include_remotes: bool = False, remotes: Sequence[str] = ("origin",)) -> DataFrame:
    """One row per (ref, commit) for the refs the original walk visits:
    the single ``branch``; or every local branch, plus remote branches
    (``<remote>/...``, symbolic ``*/HEAD`` excluded) when asked."""
    e = df.withColumn("ref", F.explode("refs"))
    is_remote = F.lit(False)
    for r in remotes:
        is_remote = is_remote | F.col("ref").startswith(r + "/")
    if not all_branches:
        return e.where(F.col("ref") == F.lit(branch))
    keep = ~is_remote
    if include_remotes:
        keep = keep | (is_remote & ~F.col("ref").endswith("/HEAD"))
    return e.where(keep)


def cap_commits(walked: DataFrame, n: int, newest: str = "committed_at") -> DataFrame:
    """Newest ``n`` non-merge commits per ref (the walk's max_count,
    applied before dedupe and the other gates)."""
    nm = walked.where(F.size("parents") <= 1)
    if newest not in nm.columns:  # exports without times: any n, by sha
        return top_n_per_group(nm, ["repo", "ref"], F.lit(None).cast("timestamp"), n, tiebreak=F.col("sha"), key=["repo", "ref", "sha"])
    return top_n_per_group(nm, ["repo", "ref"], F.col(newest), n, tiebreak=F.col("sha"), descending=True, key=["repo", "ref", "sha"])


def unique_commits(df: DataFrame, max_commits: int | None = None, **walk) -> DataFrame:
    """A commit reachable from several refs counts once (per repo)."""
    w = walk_refs(df, **walk)
    if max_commits is not None:
        w = cap_commits(w, max_commits)
    cols = [c for c in df.columns if c not in ("repo", "sha")]
    return w.groupBy("repo", "sha").agg(*[F.first(c).alias(c) for c in cols])


# ------------------------------------------------------------------- G1
#: Bytes of the one-letter escapes in a quoted path, in hexadecimal.
_ESCAPES = {"a": "07", "b": "08", "t": "09", "n": "0A", "v": "0B", "f": "0C", "r": "0D", '"': "22", "\\": "5C"}


def git_path(c) -> Column:
    """A path as a diff writes it, decoded: the tab that ends names with
    blanks goes, and a quoted name (``"na\303\257ve"``) gives its bytes back,
    octal and one-letter escapes undone, as UTF-8."""
    x = F.regexp_replace(T.col(c), r"\t\z", "")
    inner = F.regexp_extract(x, r'(?s)\A"(.*)"\z', 1)
    simple = F.create_map(*[F.lit(v) for kv in _ESCAPES.items() for v in kv])
    octal = r"\A\\[0-7]{3}\z"
    hexed = F.transform(
        F.regexp_extract_all(inner, F.lit(r"(?s)\\[0-7]{3}|\\.|[^\\]+"), F.lit(0)),
        lambda t: F.when(t.rlike(octal), F.lpad(F.conv(F.substring(t, 2, 3), 8, 16), 2, "0"))
        .when(t.startswith("\\"), F.coalesce(simple[F.substring(t, 2, 1)], F.hex(F.encode(F.substring(t, 2, 1), "UTF-8"))))
        .otherwise(F.hex(F.encode(t, "UTF-8"))))
    return F.when(x.rlike(r'(?s)\A".*"\z'), F.decode(F.unhex(F.array_join(hexed, "")), "UTF-8")).otherwise(x)


def file_path(header) -> Column:
    """Path of a file patch from its header lines: the ``+++`` target without
    ``b/``; the ``---`` source without ``a/`` when the target is
    ``/dev/null``; else the target of a rename or copy; else the ``b/`` side
    of the ``diff --git`` line, or the name of a combined diff."""
    def line(mark):
        return git_path(F.regexp_extract(header, rf"(?dm)^{mark}(.*)$", 1))
    plus, minus, moved = line(r"\+\+\+ "), line("--- "), line("(?:rename|copy) to ")
    combined = line("diff --(?:cc|combined) ")
    # both sides name the same path unless the file moved
    alike = F.regexp_extract(header, r"(?dm)^diff --git a/(.*) b/\1$", 1)
    either = git_path(F.regexp_extract(header, r'(?dm)^diff --git (?:a/.*|"a/.*") ("b/.*"|b/.*)$', 1))
    return (F.when(plus == "/dev/null", F.regexp_replace(minus, "^a/", ""))
            .when(plus != "", F.regexp_replace(plus, "^b/", ""))
            .when(moved != "", moved)
            .when(combined != "", combined)
            .when(alike != "", alike)
            .otherwise(F.regexp_replace(either, "^b/", "")))


def diff_files(diffs: DataFrame, diff: str = "diff") -> DataFrame:
    """One row per file patch: ``file_no``, ``header`` (lines before the
    first hunk), ``hunks`` (array of hunk texts), ``file_text``, ``path``
    (:func:`file_path`), the plain name whatever way the diff writes it."""
    # a final newline ends the last line, it does not begin another one
    body = F.regexp_replace(F.col(diff), r"\n\z", "")
    files = diffs.select("*", F.posexplode(F.split(body, FILE_SPLIT)).alias("file_no", "file_text"))
    files = files.where(F.col("file_text").rlike(r"\Adiff --(?:git|cc|combined) "))
    # one-row Generate: the hunk split runs once per file however often the
    # parts are referenced (projections and pushed-down filters alike)
    files = files.select("*", F.explode(F.array(F.split("file_text", HUNK_SPLIT))).alias("_parts"))
    parts = F.col("_parts")
    files = files.withColumn("header", F.get(parts, 0)).withColumn(
        "hunks", F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))).drop("_parts")
    return once(files, "path", file_path(F.col("header"))).drop(diff)


def diff_lines(diffs: DataFrame, diff: str = "diff") -> DataFrame:
    """G1: line rows ``file_no, path, hunk_no, pos, kind, value`` where kind
    is header / hunk / context / added / removed / marker; ``hunk_no`` is 0
    for file headers; ``value`` is the line without its marker.  Lines of a
    combined hunk (``@@@``) have one marker per parent: added where one is
    ``+``, else removed where one is ``-``."""
    files = diff_files(diffs, diff)
    blocks = F.concat(F.array("header"), F.col("hunks"))
    h = files.select(*[c for c in files.columns if c not in ("header", "hunks", "file_text")],
                     F.posexplode(blocks).alias("hunk_no", "block"))
    ln = h.select(*[c for c in h.columns if c != "block"],
                  "block", F.posexplode(F.split("block", "\n")).alias("pos", "line"))
    ways = F.greatest(F.lit(1), F.length(F.regexp_extract("block", r"\A(@+)", 1)) - 1)
    marks = F.substr("line", F.lit(1), ways)
    first = F.when(ways == 1, marks).when(marks.rlike(r"\A[ +]*\+[ +]*\z"), "+").when(marks.rlike(r"\A[ -]*-[ -]*\z"), "-") \
        .when(marks.rlike(r"\A +\z"), " ").otherwise(F.substring("line", 1, 1))
    kind = (F.when(F.col("hunk_no") == 0, F.lit("header"))
            .when(F.col("pos") == 0, F.lit("hunk"))
            .when(first == " ", F.lit("context"))
            .when(first == "+", F.lit("added"))
            .when(first == "-", F.lit("removed"))
            .when(first == "\\", F.lit("marker"))
            .when(F.col("line") == "", F.lit("context"))
            .otherwise(F.lit("other")))
    value = F.when(kind.isin("context", "added", "removed"), F.substr("line", ways + 1))
    return ln.withColumn("kind", kind).withColumn("value", value).drop("block")


# ------------------------------------------------------------------- G2
def _hunk_side(hunk: Column, keep: str) -> Column:
    """Context plus one side of a hunk, each line without its marker and
    with its newline.  Regex passes over the hunk text (JVM-side): drop the
    header line, drop lines of the other side / markers / anything else,
    then cut the marker character."""
    body = F.when(F.instr(hunk, "\n") > 0, F.concat(F.regexp_replace(hunk, r"\A[^\n]*\n", ""), F.lit("\n")))
    kept = F.regexp_replace(body, r"(?dm)^[^ " + keep + r"\n][^\n]*\n", "")
    return F.coalesce(F.regexp_replace(kept, r"(?dm)^[ \-+]", ""), F.lit(""))


def before_after(files: DataFrame) -> DataFrame:
    """G2 + F7: per-hunk before (context+removed) and after (context+added)
    text, values keep their newline, no-newline markers excluded.  A combined
    hunk (``@@@``) has no single text before and counts as blank.  Hunks where both sides are blank are dropped; files left without hunks, or
    with a blank patch block, are dropped.  Adds ``before``, ``after``,
    ``patch_block`` (G3, the raw file chunk right-stripped)."""
    sides = F.transform(F.filter("hunks", lambda h: ~h.startswith("@@@")), lambda h: F.struct(
        _hunk_side(h, "\\-").alias("b"), _hunk_side(h, "+").alias("a")))
    kept = F.filter(sides, lambda s: ~T.is_blank(s["b"]) | ~T.is_blank(s["a"]))
    # kept hunks and the patch block come out of one-row Generates, so the
    # filters on them do not re-run the hunk regexes below the projection
    out = files.select("*", F.explode(F.array(F.struct(kept.alias("k"), rstrip("file_text").alias("p"))))
                       .alias("_g"))
    out = out.where((F.size("_g.k") > 0) & ~T.is_blank(F.col("_g.p")))
    return out.select(
        *[c for c in files.columns],
        F.array_join(F.transform("_g.k", lambda s: s["b"]), "").alias("before"),
        F.array_join(F.transform("_g.k", lambda s: s["a"]), "").alias("after"),
        F.col("_g.p").alias("patch_block"))


# ------------------------------------------------------------------- G4
def patch_example(df: DataFrame, budget: int = 8000, reason: bool = False,
                  system: str = K.PATCH_SYSTEM_PROMPT) -> DataFrame:
    """user = intent + file + last ``budget`` characters of the
    before text; top-level ``assistant`` = fenced patch block (+ reason)."""
    subj = F.col("subject") if "subject" in df.columns else T.subject("message")
    user = F.concat(F.lit(K.PATCH_INTENT), subj, F.lit(K.PATCH_FILE), F.col("path"),
                    F.lit(K.PATCH_BEFORE), T.last_n("before", budget))
    answer = F.concat(F.lit(K.PATCH_OPEN), F.col("patch_block"), F.lit(K.PATCH_CLOSE))
    if reason:
        answer = F.when(subj != "", F.concat(answer, F.lit(K.PATCH_REASON), subj)).otherwise(answer)

    def m(role, c):
        return F.struct(F.lit(role).alias("role"), c.alias("content"))
    return df.withColumn("messages", F.array(m("system", F.lit(system)), m("user", user))) \
             .withColumn("assistant", answer)


def one_diff_per_sha(diffs: DataFrame) -> DataFrame:
    """``sha, diff`` with one row per sha.  Only shas that repeat take part
    in the choice (the smallest text), so other diffs are not aggregated."""
    d = diffs.select("sha", "diff")
    many = d.groupBy("sha").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("sha")
    return d.join(many, "sha", "left_anti").unionByName(
        d.join(many, "sha", "left_semi").groupBy("sha").agg(F.min("diff").alias("diff")))


def patch_examples(commits: DataFrame, diffs: DataFrame, max_commits: int | None = None,
                   max_files: int = 20, max_lines: int = 1200, before_budget: int = 8000,
                   reason_from_subject: bool = False, **walk) -> DataFrame:
    """Commits -> per-file patch examples.  Ref walk, cap and dedupe,
    then the cheap gates (size, intent, single parent) before the equi-join
    with the diff text on (``repo``,) ``sha``; then path skip, hunk gates, templating."""
    c = commits
    if "refs" in c.columns:
        c = walk_refs(c, **walk)
        if max_commits is not None:
            c = cap_commits(c, max_commits)   # the walk's cap counts every commit
    # the gates depend on the commit alone, so they run before the cross-ref
    # dedupe and only surviving commits are shuffled
    # cheap gates first: combined filters evaluate in this order, so the
    # message regexes only see commits that passed the parent and size tests
    c = intentful_commits(small_commits(single_parent(c), max_files, max_lines))
    # only the subject line is used by the template: carry that, not the
    # whole message, so the commit side stays narrow
    # and store it: the planner then knows its bytes and, below its broadcast
    # threshold, moves no diff text
    c = materialize(c.select("repo", "sha", T.subject("message").alias("subject")).dropDuplicates(["repo", "sha"]), "gated")
    # a fork holds the same sha: diffs that name their repository meet that
    # one alone, others serve every repository with the commit once
    if "repo" in diffs.columns:
        joined = diffs.select("repo", "sha", "diff").join(c, ["repo", "sha"])
    else:
        joined = one_diff_per_sha(diffs).join(c, "sha")
    joined = joined.where(~T.is_blank("diff"))
    files = diff_files(joined).where(~T.skip_path("path"))
    files = before_after(files)
    return patch_example(files, before_budget, reason_from_subject)


# ------------------------------------------------------------------- P22
def fold_assistant(df: DataFrame) -> DataFrame:
    """Append the top-level ``assistant`` to ``messages``."""
    m = F.struct(F.lit("assistant").alias("role"), F.col("assistant").alias("content"))
    return df.withColumn("messages", F.concat("messages", F.array(m)))


# ------------------------------------------------------------------- G5
def bug_patch_pairs(failures: DataFrame, patches: DataFrame,
                    system: str = K.PATCH_SYSTEM_PROMPT) -> DataFrame:
    """Failing-test output + file excerpt -> minimal diff + one-line
    reason.  ``failures([repo,] sha, path, trace)`` joins the rows of
    :func:`patch_examples` (their ``subject`` gives the reason), by
    repository too when both sides name it."""
    drop = [c for c in ("messages", "assistant") if c in patches.columns]
    on = ["sha", "path"] + (["repo"] if "repo" in failures.columns and "repo" in patches.columns else [])
    j = failures.join(patches.drop(*drop), on, "inner")
    user = F.concat(F.lit("Failure:\n"), F.col("trace"), F.lit(K.PATCH_FILE), F.col("path"),
                    F.lit(K.PATCH_BEFORE), F.col("before"))
    subj = F.col("subject") if "subject" in j.columns else T.subject("message")
    answer = F.concat(F.lit(K.PATCH_OPEN), F.col("patch_block"), F.lit(K.PATCH_CLOSE), F.lit(K.PATCH_REASON), subj)

    def m(role, c):
        return F.struct(F.lit(role).alias("role"), c.alias("content"))
    return j.withColumn("messages", F.array(m("system", F.lit(system)), m("user", user), m("assistant", answer)))


# ------------------------------------------------------------------- G6
def diff_metrics(diffs: DataFrame, diff: str = "diff") -> DataFrame:
    """Per row of ``diffs``: diff length, files touched, added and removed
    lines.  All counts come from patterns over the row's own text, so
    repeated shas stay rows of their own, empty diffs count zero and
    nothing is exploded, shuffled or joined.

    Header lines (``+++``, ``---``) stand before the first hunk of a file:
    the text from each file header to its first ``@@`` is taken out before
    lines are counted."""
    text = F.concat(F.lit("\n"), F.coalesce(F.col(diff), F.lit("")))
    # file header up to its first hunk, or whole when the file has none
    bare = F.regexp_replace(text, r"\ndiff --git [^\n]*(?:\n(?!@@|diff --git )[^\n]*+)*+", "\n")
    return diffs.select(
        "*",
        F.regexp_count(text, F.lit(r"\ndiff --git ")).cast("bigint").alias("files_touched"),
        F.regexp_count(bare, F.lit(r"\n\+")).cast("bigint").alias("added"),
        F.regexp_count(bare, F.lit(r"\n-")).cast("bigint").alias("removed"),
        F.coalesce(F.length(diff), F.lit(0)).cast("bigint").alias("diff_chars"),
    ).drop(diff)
