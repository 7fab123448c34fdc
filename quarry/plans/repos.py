"""Two repositories derived from ``documents``, exported as commits and
diffs, written and read back through the Git readers; queries over them and
their SQL twins.

Per document one commit in repository ``alpha``; every fifth also in
``fork`` under the same sha.  The diff has four files: ``src/d<id>.ts`` (a
hunk of the document's lines, some with a carriage return or U+2028 inside,
a blank hunk and a third hunk), a vendored file, a deleted file and a
binary file without hunks.  It ends in a newline; some diffs are empty or
blank.  Every eighth commit has no time, every fourth is a merge.

The SQL twins do not parse diffs: they state what the construction must
give, from the document's lines.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T
from ..operators import diffs as DF
from ..operators import harvest as H
from ..operators import stats as ST
from ..session import ensure_checkpoint_dir
from ..sources import code as C
from . import oracle as O
from .queries import query, transcript_md5
from .standins import table

CAP = 1500


def exported(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(commits, diffs) as the Git readers return them; written once per
    session and table folder below the shared checkpoint folder."""
    base = f"{ensure_checkpoint_dir(spark)}/repos-{hashlib.md5(sf_dir.encode()).hexdigest()}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/diffs/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        both = _build(spark, sf_dir)
        both.drop("diff").write.mode("overwrite").parquet(f"{base}/commits")
        both.select("repo", "sha", "doc_id", "diff").write.mode("overwrite").parquet(f"{base}/diffs")
    return C.read_commits(spark, f"{base}/commits"), C.read_diffs(spark, f"{base}/diffs")


def _build(spark: SparkSession, sf_dir: str) -> DataFrame:
    ident = F.col("doc_id").cast("string")
    lines = F.transform(F.split(T.lf(F.col("text")), "\n"), lambda x, i: F.concat(
        x, F.when(i % 7 == 6, F.lit("\rq")).otherwise(F.lit("")), F.when(i % 11 == 10, F.lit(" tail")).otherwise(F.lit(""))))
    marked = F.transform(lines, lambda x, i: F.concat(
        F.when(i % 5 == 1, F.lit("-")).when(i % 5 == 3, F.lit("+")).otherwise(F.lit(" ")), x))

    def head(path, old="--- a/", new="+++ b/"):
        return F.concat(F.lit("diff --git a/"), path, F.lit(" b/"), path, F.lit("\n" + old), path, F.lit("\n" + new),
                        path if new == "+++ b/" else F.lit(""), F.lit("\n"))
    src = F.concat(F.lit("src/d"), ident, F.lit(".ts"))
    old = F.concat(F.lit("old/"), ident, F.lit(".py"))
    vendored = F.concat(F.lit("node_modules/m"), ident, F.lit(".js"))
    image = F.concat(F.lit("img/"), ident, F.lit(".dat"))
    diff = F.concat(
        head(src), F.lit("@@ -1 +1 @@\n"), F.array_join(marked, "\n"), F.lit("\n"),
        F.when(F.col("doc_id") % 2 == 0, F.lit("\\ No newline at end of file\n")).otherwise(F.lit("")),
        F.lit("@@ -90 +90 @@ place\n \n+\n-  \n"),
        F.lit("@@ -100,2 +100,2 @@\n-old "), ident, F.lit("\n+new "), ident, F.lit("\n keep\n"),
        head(vendored), F.lit("@@ -1 +1 @@\n-a\n+b\n"),
        head(old, new="+++ /dev/null"), F.lit("@@ -1 +0,0 @@\n-gone "), ident, F.lit("\n"),
        F.lit("diff --git a/"), image, F.lit(" b/"), image, F.lit("\nBinary files differ\n"))
    diff = F.when(F.col("doc_id") % 9 == 4, F.lit("")).when(F.col("doc_id") % 9 == 5, F.lit("  \n")).otherwise(diff)
    sha = F.md5(ident)
    parent = F.md5((F.col("doc_id") - 1).cast("string"))
    parents = (F.when(F.col("doc_id") == 0, F.array().cast("array<string>"))
               .when(F.col("doc_id") % 4 == 3, F.array(parent, sha)).otherwise(F.array(parent)))
    repos = F.when(F.col("doc_id") % 5 == 0, F.array(F.lit("alpha"), F.lit("fork"))).otherwise(F.array(F.lit("alpha")))
    at = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=F.col("doc_id") % 50)
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(repos).alias("repo"), sha.alias("sha"), parents.alias("parents"), F.col("text").alias("message"),
        F.lit(4).alias("n_files"), F.lit(10).alias("n_lines"),
        F.array(F.lit("main"), F.lit("next"), F.lit("origin/HEAD")).alias("refs"),
        F.when(F.col("doc_id") % 8 != 7, at).alias("committed_at"), diff.alias("diff"))


@query("repo_line_kinds")
def repo_line_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 + S6 on diffs of several files and hunks."""
    d = exported(spark, sf_dir)[1].where("repo = 'alpha'")
    return DF.diff_lines(d).groupBy("doc_id", "path", "kind").agg(
        F.count("*").alias("n"), F.sum(F.coalesce(F.length("value"), F.lit(0))).alias("chars"))


@query("repo_before_after")
def repo_before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2 + G3 + F6 + F7: texts of the files that have hunks, with the
    path gate's answer."""
    d = exported(spark, sf_dir)[1].where("repo = 'alpha'")
    f = DF.before_after(DF.diff_files(d))
    return f.select("doc_id", "path", T.skip_path("path").alias("skip"), F.md5("before").alias("before_md5"),
                    F.md5("after").alias("after_md5"), F.md5("patch_block").alias("block_md5"))


def _patches(spark, sf_dir, named: bool):
    commits, diffs = exported(spark, sf_dir)
    return DF.patch_examples(commits, diffs if named else diffs.drop("repo"), reason_from_subject=True)


@query("repo_patch_examples")
def repo_patch_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4 over two repositories that share commits; diffs name theirs."""
    p = _patches(spark, sf_dir, True)
    return p.select("repo", "sha", "path", transcript_md5().alias("msg_md5"), F.md5("assistant").alias("assistant_md5"))


@query("repo_patch_by_sha")
def repo_patch_by_sha(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4 with diffs known by sha alone: the same examples, once each."""
    p = _patches(spark, sf_dir, False)
    return p.select("repo", "sha", "path", transcript_md5().alias("msg_md5"), F.md5("assistant").alias("assistant_md5"))


@query("bug_patch_pairs")
def bug_patch_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5 on the output of G4: a failure per commit and source file."""
    patches = _patches(spark, sf_dir, True)
    failures = exported(spark, sf_dir)[0].select(
        "repo", "sha", F.concat(F.lit("src/d"), F.col("doc_id").cast("string"), F.lit(".ts")).alias("path"),
        F.concat(F.lit("Trace "), F.col("sha")).alias("trace"))
    return DF.bug_patch_pairs(failures, patches).select("repo", "sha", "path", transcript_md5().alias("msg_md5"))


@query("repo_diff_metrics")
def repo_diff_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G6 per exported row: forked shas and empty diffs keep their own."""
    d = exported(spark, sf_dir)[1]
    return DF.diff_metrics(d).select("repo", "doc_id", "files_touched", "added", "removed", "diff_chars")


@query("commit_cap_large")
def commit_cap_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L5 with more rows asked for than any group limit, equal and missing
    times: null times last, ties by sha."""
    commits = exported(spark, sf_dir)[0]
    walked = DF.walk_refs(commits.unionByName(commits.withColumns({
        "sha": F.concat(F.col("sha"), F.lit("x")), "doc_id": F.col("doc_id") + 1_000_000})), all_branches=True)
    return DF.cap_commits(walked, CAP).select("repo", "ref", "sha")


@query("lang_balance_large")
def lang_balance_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 with a cap over 1,000 on doubled rows; a null language is a group."""
    d = table(spark, sf_dir, "documents").select(
        F.explode(F.array("doc_id", F.col("doc_id") + 1_000_000, F.col("doc_id") + 2_000_000)).alias("doc_id"),
        F.nullif("lang", F.lit("de")).alias("lang"))
    return ST.balance(d, "lang", 1200, "doc_id", seed=42)


# path, header lines, and (kind, lines, characters) of its hunk lines; # stands for the document
ODD_FILES = [
    ("x y#.py", "diff --git a/x y#.py b/x y#.py\n--- a/x y#.py\t\n+++ b/x y#.py\t", "@@ -1 +1 @@\n-a\n+b", [("hunk", 1, 0), ("removed", 1, 1), ("added", 1, 1)]),
    ("naïve#.py", 'diff --git "a/na\\303\\257ve#.py" "b/na\\303\\257ve#.py"\n--- "a/na\\303\\257ve#.py"\n+++ "b/na\\303\\257ve#.py"', "@@ -1 +1,2 @@\n same\n+more",
     [("hunk", 1, 0), ("context", 1, 4), ("added", 1, 4)]),
    ('q"\\\t#.md', 'diff --git "a/q\\"\\\\\\t#.md" "b/q\\"\\\\\\t#.md"\nnew file mode 100644\n--- /dev/null\n+++ "b/q\\"\\\\\\t#.md"', "@@ -0,0 +1 @@\n+one",
     [("hunk", 1, 0), ("added", 1, 3)]),
    ("new name#", "diff --git a/old b/new name#\nsimilarity index 100%\nrename from old\nrename to new name#", "", []),
    ("m b/x#", "diff --git a/m b/x# b/m b/x#\nold mode 100644\nnew mode 100755", "", []),
    ("中#", 'diff --git "a/\\344\\270\\255#" "b/\\344\\270\\255#"\nBinary files differ', "", []),
    ("src/c#.ts", "diff --cc src/c#.ts\nindex 1,2..3\n--- a/src/c#.ts\n+++ b/src/c#.ts", "@@@ -1,2 -1,2 +1,3 @@@\n  same\n+ one\n +two\n- gone\n++both",
     [("hunk", 1, 0), ("context", 1, 4), ("added", 3, 10), ("removed", 1, 4)]),
]


@query("repo_paths")
def repo_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 on names with blanks, quotes, tabs and other scripts, on renames,
    mode changes, binary files and combined diffs."""
    text = "\n".join(head + ("\n" + hunk if hunk else "") for _, head, hunk, _ in ODD_FILES) + "\n"
    d = table(spark, sf_dir, "documents").select("doc_id", F.replace(F.lit(text), F.lit("#"), F.col("doc_id").cast("string")).alias("diff"))
    return DF.diff_lines(d).groupBy("doc_id", "path", "kind").agg(
        F.count("*").alias("n"), F.sum(F.coalesce(F.length("value"), F.lit(0))).alias("chars"))


@query("git_log_patches")
def git_log_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 -> G4 from the text of a Git log: the same examples as from the
    exported tables."""
    base = f"{ensure_checkpoint_dir(spark)}/gitlog-{uuid.uuid4().hex}"
    d = _build(spark, sf_dir).where("repo = 'alpha'")
    message = F.regexp_replace(F.regexp_replace(F.concat(F.lit("\n"), "message"), "\n", "\n    "), r"\A\n", "")
    bare = F.coalesce(F.length(F.trim(F.regexp_replace("diff", "\n", ""))), F.lit(0)) == 0
    d.select(F.concat(
        F.lit("commit "), F.concat_ws(" ", F.array("sha"), "parents"), F.lit(" (HEAD -> main, next, origin/HEAD)\nAuthor: A <a@b.c>\nDate:   "),
        F.lit("2024-01-01T00:00:00+00:00\n\n"), message, F.lit("\n"),
        F.when(bare, F.lit("")).otherwise(F.concat(F.lit("\n"), F.col("diff"))))).write.text(base)
    log = C.read_git_log(spark, base, "alpha")
    p = DF.patch_examples(log.drop("diff"), log.select("repo", "sha", "diff").where("diff is not null"), max_lines=10**9, reason_from_subject=True)
    return p.select("repo", "sha", "path", transcript_md5().alias("msg_md5"), F.md5("assistant").alias("assistant_md5"))


SCAN_CHARS, SCAN_DOCS, SCAN_COPIES = 30_000, 200, 40


@query("source_scan")
def source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 over files written from ``documents``, ``SCAN_DOCS`` texts each,
    the first file forty times as large: the first characters of each."""
    base = f"{ensure_checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    file = F.floor(F.col("doc_id") / SCAN_DOCS).cast("bigint").alias("file")
    copy = F.explode(F.sequence(F.lit(1), F.when(F.col("doc_id") < SCAN_DOCS, SCAN_COPIES).otherwise(1)))
    rows = table(spark, sf_dir, "documents").select(file, copy.alias("copy"), "doc_id", F.col("text").alias("value"))
    rows.repartition(n, "file").sortWithinPartitions("file", "copy", "doc_id").drop("copy", "doc_id").write.partitionBy("file").text(base)
    found = C.read_code(spark, base, exts=(".txt",), max_chars=SCAN_CHARS)
    return found.select(F.regexp_extract("path", "/file=([0-9]+)/", 1).cast("bigint").alias("file"), F.md5("text").alias("text_md5"),
                        F.length("text").cast("bigint").alias("n_chars"))


def _files(spark, sf_dir):
    """Source files of both repositories."""
    d = table(spark, sf_dir, "documents")
    repos = F.when(F.col("doc_id") % 5 == 0, F.array(F.lit("alpha"), F.lit("fork"))).otherwise(F.array(F.lit("alpha")))
    return d.select(F.explode(repos).alias("repo"), F.col("doc_id").cast("string").alias("path"), "text")


@query("repo_fim_spans")
def repo_fim_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6 + D4 across repositories: seeds 42 and 43, shared dedupe."""
    return H.repo_spans(_files(spark, sf_dir), ["alpha", "fork"]).select("repo", "path", "sample_no")


@query("harvest")
def harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 as one job: both repositories' patch and FIM examples are written,
    and the report counts what was written."""
    commits, diffs = exported(spark, sf_dir)
    out = f"{ensure_checkpoint_dir(spark)}/harvest-{uuid.uuid4().hex}"
    return H.harvest(commits, diffs, _files(spark, sf_dir), ["alpha", "fork"], f"{out}/sft", f"{out}/fim")


# ------------------------------------------------------------------ SQL twins
NL = "chr(10)"


def _side(n: int) -> str:
    return ("array_to_string(list_transform(lines, lambda x, i: CASE WHEN (i - 1) % 5 = " + str(n)
            + f" THEN '' ELSE x || {NL} END), '')")


REPO = f"""l AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS id, text, doc_id % 9 IN (4, 5) AS bare,
    list_transform(string_split(regexp_replace(text, '\\r\\n?', {NL}, 'g'), {NL}), lambda x, i: x
      || CASE WHEN (i - 1) % 7 = 6 THEN chr(13) || 'q' ELSE '' END || CASE WHEN (i - 1) % 11 = 10 THEN chr(8232) || 'tail' ELSE '' END) AS lines
  FROM documents
), h AS (
  SELECT *, {_side(3)} AS b1, {_side(1)} AS a1,
    array_to_string(list_transform(lines, lambda x, i: CASE WHEN (i - 1) % 5 = 1 THEN '-' WHEN (i - 1) % 5 = 3 THEN '+' ELSE ' ' END || x), {NL}) AS body,
    len(list_filter(range(len(lines)), lambda j: j % 5 = 1)) AS n1, len(list_filter(range(len(lines)), lambda j: j % 5 = 3)) AS n3
  FROM l
), src AS (
  SELECT *, 'src/d' || id || '.ts' AS path,
    coalesce({O.strip('b1')}, '') = '' AND coalesce({O.strip('a1')}, '') = '' AS blank1,
    'diff --git a/src/d' || id || '.ts b/src/d' || id || '.ts' || {NL} || '--- a/src/d' || id || '.ts' || {NL} || '+++ b/src/d' || id || '.ts' || {NL}
      || '@@ -1 +1 @@' || {NL} || body || {NL} || CASE WHEN doc_id % 2 = 0 THEN '\\ No newline at end of file' || {NL} ELSE '' END
      || '@@ -90 +90 @@ place' || {NL} || ' ' || {NL} || '+' || {NL} || '-  ' || {NL}
      || '@@ -100,2 +100,2 @@' || {NL} || '-old ' || id || {NL} || '+new ' || id || {NL} || ' keep' AS block
  FROM h WHERE NOT bare
), vendored AS (
  SELECT *, 'node_modules/m' || id || '.js' AS vpath FROM src
), f AS (
  SELECT doc_id, id, text, path, false AS skip, CASE WHEN blank1 THEN '' ELSE b1 END || 'old ' || id || {NL} || 'keep' || {NL} AS before,
    CASE WHEN blank1 THEN '' ELSE a1 END || 'new ' || id || {NL} || 'keep' || {NL} AS after, block FROM src
  UNION ALL
  SELECT doc_id, id, text, 'old/' || id || '.py', false, 'gone ' || id || {NL}, '',
    'diff --git a/old/' || id || '.py b/old/' || id || '.py' || {NL} || '--- a/old/' || id || '.py' || {NL} || '+++ /dev/null' || {NL}
      || '@@ -1 +0,0 @@' || {NL} || '-gone ' || id FROM src
  UNION ALL
  SELECT doc_id, id, text, vpath, true, 'a' || {NL}, 'b' || {NL},
    'diff --git a/' || vpath || ' b/' || vpath || {NL} || '--- a/' || vpath || {NL} || '+++ b/' || vpath || {NL}
      || '@@ -1 +1 @@' || {NL} || '-a' || {NL} || '+b' FROM vendored
), repos AS (
  SELECT doc_id, 'alpha' AS repo FROM documents UNION ALL SELECT doc_id, 'fork' FROM documents WHERE doc_id % 5 = 0
), pe AS (
  SELECT repo, doc_id, md5(id) AS sha, path, before, block, {O.SUBJ} AS subject FROM f JOIN repos USING (doc_id)
  WHERE NOT skip AND {O.INTENTFUL} AND doc_id <> 0 AND doc_id % 4 <> 3
)"""

SQL = O.SQL
SQL["repo_line_kinds"] = f"""WITH {REPO}, k AS (
  SELECT doc_id, path, 'header' AS kind, 3 AS n, 0 AS chars FROM src
  UNION ALL SELECT doc_id, path, 'hunk', 3, 0 FROM src
  UNION ALL SELECT doc_id, path, 'marker', 1, 0 FROM src WHERE doc_id % 2 = 0
  UNION ALL SELECT doc_id, path, 'context', len(lines) - n1 - n3 + 2,
    length(body) - (len(lines) - 1) - len(lines) - length(array_to_string(list_transform(lines, lambda x, i: CASE WHEN (i - 1) % 5 IN (1, 3) THEN x ELSE '' END), '')) + 4 FROM src
  UNION ALL SELECT doc_id, path, 'removed', n1 + 2, length(array_to_string(list_transform(lines, lambda x, i: CASE WHEN (i - 1) % 5 = 1 THEN x ELSE '' END), '')) + 2 + 4 + length(id) FROM src
  UNION ALL SELECT doc_id, path, 'added', n3 + 2, length(array_to_string(list_transform(lines, lambda x, i: CASE WHEN (i - 1) % 5 = 3 THEN x ELSE '' END), '')) + 4 + length(id) FROM src
  UNION ALL SELECT doc_id, vpath, unnest(['header', 'hunk', 'removed', 'added']), unnest([3, 1, 1, 1]), unnest([0, 0, 1, 1]) FROM vendored
  UNION ALL SELECT doc_id, 'old/' || id || '.py', unnest(['header', 'hunk', 'removed']), unnest([3, 1, 1]), unnest([0, 0, 5 + length(id)]) FROM src
  UNION ALL SELECT doc_id, 'img/' || id || '.dat', 'header', 2, 0 FROM src
) SELECT doc_id, path, kind, CAST(n AS BIGINT) AS n, CAST(chars AS BIGINT) AS chars FROM k"""

SQL["repo_before_after"] = f"""WITH {REPO}
SELECT doc_id, path, skip, md5(before) AS before_md5, md5(after) AS after_md5, md5(block) AS block_md5 FROM f"""

_USER = (f"'{K.PATCH_INTENT}' || subject || {NL} || 'File: ' || path || {NL} || '<BEFORE>' || {NL} || "
         "CASE WHEN length(before) <= 8000 THEN before ELSE right(before, 8000) END")
_ANSWER = (f"'```diff' || {NL} || block || {NL} || '```' || CASE WHEN subject <> '' THEN {NL} || 'Reason: ' || subject ELSE '' END")
SQL["repo_patch_examples"] = SQL["repo_patch_by_sha"] = f"""WITH {REPO}
SELECT repo, sha, path, md5('system:{O.PATCH_SYS}' || {NL} || 'user:' || {_USER}) AS msg_md5, md5({_ANSWER}) AS assistant_md5 FROM pe"""

SQL["bug_patch_pairs"] = f"""WITH {REPO}
SELECT repo, sha, path, md5('system:{O.PATCH_SYS}' || {NL} || 'user:Failure:' || {NL} || 'Trace ' || sha || {NL} || 'File: ' || path || {NL}
    || '<BEFORE>' || {NL} || before || {NL} || 'assistant:```diff' || {NL} || block || {NL} || '```' || {NL} || 'Reason: ' || subject) AS msg_md5
FROM pe WHERE path LIKE 'src/%'"""

SQL["repo_diff_metrics"] = f"""WITH {REPO}
SELECT repo, r.doc_id, CAST(CASE WHEN bare THEN 0 ELSE 4 END AS BIGINT) AS files_touched,
  CAST(CASE WHEN bare THEN 0 ELSE n3 + 3 END AS BIGINT) AS added, CAST(CASE WHEN bare THEN 0 ELSE n1 + 4 END AS BIGINT) AS removed,
  CAST(CASE WHEN r.doc_id % 9 = 4 THEN 0 WHEN r.doc_id % 9 = 5 THEN 3 ELSE
    (SELECT sum(length(block) + 1) FROM f WHERE f.doc_id = r.doc_id) + length('diff --git a/img/.dat b/img/.dat') + 2 * length(id) + 1 + length('Binary files differ') + 1 END AS BIGINT) AS diff_chars
FROM h JOIN repos r ON h.doc_id = r.doc_id"""

SQL["commit_cap_large"] = f"""WITH c AS (
  SELECT repo, doc_id, md5(CAST(doc_id AS VARCHAR)) || x AS sha, CASE WHEN doc_id % 8 <> 7 THEN doc_id % 50 END AS made
  FROM (SELECT doc_id, 'alpha' AS repo FROM documents UNION ALL SELECT doc_id, 'fork' FROM documents WHERE doc_id % 5 = 0) r,
       (SELECT unnest(['', 'x']) AS x) y
  WHERE doc_id % 4 <> 3 OR doc_id = 0
), n AS (
  SELECT repo, ref, sha, row_number() OVER (PARTITION BY repo, ref ORDER BY made DESC NULLS LAST, sha) AS rn
  FROM c, (SELECT unnest(['main', 'next', 'origin/HEAD']) AS ref) z WHERE ref <> 'origin/HEAD'
)
SELECT repo, ref, sha FROM n WHERE rn <= {CAP}"""

SQL["lang_balance_large"] = """WITH d AS (
  SELECT doc_id + x AS doc_id, nullif(lang, 'de') AS lang FROM documents, (SELECT unnest([0, 1000000, 2000000]) AS x) y
), n AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn FROM d)
SELECT doc_id, lang FROM n WHERE rn <= 1200"""

FIM_REPOS = (O.FIM.replace("SELECT CAST(doc_id AS VARCHAR) AS path", "SELECT repo, seed, CAST(doc_id AS VARCHAR) AS path")
             .replace("FROM documents\n", "FROM (SELECT *, 'alpha' AS repo, '42:' AS seed FROM documents UNION ALL "
                      "SELECT *, 'fork', '43:' FROM documents WHERE doc_id % 5 = 0) rr\n")
             .replace("md5('42:' || path", "md5(seed || path").replace("SELECT path, code,", "SELECT repo, seed, path, code,")
             .replace("SELECT path, sample_no,", "SELECT repo, path, sample_no,")
             .replace("ORDER BY path, sample_no) AS rn", "ORDER BY repo, path, sample_no) AS rn"))
SQL["repo_fim_spans"] = f"WITH {FIM_REPOS} SELECT repo, path, sample_no FROM spans_u"
SQL["harvest"] = f"""WITH {REPO}, {FIM_REPOS}
SELECT kind, repo, count(*) AS n FROM (SELECT 'patch' AS kind, repo FROM pe UNION ALL SELECT 'fim', repo FROM spans_u) u GROUP BY kind, repo"""


def _literal(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


O.SQL["repo_paths"] = "SELECT doc_id, replace(path, '#', CAST(doc_id AS VARCHAR)) AS path, kind, n, chars FROM documents, (VALUES " + ", ".join(
    f"({_literal(path)}, '{kind}', CAST({n} AS BIGINT), CAST({chars} AS BIGINT))" for path, head, _, kinds in ODD_FILES
    for kind, n, chars in [("header", head.count("\n") + 1, 0), *kinds]) + ") AS f(path, kind, n, chars)"
O.SQL["git_log_patches"] = f"SELECT * FROM ({O.SQL['repo_patch_examples']}) x WHERE repo = 'alpha'"
O.SQL["source_scan"] = f"""SELECT file, md5(t) AS text_md5, CAST(length(t) AS BIGINT) AS n_chars FROM (
  SELECT file, substr(regexp_replace(string_agg(text || {NL}, '' ORDER BY copy, doc_id), '\r\n?', {NL}, 'g'), 1, {SCAN_CHARS}) AS t FROM (
    SELECT doc_id // {SCAN_DOCS} AS file, doc_id, text, unnest(range(CASE WHEN doc_id < {SCAN_DOCS} THEN {SCAN_COPIES} ELSE 1 END)) AS copy FROM documents) d GROUP BY file) x"""
