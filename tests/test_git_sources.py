"""Paths of diffs, Git logs as text, heads of source files."""

import io
import subprocess

import pytest
from pyspark.sql import functions as F

from quarry.operators import diffs as DF
from quarry.sources import code as C


@pytest.mark.parametrize("written,plain", [
    ("b/x y.py\t", "b/x y.py"), ('"b/na\\303\\257ve.py"', "b/naïve.py"), ('"a\\tb\\\\c\\"d"', 'a\tb\\c"d'), ('"\\344\\270\\255x\\346\\226\\207"', "中x文"),
    ("plain", "plain"), ("", ""), ('"', '"'), ('"\\a\\v\\f\\r\\b"', "\a\v\f\r\b"), ("a\\303b", "a\\303b"), ('"é\\303\\251"', "éé")])
def test_git_path(spark, written, plain):
    assert spark.createDataFrame([(written,)], "p string").select(DF.git_path("p").alias("p")).first().p == plain


def test_paths_of_headers(spark):
    heads = {
        "diff --git a/x b/x\n--- a/x\n+++ b/x": "x", "diff --git a/x b/x\n--- a/x\n+++ /dev/null": "x",
        'diff --git "a/\\303\\244" "b/\\303\\244"\nold mode 100644\nnew mode 100755': "ä", "diff --git a/p b/q b/p b/q\nBinary files differ": "p b/q",
        "diff --git a/o b/n n\nsimilarity index 90%\nrename from o\nrename to n n": "n n", 'diff --git a/o "b/\\303\\244"\nsimilarity index 90%\ncopy from o\ncopy to "\\303\\244"': "ä",
        "diff --cc a b.c\nindex 1,2..3": "a b.c", "diff --combined x.c\n--- a/x.c\n+++ b/x.c": "x.c"}
    df = spark.createDataFrame(list(heads.items()), "h string, want string")
    assert [(r.h, r.p) for r in df.select("h", "want", DF.file_path(F.col("h")).alias("p")).collect() if r.p != r.want] == []


def test_skip_rules_see_plain_paths(spark):
    diff = "diff --git a/x y.lock b/x y.lock\n--- a/x y.lock\t\n+++ b/x y.lock\t\n@@ -1 +1 @@\n-a\n+b\n"
    from quarry.functions import text as T
    got = DF.diff_files(spark.createDataFrame([(diff,)], "diff string")).select("path", T.skip_path("path").alias("skip")).first()
    assert (got.path, got.skip) == ("x y.lock", True)


def test_combined_hunks_have_lines_but_no_text_before(spark):
    diff = "diff --cc f\n--- a/f\n+++ b/f\n@@@ -1,2 -1,2 +1,3 @@@\n  same\n+ one\n -two\n++both\n"
    d = spark.createDataFrame([(diff,)], "diff string")
    assert [(r.kind, r.value) for r in DF.diff_lines(d).where("hunk_no > 0").orderBy("pos").collect()] == [
        ("hunk", None), ("context", "same"), ("added", "one"), ("removed", "two"), ("added", "both")]
    assert DF.before_after(DF.diff_files(d)).count() == 0


def test_head_reads_no_more_than_it_needs():
    class Endless(io.RawIOBase):
        given = 0

        def read(self, n):
            Endless.given += n
            return ("é\r\n" * n).encode()[:n]
    got = C.read_head(Endless(), 1000)
    assert got == ("é\n" * 500) and Endless.given <= 1 << 20


@pytest.mark.parametrize("data", [b"", b"a\r", b"a\r\nb\rc\n", "é".encode() * 9, b"\xff\xfea\xc3", "x�y".encode(), b"\r\n" * 7])
def test_head_equals_a_whole_read(monkeypatch, data):
    whole = data.decode("utf-8", "ignore").replace("\r\n", "\n").replace("\r", "\n")
    for piece in (1, 2, 3, 100):
        monkeypatch.setattr(C, "_PIECE", piece)
        for n in (0, 1, 3, 1000):
            assert C.read_head(io.BytesIO(data), n) == whole[:n]


def test_scan_options(spark, tmp_path):
    for name, data in {"a.py": b"x" * 100, "B.TS": "ü\r\n".encode() * 10, "c.txt": b"no", ".py": b"no", "node_modules/d.py": b"d"}.items():
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True)
        p.write_bytes(data)
    read = lambda **o: {r.path.rpartition("/")[2]: r.text for r in C.read_code(spark, str(tmp_path), **o).collect()}
    assert read() == {"a.py": "x" * 100, "B.TS": "ü\n" * 10, "d.py": "d"}
    assert read(max_chars=7, skip_dirs=True) == {"a.py": "x" * 7, "B.TS": "ü\nü\nü\nü"}
    assert read(max_file_bytes=50) == {"B.TS": "ü\n" * 10, "d.py": "d"}
    assert C.read_code(spark, f"file:{tmp_path}/a.py").count() == 1
    df = C.read_code(spark, str(tmp_path), max_chars=5)
    assert df.select("path").count() == 3


LOG = """commit {a} {b} (HEAD -> main, tag: v1, origin/main)
Author: A U Thor <a@b.c>
Date:   2024-01-02T03:04:05+02:00

    Fix the thing
    
    commit message that names a commit
    diff --git is a word here

diff --git a/x.py b/x.py
--- a/x.py
+++ b/x.py
@@ -1 +1,2 @@
-commit {b}
+commit {a}
+more

commit {b} {c} {d}
Merge: 1234567 89abcde
Author: B <b@b.c>
Date:   2024-01-01T00:00:00Z

    Merge branch

commit {c}
Author: C <c@b.c>
Date:   never

    Root
"""


def test_git_log_as_text(spark, tmp_path):
    ids = {k: k * 40 for k in "abcd"}
    (tmp_path / "log.txt").write_text(LOG.format(**ids))
    for size in ("8m", "97", "40"):  # a commit spans splits and is read once
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = {r.sha: r for r in C.read_git_log(spark, str(tmp_path / "log.txt"), "r").collect()}
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert set(rows) == {ids[k] for k in "abc"}
    a, b, c = (rows[ids[k]] for k in "abc")
    assert (a.parents, a.refs, a.author, a.n_files, a.n_lines, a.repo) == ([ids["b"]], ["main", "origin/main"], "A U Thor <a@b.c>", 1, 3, "r")
    assert a.message == "Fix the thing\n\ncommit message that names a commit\ndiff --git is a word here"
    assert a.diff.startswith("diff --git a/x.py") and a.diff.endswith("+more\n") and a.committed_at.timestamp() == 1704157445
    assert (b.parents, b.refs, b.diff, b.message, b.n_files) == ([ids["c"], ids["d"]], [], None, "Merge branch", 0)
    assert (c.parents, c.committed_at, c.message) == ([], None, "Root")
    table = DF.diff_lines(C.read_git_log(spark, str(tmp_path / "log.txt"), "r").where("diff is not null"))
    assert [r.value for r in table.where("kind = 'added'").orderBy("pos").collect()] == [f"commit {ids['a']}", "more"]


def test_git_log_of_a_real_repository(spark, tmp_path):
    def git(*args):
        return subprocess.run(["git", "-C", str(tmp_path / "r"), "-c", "user.name=n", "-c", "user.email=e@f", *args], check=True, capture_output=True, text=True).stdout
    (tmp_path / "r").mkdir()
    git("init", "-q", "-b", "main")
    for i, name in enumerate(["a b.py", "naïve.py", "c.py"]):
        (tmp_path / "r" / name).write_text(f"one\n{i}\n")
        git("add", "-A")
        git("commit", "-q", "-m", f"Add {name}\n\nWith a body.")
    (tmp_path / "log").write_text(git("log", "-p", "--parents", "--decorate=short", "--date=iso-strict"))
    rows = C.read_git_log(spark, str(tmp_path / "log"), "r")
    shas = git("log", "--format=%H").split()
    got = {r.sha: r for r in rows.collect()}
    assert set(got) == set(shas) and got[shas[0]].refs == ["main"] and got[shas[0]].parents == [shas[1]] and got[shas[2]].parents == []
    assert got[shas[1]].message == "Add naïve.py\n\nWith a body."
    assert {r.path for r in DF.diff_files(rows).collect()} == {"a b.py", "naïve.py", "c.py"}


def test_exported_tables_are_checked(spark, tmp_path):
    spark.createDataFrame([("s", "d")], "sha string, diff string").write.parquet(str(tmp_path / "d"))
    assert C.read_diffs(spark, str(tmp_path / "d")).count() == 1
    with pytest.raises(ValueError, match="parents"):
        C.read_commits(spark, str(tmp_path / "d"))
