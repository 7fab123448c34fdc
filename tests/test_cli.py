"""Command-line jobs, run in-process on small literal inputs."""

import json

import pytest

from quarry import cli


def _logs(d):
    d.mkdir(parents=True)
    recs = [
        {"sessionId": "s", "type": "user", "timestamp": "2024-01-01T00:00:00Z",
         "message": {"role": "user", "content": [{"type": "text", "text": "how do I fix " + "x" * 90}]}},
        {"sessionId": "s", "type": "assistant", "timestamp": "2024-01-01T00:01:00Z",
         "message": {"role": "assistant", "content": [{"type": "text", "text": "like this"}]}},
    ]
    (d / "a.jsonl").write_text("\n".join(json.dumps(r) for r in recs) + "\n")


def test_pairs_qc_merge_peek(spark, tmp_path, capsys):
    _logs(tmp_path / "logs")
    cli.main(["pairs", "--src", str(tmp_path / "logs"), "--out", str(tmp_path / "pairs")])
    pairs = spark.read.json(str(tmp_path / "pairs")).collect()
    assert len(pairs) == 1 and pairs[0]["messages"][2]["content"] == "like this"

    part = [p for p in (tmp_path / "pairs").iterdir() if p.name.startswith("part") and p.stat().st_size][0]
    cli.main(["qc", "--in", str(part), "--out", str(tmp_path / "clean")])
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["kept"]["n"] == 1

    cli.main(["merge", str(part), str(part), "--out_dir", str(tmp_path / "m"), "--name", "t"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["unique"] == 1 and out["eval"] == 0
    with pytest.raises(FileExistsError):
        cli.main(["merge", str(part), "--out_dir", str(tmp_path / "m"), "--name", "t"])

    cli.main(["peek", "--path", str(part), "--n", "1", "--max_chars", "30"])
    assert "USER" in capsys.readouterr().out


def test_follow_fim_len(spark, tmp_path, capsys):
    _logs(tmp_path / "logs")
    cli.main(["follow", "--src", str(tmp_path / "logs"), "--out", str(tmp_path / "fw"),
              "--follow_minutes", "3", "--cwd_contains", ""])
    fw = spark.read.json(str(tmp_path / "fw")).collect()
    assert len(fw) == 1 and [m["role"] for m in fw[0]["messages"]] == ["system", "user", "assistant"]

    repo = tmp_path / "repo" / "src"
    repo.mkdir(parents=True)
    (repo / "a.ts").write_text("".join(f"export const v{i} = {i};\n" for i in range(200)))
    (repo / "b.bin").write_text("x\n" * 300)
    cli.main(["fim", "--repo", str(tmp_path / "repo"), "--out", str(tmp_path / "fim")])
    fim = spark.read.json(str(tmp_path / "fim")).collect()
    assert 1 <= len(fim) <= 6 and all(r["messages"][1]["content"].startswith("[FILE] ") for r in fim)

    ex = tmp_path / "ex.jsonl"
    ex.write_text(json.dumps({"text": "y" * 100}) + "\n" + json.dumps({"text": "z" * 10}) + "\n")
    cli.main(["len-clip", str(ex), str(tmp_path / "clip"), "10"])
    rep = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert rep == {"kept": 2, "clipped": 1, "dropped": 0}
    cli.main(["len-scan", str(ex)])
    stats = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert stats["n"] == 2 and stats["max"] == 25


def test_pairs_incremental(spark, tmp_path, capsys):
    _logs(tmp_path / "logs")
    args = ["pairs", "--src", str(tmp_path / "logs"), "--out", str(tmp_path / "inc"),
            "--checkpoint", str(tmp_path / "ck")]
    cli.main(args)
    cli.main(args)                      # nothing new: no repeats
    assert spark.read.text(str(tmp_path / "inc")).count() == 1


def test_git_patch_examples(spark, tmp_path):
    diff = "diff --git a/x.py b/x.py\n--- a/x.py\n+++ b/x.py\n@@ -1 +1 @@\n-a = 1\n+a = 2"
    commits = spark.createDataFrame(
        [("r", "s1", ["p"], "fix value\n\nbody", 1, 2, ["main"]),
         ("r", "s2", ["p"], "chore: bump", 1, 2, ["main"])],
        "repo string, sha string, parents array<string>, message string, n_files int, n_lines int, refs array<string>")
    diffs = spark.createDataFrame([("s1", diff), ("s2", diff)], "sha string, diff string")
    commits.write.parquet(str(tmp_path / "c"))
    diffs.write.parquet(str(tmp_path / "d"))
    cli.main(["git", "--commits", str(tmp_path / "c"), "--diffs", str(tmp_path / "d"),
              "--out", str(tmp_path / "g"), "--reason-from-subject"])
    rows = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "g")).collect()]
    assert len(rows) == 1 and rows[0]["assistant"].endswith("Reason: fix value")
    assert rows[0]["messages"][1]["content"].startswith("Commit intent: fix value\nFile: x.py\n<BEFORE>\na = 1")
