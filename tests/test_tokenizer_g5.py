"""Tokenizer UDFs (P15/P16) with a tokenizer trained in the test, the QC
counter hook, and bug -> patch pairs (G5)."""

import pytest

from quarry.functions import tokenizer as TK
from quarry.operators import diffs as DF
from quarry.operators import quality as Q

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def tok_path(tmp_path_factory):
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers
    t = Tokenizer(models.WordLevel(unk_token="[UNK]"))
    t.pre_tokenizer = pre_tokenizers.Whitespace()
    t.train_from_iterator(["hello world foo bar baz user assistant"],
                          trainers.WordLevelTrainer(special_tokens=["[UNK]"]))
    p = str(tmp_path_factory.mktemp("tok") / "tokenizer.json")
    t.save(p)
    return p


def test_count_and_clip(spark, tok_path):
    df = spark.createDataFrame([("hello world foo",), ("bar",), (None,)], "t string")
    n = [r["n"] for r in df.select(TK.token_count(tok_path)("t").alias("n")).collect()]
    assert n == [3, 1, 0]
    c = [r["c"] for r in df.select(TK.token_clip(tok_path, 2)("t").alias("c")).collect()]
    assert c == ["hello world", "bar", ""]


def test_qc_with_tokenizer_counter(spark, tok_path):
    msgs = [("user", "hello " * 30), ("assistant", "world " * 5)]
    df = spark.createDataFrame([(0, msgs, False)], "ord int, messages array<struct<role:string,content:string>>, bad_json boolean")
    out = Q.qc(df, min_user_chars=10, max_tokens=20, counter=TK.messages_counter(tok_path)).collect()[0]
    assert out["drop_reason"] == "too_long" and out["n_tok"] > 20


def test_bug_patch_pairs(spark):
    diff = "diff --git a/x.py b/x.py\n--- a/x.py\n+++ b/x.py\n@@ -1 +1 @@\n-a = 1\n+a = 2"
    d = spark.createDataFrame([("s1", diff, "fix value\n\nlong body")], "sha string, diff string, message string")
    patches = DF.before_after(DF.diff_files(d)).select("sha", "path", "before", "patch_block", "message")
    fails = spark.createDataFrame([("s1", "x.py", "AssertionError: 1 != 2")], "sha string, path string, trace string")
    r = DF.bug_patch_pairs(fails, patches).collect()[0]
    assert r["messages"][1]["content"].startswith("Failure:\nAssertionError: 1 != 2\nFile: x.py\n<BEFORE>\na = 1")
    assert r["messages"][2]["content"].endswith("```\nReason: fix value")
