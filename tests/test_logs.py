"""Raw-log reading (S1-S3) and the VARIANT normaliser (P2-P7, W4) on
literal inputs."""

import json

from pyspark.sql import functions as F

from quarry.operators import segments as SG
from quarry.sources import jsonl as J

CUT = "\n[...truncated tool output...]"
# content of a message -> (user text, assistant text, has a human part); tool results are cut at 40 characters
CASES = [
    ("  padded  ", "padded", "padded", True),
    ("[not json", "[not json", "[not json", True),
    ("line\nbreak\n", "line\nbreak", "line\nbreak", True),
    (None, "", "", False),
    ([], "", "", False),
    ([""], "", "", True),
    (["a", " b "], "a\n b", "a\n b", True),
    ([{"type": "text", "text": "hi"}], "hi", "hi", True),
    ([{"type": "text", "text": " hi ", "content": "no"}], "hi", "hi", True),
    ([{"type": "text", "text": "", "content": "from content"}], "from content", "from content", True),
    ([{"type": "text", "text": None, "content": "c"}], "c", "c", True),
    ([{"type": "text", "text": 0, "content": "c"}], "c", "c", True),
    ([{"type": "text", "text": ["a"], "content": "c"}], "", "", False),
    ([{"type": "text", "text": " "}], "", "", False),
    ([{"type": "input_text", "text": "in"}, {"type": "message", "content": "msg"}], "in\nmsg", "", True),
    ([{"type": "image", "text": "alt"}], "", "", False),
    ([{"type": "tool_result", "content": "out"}], "[TOOL RESULT]\nout", "", False),
    ([{"type": "tool_result", "content": "  "}], "", "", False),
    ([{"type": "tool_result", "content": ["arr"]}], "", "", False),
    ([{"type": "tool_result", "content": "t" * 60}], "[TOOL RESULT]\n" + "t" * 25 + CUT, "", False),
    ([{"type": "text", "text": "q"}, {"type": "tool_result", "content": "r"}], "q\n\n[TOOL RESULT]\nr", "q", True),
    ([7, {"type": "text"}, {"text": "untyped"}, "s"], "s", "s", True),
]


def test_normaliser_on_literal_contents(spark):
    recs, expect = [], []
    for content, user, assistant, human in CASES:
        for role in ("user", "assistant", "system"):
            i = len(recs)
            recs.append((i, json.dumps({"sessionId": "a", "type": role, "message": {"role": role, "content": content}})))
            expect.append((i, user if role == "user" else "", assistant if role == "assistant" else "", human and role == "user"))
    lines = spark.createDataFrame(recs, "ord long, value string")
    turns = SG.normalise(J.parse_records(lines), max_tool_chars=40, tool_fallback=False)
    got = sorted((r["ord"], r["user_text"], r["assistant_text"], r["has_human"]) for r in turns.collect())
    assert got == expect


def test_session_keys_and_fallback(spark):
    recs = [
        {"sessionId": "s1", "type": "user", "message": {"role": "user", "content": []},
         "toolUseResult": {"file": {"content": "FILE"}}},
        {"session_id": "s2", "type": "user", "message": {"content": ""},
         "toolUseResult": {"text": "  "}},
        {"sessionId": "", "session_id": "", "type": "user", "message": {"role": "", "content": []},
         "toolUseResult": {"file": {"content": " "}, "text": "T"}},
        {"type": "assistant", "message": "not an object"},
    ]
    lines = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(recs)], "ord long, value string")
    t = SG.normalise(J.parse_records(lines), tool_fallback=True).orderBy("ord").collect()
    assert [r["session_id"] for r in t] == ["s1", "s2", "default", "default"]
    assert [r["role"] for r in t] == ["user", "user", "user", "assistant"]
    assert t[0]["user_text"] == "[TOOL RESULT]\nFILE"
    assert t[1]["user_text"] == "[TOOL RESULT]\n  "   # blank text still counts
    assert t[2]["user_text"] == ""                    # file object wins, blank -> nothing
    assert t[3]["assistant_text"] == ""


def test_strict_json_edge_lines(spark, tmp_path):
    d = tmp_path / "logs" / "sub"
    d.mkdir(parents=True)
    lines = ["", "{bad", "[1]", "3", "null", '{"a":1} trailing', '{"messages":null}',
             '{"messages":[]}', '{"messages":[{"role":"user","content":null}]}']
    (d / "A.JSONL").write_text("\n".join(lines) + "\n")
    (d / "skip.txt").write_text('{"a": 1}\n')
    logs = J.read_logs(spark, str(tmp_path / "logs"), keep_bad=True)
    rows = logs.collect()
    assert len(rows) == 8                     # blank line dropped, .txt not read
    assert sum(r["bad_json"] for r in rows) == 5
    chat = J.read_chat(spark, str(d / "A.JSONL"))
    good = chat.where(~F.col("bad_json")).collect()
    assert sorted(len(r["messages"]) for r in good) == [0, 0, 1]


def test_read_chat_many_and_order(spark, tmp_path):
    a, b = tmp_path / "a.jsonl", tmp_path / "b.jsonl"
    m = {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}
    a.write_text(json.dumps(m) + "\n{bad\n" + json.dumps({"messages": []}) + "\n")
    b.write_text(json.dumps(m) + "\n")
    df = J.read_chat_many(spark, [str(a), str(b)])
    rows = df.orderBy("ord").collect()
    assert [r["src"] for r in rows] == [0, 1]
