"""Sinks (K1-K4), dataset load (S7), code scan (S5) and streaming."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F

from quarry.operators import sessions as W
from quarry.sources import code as C
from quarry.sources import jsonl as J
from quarry.sources import sinks as K
from quarry.streaming import incremental as ST
from quarry.streaming import seen as SN
from quarry.streaming import sessions as SS

MSG = "array<struct<role:string,content:string>>"


def chat_df(spark, n, tag="x"):
    rows = [([("user", f"{tag} question {i} " + "q" * 80), ("assistant", f"answer {i} ü")],) for i in range(n)]
    return spark.createDataFrame(rows, f"messages {MSG}")


def test_write_chat_and_split_refusal(spark, tmp_path):
    out = str(tmp_path / "o")
    tr, ev = chat_df(spark, 5), chat_df(spark, 2, "e")
    tp, ep = K.write_split(tr, ev, out, name="t1")
    assert spark.read.json(tp).count() == 5 and spark.read.json(ep).count() == 2
    with pytest.raises(FileExistsError):
        K.write_split(tr, ev, out, name="t1")
    K.write_split(tr, ev, out, name="t1", force=True)
    text = "".join(open(os.path.join(tp, f), encoding="utf-8").read()
                   for f in os.listdir(tp) if f.startswith("part"))
    assert "ü" in text                                 # UTF-8 kept unescaped
    K.write_chat(chat_df(spark, 3), str(tmp_path / "app"), mode="append")
    K.write_chat(chat_df(spark, 3), str(tmp_path / "app"), mode="append")
    assert spark.read.json(str(tmp_path / "app")).count() == 6
    trn, evn = J.load_dataset(spark, tp, str(tmp_path / "missing"))
    assert trn.count() == 5 and evn is None


def test_read_examples_and_code(spark, tmp_path):
    p = tmp_path / "ex.jsonl"
    p.write_text("\n".join([json.dumps({"text": "T", "messages": [{"role": "user", "content": "m"}]}),
                            json.dumps({"messages": [{"role": "user", "content": "m"}]}),
                            json.dumps({"other": 1})]) + "\n")
    ex = J.read_examples(spark, str(p)).orderBy("ord").collect()
    assert [r["text"] for r in ex] == ["T", "<|im_start|>user\nm<|im_end|>\n"]
    repo = tmp_path / "repo" / "src"
    repo.mkdir(parents=True)
    (repo / "a.PY").write_bytes(b"x = 1\r\ny = 2\r\n")
    (repo / "b.bin").write_bytes(b"\x00\x01")
    files = C.read_code(spark, str(tmp_path / "repo")).collect()
    assert len(files) == 1 and files[0]["text"] == "x = 1\ny = 2\n"


def test_incremental_export_no_repeats(spark, tmp_path):
    src, out, ck = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "ck")
    src.mkdir()
    line = lambda i: json.dumps({"messages": [{"role": "user", "content": f"q{i} " + "x" * 90},
                                              {"role": "assistant", "content": "a"}]})
    (src / "1.jsonl").write_text("\n".join(line(i) for i in range(5)) + "\n{bad\n")
    ST.incremental(spark, str(src), out, ck)
    assert spark.read.text(out).count() == 5
    (src / "2.jsonl").write_text("\n".join(line(i) for i in range(3, 8)) + "\n")
    ST.incremental(spark, str(src), out, ck)
    rows = spark.read.text(out).collect()
    assert len(rows) == 8 and len({r["value"] for r in rows}) == 8   # 3..4 were seen before


def _turn_rows():
    rows, seq = [], 0
    for s in range(3):
        for i, (role, txt) in enumerate([("user", "question " + "q" * 90), ("user", "more"),
                                         ("assistant", "answer"), ("assistant", "ignored"),
                                         ("user", "again " + "w" * 90), ("assistant", "second"),
                                         ("system", "late")]):
            human = role == "user" and txt != "more"          # "more" is a tool-only row
            ts = f"2024-01-01T00:0{i}:00" if i < 6 else "2024-01-01T01:00:00"
            rows.append((f"s{s}", ts, seq, role,
                         txt if role == "user" else "", txt if role == "assistant" else "",
                         human, txt if human else ""))
            seq += 1
    return rows


TURNS = ("session_id string, ts_raw string, seq long, role string, user_text string, "
         "assistant_text string, has_human boolean, human_text string")


def test_stream_pairs_equals_batch(spark, tmp_path):
    rows = _turn_rows()
    d = tmp_path / "turns"
    spark.createDataFrame(rows, TURNS).write.json(str(d))
    sdf = spark.readStream.schema(TURNS).json(str(d))
    SS.pairs_job(sdf, str(tmp_path / "out"), str(tmp_path / "ck"))
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("session_id", "user", "assistant").collect())
    batch = spark.createDataFrame(rows, TURNS).withColumn("ord", F.col("seq"))
    exp = sorted(tuple(r) for r in W.build_pairs(batch).select("session_id", "user", "assistant").collect())
    assert got == exp and len(got) == 6


def test_stream_follow_closes_windows(spark, tmp_path):
    rows = _turn_rows()
    d = tmp_path / "turns"
    df = spark.createDataFrame(rows, TURNS).withColumn("ts", F.to_timestamp("ts_raw"))
    df.write.json(str(d))
    sdf = spark.readStream.schema(df.schema).json(str(d))
    SS.follow_job(sdf, str(tmp_path / "out"), str(tmp_path / "ck"), follow_k=5, follow_minutes=5, min_user_chars=80,
                  lateness="0 seconds")
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    # the first window is closed by the next human turn, the second by the
    # late row and emitted when the watermark passes its end
    assert sorted(r["n_follow"] for r in got) == [1, 1, 1, 3, 3, 3]


def test_stream_qc_with_horizon(spark, tmp_path):
    d = tmp_path / "chat"
    msgs = [("user", "question " + "q" * 90), ("assistant", "a")]
    other = [("user", "other " + "o" * 90), ("assistant", "b")]
    rows = [(msgs, "2024-01-01 00:00:00"), (msgs, "2024-01-01 00:10:00"), (other, "2024-01-01 00:20:00")]
    df = spark.createDataFrame(rows, f"messages {MSG}, t string").withColumn("ts", F.to_timestamp("t")).drop("t")
    df.write.json(str(d))
    sdf = spark.readStream.schema(df.schema).json(str(d))
    q = (ST.stream_qc(sdf, horizon="1 hour", event_time="ts").select("sig").writeStream
         .format("memory").queryName("qc_t2").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.sql("select * from qc_t2").count() == 2


def test_incremental_pairs_carry_pending_user(spark, tmp_path):
    src, out, ck = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "ck")
    src.mkdir()

    def rec(role, text, minute):
        return json.dumps({"sessionId": "s", "type": role, "timestamp": f"2024-01-01T00:{minute:02d}:00Z",
                           "message": {"role": role, "content": [{"type": "text", "text": text}]}})
    (src / "a.jsonl").write_text("\n".join([rec("user", "q1", 0), rec("assistant", "a1", 1),
                                            rec("user", "q2", 2)]) + "\n")
    ST.incremental_pairs(spark, str(src), out, ck)
    first = [json.loads(r["value"]) for r in spark.read.text(out).collect()]
    assert [p["messages"][1]["content"] for p in first] == ["q1"]
    (src / "b.jsonl").write_text(rec("assistant", "a2", 3) + "\n")
    ST.incremental_pairs(spark, str(src), out, ck)
    allp = sorted(json.loads(r["value"])["messages"][1]["content"] for r in spark.read.text(out).collect())
    assert allp == ["q1", "q2"]          # q2 was pending across runs


def test_export_numbers_its_lines_in_many_tasks(spark):
    from quarry.plans.chatfiles import export_jsonl

    got = export_jsonl(spark, "/root/testdata/sf0.001")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan and not re.search(r"windowspecdefinition\(1, ", plan)
    assert sorted(r.place for r in got.collect()) == list(range(1, got.count() + 1))
