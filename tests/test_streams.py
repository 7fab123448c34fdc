"""Pairs, follow windows and the seen table over several runs."""

import json
import random

from pyspark.sql import functions as F

from quarry.operators import sessions as W
from quarry.streaming import incremental as ST
from quarry.streaming import seen as SN
from quarry.streaming import sessions as SS

TURNS = ("session_id string, ts_raw string, ts timestamp, seq long, role string, user_text string, assistant_text string, "
         "has_human boolean, human_text string")


def turns(spark, n=160, seed=1, sessions=("hot", "hot", "hot", "x", None)):
    rng, rows = random.Random(seed), []
    for i in range(n):
        role = rng.choice(["user", "user", "assistant", "system"])
        human = role == "user" and rng.random() < 0.4
        text = f"t{i}" if rng.random() < 0.9 else ""
        rows.append((rng.choice(sessions), f"2024-01-01T{i // 60:02d}:{i % 60:02d}:00", i, role, text if role == "user" else "",
                     text if role == "assistant" else "", human, text * 3 if human else ""))
    df = spark.createDataFrame(rows, "session_id string, ts_raw string, seq long, role string, user_text string, assistant_text string, has_human boolean, human_text string")
    return df.withColumn("ts", F.to_timestamp("ts_raw")).select(*[c.split()[0] for c in TURNS.split(", ")])


def stream(spark, df, path, files=2):
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", str(files)).parquet(path)


def pairs_of(df):
    return sorted((r.session_id or "", r.user, r.assistant) for r in df.collect())


def test_pairs_over_many_batches_equal_the_batch_form(spark, tmp_path):
    df = turns(spark)
    want = pairs_of(W.build_pairs(df.withColumn("ord", F.col("seq"))))
    base = str(tmp_path)
    for part in range(3):  # one file each, in order: a batch ends within islands
        df.where(F.floor(F.col("seq") / 54) == part).coalesce(1).write.mode("append").parquet(f"{base}/in")
        SS.pairs_job(stream(spark, df, f"{base}/in", 1), f"{base}/out", f"{base}/state", hot_rows=10)
    assert pairs_of(spark.read.parquet(f"{base}/out")) == want and len(want) > 20


def test_pending_text_is_forgotten_after_its_time(spark, tmp_path):
    import time

    df = turns(spark, 3)
    ask = df.limit(1).withColumns({"session_id": F.lit("s"), "role": F.lit("user"), "user_text": F.lit("q"), "assistant_text": F.lit("")})
    answer = ask.withColumns({"role": F.lit("assistant"), "user_text": F.lit(""), "assistant_text": F.lit("a")})
    for ttl, n in (("1 second", 0), ("7 days", 1)):
        base = str(tmp_path / f"n{n}")
        for rows in (ask, answer):
            rows.write.mode("append").parquet(f"{base}/in")
            SS.pairs_job(stream(spark, df, f"{base}/in"), f"{base}/out", f"{base}/state", ttl=ttl)
            time.sleep(2)
        assert spark.read.schema("assistant string").parquet(f"{base}/out").count() == n


def test_a_repeated_first_step_gives_no_row_twice(spark, tmp_path):
    """The edges are written, then the run ends before the second step."""
    df, base = turns(spark), str(tmp_path / "r")
    df.write.parquet(f"{base}/in")

    class Stop(Exception):
        pass

    real, SS._join_edges = SS._join_edges, lambda *a, **k: (_ for _ in ()).throw(Stop())
    try:
        SS.pairs_job(stream(spark, df, f"{base}/in", 100), f"{base}/out", f"{base}/state")
    except Stop:
        pass
    finally:
        SS._join_edges = real
    for _ in range(2):
        SS.pairs_job(stream(spark, df, f"{base}/in", 100), f"{base}/out", f"{base}/state")
    assert pairs_of(spark.read.parquet(f"{base}/out")) == pairs_of(W.build_pairs(df.withColumn("ord", F.col("seq"))))


def follow_of(df):
    return sorted((r.session_id or "", r.n_follow, tuple((m.role, m.content) for m in r.messages)) for r in df.collect())


def test_follow_windows_of_shuffled_arrival_equal_the_batch_form(spark, tmp_path):
    df = turns(spark, 200, 7).where("session_id is not null")
    for minutes, hot, lateness in ((7, 20, "200 minutes"), (0, 10**6, "0 minutes")):
        want = follow_of(W.follow_windows(df.withColumn("ord", F.col("seq")), 4, minutes, 5))
        base = str(tmp_path / f"{minutes}-{hot}-{lateness[0]}")
        # without lateness the turns come in order
        part = F.col("seq") % 2 if lateness[0] == "2" else F.floor(F.col("seq") / 100)
        end = df.limit(1).withColumns({"session_id": F.lit("~"), "ts": F.lit("2030-01-01").cast("timestamp"), "role": F.lit("system"), "has_human": F.lit(False)})
        for step in range(4):
            if step < 3:
                (df.where(part == step) if step < 2 else end).coalesce(1).write.mode("append").parquet(f"{base}/in")
            SS.follow_job(stream(spark, df, f"{base}/in", 1), f"{base}/out", f"{base}/state", 4, minutes, 5, lateness=lateness, hot_rows=hot)
        assert follow_of(spark.read.parquet(f"{base}/out")) == want and len(want) > 5


def test_rows_later_than_the_watermark_are_dropped(spark, tmp_path):
    df, base = turns(spark, 40, 3, ("s",)), str(tmp_path / "late")
    for part in (F.col("seq") >= 20, F.col("seq") < 20):
        df.where(part).coalesce(1).write.mode("append").parquet(f"{base}/in")
        SS.follow_job(stream(spark, df, f"{base}/in", 1), f"{base}/out", f"{base}/state", 4, 5, 2, lateness="1 minute")
    got = spark.read.parquet(f"{base}/out").collect()
    assert not any(m.content in {f"t{i}" for i in range(20)} for r in got for m in r.messages)


def _line(text):
    return json.dumps({"messages": [{"role": "user", "content": text + " " + "x" * 90}, {"role": "assistant", "content": "a"}]})


def test_seen_table_over_runs_retries_and_expiry(spark, tmp_path):
    src, out, ck = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "ck")
    src.mkdir()

    def run(name, texts, day):
        if texts:
            (src / f"{name}.jsonl").write_text("\n".join(map(_line, texts)) + "\n{bad\n")
        return SN.incremental_seen(spark, str(src), out, ck, keep_days=3, buckets=4, today=day)
    assert run("1", ["q1", "q2", "Q1"], "2024-01-01") == 2
    assert run("2", ["q2", "q3"], "2024-01-02") == 1
    assert run("3", [], "2024-01-02") == 0
    assert run("4", ["q1", "q3", "q4"], "2024-01-04") == 2  # q1 and q2 of the first day are forgotten, q3 is not
    assert spark.read.text(f"{out}/*").count() == 5
    table = SN.SeenTable(spark, f"{ck}/seen", keep_days=3)
    assert table.buckets == 4 and {str(r.day) for r in table.table(99, "2024-01-04").select("day").distinct().collect()} == {"2024-01-02", "2024-01-04"}


def test_seen_batch_may_be_repeated(spark, tmp_path):
    table = SN.SeenTable(spark, str(tmp_path / "seen"), buckets=4)
    sigs = lambda *x: spark.createDataFrame([(s,) for s in x], "sig string")
    table.add(sigs("a", "b"), 0, "2024-01-01")
    for _ in range(2):  # the same batch again, after a crash
        assert {r.sig for r in table.fresh(sigs("b", "c"), 1, "2024-01-01").collect()} == {"c"}
        table.add(sigs("c"), 1, "2024-01-01")
    assert sorted(r.sig for r in table.table(2, "2024-01-01").collect()) == ["a", "b", "c"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = table.fresh(sigs("x"), 2, "2024-01-01")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1  # only the new signatures move


def test_export_count_survives_a_run_that_ends_between_batches(spark, tmp_path):
    src, out, ck = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "ck")
    src.mkdir()
    for i in range(3):
        (src / f"{i}.jsonl").write_text(_line(f"q{i}") + "\n")
    real, ST.unreported = ST.unreported, lambda *a: (_ for _ in ()).throw(RuntimeError("the driver is lost"))
    try:
        ST.incremental(spark, str(src), out, ck, max_files=1)
    except RuntimeError:
        pass
    finally:
        ST.unreported = real
    assert spark.read.text(out).count() == 3
    (src / "9.jsonl").write_text(_line("q9") + "\n" + _line("q1") + "\n")
    assert ST.incremental(spark, str(src), out, ck) == 4
    assert ST.incremental(spark, str(src), out, ck) == 0
