"""License gate, redaction, order keys of file rows, quantiles of numbers, messages as written."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import quality as Q
from quarry.operators import stats as ST
from quarry.operators.quantiles import order_statistics
from quarry.sources import jsonl as J
from quarry.sources import sinks as K


@pytest.mark.parametrize("text,want", [
    ("released under MIT", "mit"), ("Apache 2.0", "apache-2.0"), ("MPL 2.0 applies", "mpl-2.0"), ("SPDX-License-Identifier: Apache-2.0", "apache-2.0"),
    ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3.0"), ("Licensed under the terms of the MIT license", "mit"), ("BSD 3-Clause License", "bsd"),
    ("permit me to limit this", "none"), ("some license applies", "unknown"), ("(c) 2020 Someone", "unknown"), ("GNU Lesser General Public License", "lgpl"),
    ("MIT License. All rights reserved.", "proprietary"), ("gplv2", "gpl"), ("Dual GPL / MIT license", "gpl"), ("", "none"), ("AGPL-3.0", "agpl"),
    ("sublicense", "unknown"), ("CC BY-NC 4.0", "cc-by-nc-4.0")])
def test_license_class(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string").withColumn("t", F.lower("t"))
    assert df.select(Q.license_class("t")).first()[0] == want


def test_gate_is_closed_to_what_it_does_not_know(spark):
    df = spark.createDataFrame([("MIT License",), ("my own license",), ("no word of it",), ("GPL",)], "text string")
    assert [r.text for r in Q.license_gate(df).collect()] == ["MIT License"]
    assert Q.license_gate(df, allowed=["none"]).count() == 1


@pytest.mark.parametrize("text,want", [
    ("password=hunter2 x", "[SECRET] x"), ("token: abc; y", "[SECRET]; y"), ("API_KEY = \"a b\"", "[SECRET]"), ("secret: 'it is' z", "[SECRET] z"),
    ("v1.2.3.4 and 10.20.30.400", "v1.2.3.4 and 10.20.30.400"), ("at 10.20.30.40.", "at [IP]."), ("255.255.255.255 256.1.1.1", "[IP] 256.1.1.1"),
    ("a.b+c@d.org,", "[EMAIL],"), ("tokens: many", "tokens: many"), ("x" * 2000 + "@", "x" * 2000 + "@"), ("123-45-6789", "[SSN]")])
def test_redaction(spark, text, want):
    r = Q.redact(spark.createDataFrame([(text,)], "text string")).first()
    assert r.text == want and r.n_redacted == (text != want)


def test_file_rows_are_deduped_by_hash_aggregates(spark, tmp_path):
    """The order of file rows holds a path; first copies follow argument, path and line."""
    line = lambda i: json.dumps({"messages": [{"role": "user", "content": f"q{i} " + "x" * 90}, {"role": "assistant", "content": "a"}]})
    for name, items in {"b": [1, 2, 1], "a": [2, 3], "ü c": [3, 4]}.items():
        (tmp_path / f"{name}.jsonl").write_text("\n".join(map(line, items)) + "\n")
    rows = J.read_chat(spark, str(tmp_path))
    groups = Q.qc_groups(rows)
    got = groups.collect()
    assert "SortAggregate" not in groups._jdf.queryExecution().executedPlan().toString()
    kept = {(r.ord.path.rpartition("/")[2][0], r.ord.row & 0xFF) for r in got if r.reason is None}
    assert kept == {("a", 0), ("a", 1), ("b", 0)} | {k for k in kept if k[0] not in "ab"} and len(kept) == 4
    many = J.read_chat_many(spark, [str(tmp_path / "b.jsonl"), str(tmp_path / "a.jsonl")])
    sig = many.withColumn("sig", F.md5(F.to_json("messages")))
    assert sorted((r.src, r.messages[0].content[:2]) for r in Q.keep_first(sig, "sig").collect()) == [(0, "q1"), (0, "q2"), (1, "q3")]


@pytest.mark.parametrize("n,kinds", [(0, 1), (1, 9), (400, 3), (3000, 10**9)])
def test_order_statistics_are_exact(spark, n, kinds):
    rng = random.Random(n)
    values = [rng.choice([rng.randrange(kinds) / 7, -0.5, 1e300]) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 5, "v double").repartition(5)
    ranks = sorted({0, 1, n // 3, n // 2, n - 1, n + 5})
    want = [sorted(values)[r] if 0 <= r < n else None for r in ranks]
    assert order_statistics(df, "v", ranks, exact_below=100) == want == order_statistics(df, "v", ranks)


def test_number_stats_rules(spark):
    values = [i / 3 for i in range(101)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    r = ST.number_stats(df, "v", (0.5, 0.905), "linear").first()
    assert (r.n, r.p50, r.min, r.max, r.median) == (101, values[50], 0, values[-1], values[50]) and abs(r.p90_5 - 90.5 / 3) < 1e-9
    assert ST.number_stats(df, "v", (0.999,), "floor").first().p99_9 == values[99]
    assert ST.number_stats(df, "v", (50,), "scan").first().p50 == values[50]
    empty = ST.number_stats(df.where("v < 0"), "v", (0.5,), "linear").first()
    assert (empty.n, empty.p50, empty.max) == (0, None, None)


def test_messages_are_written_as_they_were(spark, tmp_path):
    raw = '{"role":"user","content":"hé","x":1.0,"a":{"z":1,"b":[2.50,null,true]}}'
    (tmp_path / "in.jsonl").write_text('{"id": 1, "messages": [' + raw + ', {"content": 5, "role": "tool"}], "n": 1.0}\n')
    rows = J.read_chat(spark, str(tmp_path / "in.jsonl"))
    K.write_chat(rows, str(tmp_path / "out"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ['{"messages":[' + raw.replace("2.50", "2.5") + ',{"content":5,"role":"tool"}]}']
    assert [m.content for m in rows.first().messages] == ["hé", "5"]
    tr, _ = J.load_dataset(spark, str(tmp_path / "in.jsonl"))
    assert tr.select(F.try_variant_get("rec", "$.n", "double"), F.try_variant_get("rec", "$.messages[0].a.z", "int")).first()[:] == (1.0, 1)


def test_records_keep_their_order_when_their_text_is_replaced(spark, tmp_path):
    lines = ['{"z":1.0,"text":"old","a":{"y":1,"b":"q\\"t"},"s":"it\'s","n":null,"k\'s":[1.0]}', '{"messages":[{"role":"user","content":"m"}],"t":true}']
    (tmp_path / "in.jsonl").write_text("\n".join(lines) + "\n")
    rows = J.read_examples(spark, str(tmp_path / "in.jsonl")).withColumn("text", F.lit('n"w'))
    K.write_examples(rows, str(tmp_path / "out"))
    got = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert got[0].startswith(lines[0].replace("old", 'n\\"w')[:-len('"k\'s":[1.0]}')]) and json.loads(got[0])["k's"] == [1.0]
    assert got[1] == lines[1][:-1] + ',"text":"n\\"w"}'
