"""Column functions against Python semantics on literal edge cases."""



from quarry.functions import text as T

PAD = "\t\n\x0b\x1c\x85\xa0 　"


def one(spark, expr, value, schema="s string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr.alias("r")).collect()[0]["r"]


def test_strip_matches_python(spark):
    cases = [PAD + "x y" + PAD, "​keep​", "", "   ", "\x1f\x1ea\x1d\x1c", "a  "]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = [r["r"] for r in df.select(T.strip("s").alias("r")).collect()]
    assert got == [c.strip() for c in cases]


def test_strip_every_bmp_space(spark):
    # every code point that Python treats as whitespace, as padding
    spaces = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
    df = spark.createDataFrame([(spaces + "a" + spaces,), ("​",)], "s string")
    got = [r["r"] for r in df.select(T.strip("s").alias("r")).collect()]
    assert got == ["a", "​"]


def test_subject_last_n_lf(spark):
    assert one(spark, T.subject("s"), "  fix: thing \r\nbody") == "fix: thing"
    assert one(spark, T.subject("s"), "a b") == "a"
    assert one(spark, T.last_n("s", 3), "abcdef") == "def"
    assert one(spark, T.last_n("s", 10), "abc") == "abc"
    assert one(spark, T.last_n("s", 0), "abc") == "abc"
    assert one(spark, T.lf("s"), "a\r\nb\rc\n") == "a\nb\nc\n"


def test_preview(spark):
    s = "one  two\tthree four five six"
    assert one(spark, T.preview("s", 100), s) == "one two three four five six"
    assert one(spark, T.preview("s", 14), s) == "one two …"
    assert one(spark, T.preview("s", 3), "abcdef") == "…"


def test_intentful_cases(spark):
    # fixture cases: message -> intentful
    cases = {"fix x": True, "chore: fix x": False, "formatting fix": True, "prefix": True,
             "": False, "WIP_x": False, "WIP_fix": True, "merge": False, "   ": False, "Add feature": True,
             "bump deps": False, "hello world": False}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r["s"]: r["r"] for r in df.select("s", T.intentful("s").alias("r")).collect()}
    assert got == cases


def test_skip_path_cases(spark):
    cases = {"src/build/x.ts": True, "out": True, "a.min.js": False, "LOGO.PNG": True,
             "Cargo.lock": True, "go.sum": True, "x/package-lock.json": True,
             "src/app.ts": False, ".png": False, "docs/readme.md": False, "node_modules/a/b.js": True}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r["s"]: r["r"] for r in df.select("s", T.skip_path("s").alias("r")).collect()}
    assert got == cases


def test_generation_cleanup(spark):
    g = "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n  answer<|im_end|>"
    assert one(spark, T.extract_assistant("s"), g) == "answer"
    assert one(spark, T.extract_assistant("s"), "plain text") == "plain text"
    assert one(spark, T.strip_tool_markers("s"), "ok<tool_call>x<|tool|>y") == "ok"


def test_tool_block_cap(spark):
    val = "x" * 100
    full = "\n[TOOL RESULT]\n" + val
    assert one(spark, T.tool_block("s", 200), val) == full
    cut = one(spark, T.tool_block("s", 50), val)
    assert cut == full[:50] + "\n[...truncated tool output...]"


def test_signatures_and_estimate(spark):
    import hashlib
    msgs = [("User ", " Hi "), ("assistant", "Yo")]
    df = spark.createDataFrame([(msgs,)], "messages array<struct<role:string,content:string>>")
    r = df.select(T.qc_signature("messages").alias("q"), T.merge_signature("messages").alias("m"),
                  T.token_estimate("messages").alias("n")).collect()[0]
    qs = "\n".join(f"{a.strip().lower()}:{b.strip()}" for a, b in msgs).lower()
    ms = "\n".join(f"{a.lower()}:{b.strip()}" for a, b in msgs)
    assert r["q"] == hashlib.md5(qs.encode()).hexdigest()
    assert r["m"] == hashlib.md5(ms.encode()).hexdigest()
    assert r["n"] == int(len("\n".join(b for _, b in msgs)) / 4)


def test_render_chat(spark):
    msgs = [("system", "s"), ("user", "u")]
    df = spark.createDataFrame([(msgs,)], "messages array<struct<role:string,content:string>>")
    r = df.select(T.render_chat("messages", generation_prompt=True).alias("r")).collect()[0]["r"]
    assert r == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n<|im_start|>assistant\n"


def test_skip_path_full_suffix_option(spark):
    df = spark.createDataFrame([("a.min.js",), ("x/lib.min.js",), ("b.js",)], "s string")
    got = [r["r"] for r in df.select(T.skip_path("s", full_suffix=True).alias("r")).collect()]
    assert got == [True, True, False]


def test_eval_size_cap_after_min():
    from quarry.operators.split import eval_size
    assert eval_size(100) == 99 and eval_size(100, cap_after_min=True) == 50
