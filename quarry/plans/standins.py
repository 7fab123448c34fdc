"""Driver tables re-read as the entities the operators work on.

The test tables are generic (conversations, documents, events,
orders/lineitem), so each entity of the dataset model gets a fixed,
documented derivation from them.  Every derivation reads whole tables
and is written so DuckDB can express the same thing in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

UPPER_ASCII = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_ASCII = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _messages(df: DataFrame, key: str = "conv_id") -> DataFrame:
    """Turn rows -> one chat example per conversation, ordered by turn.
    A conversation is one example, so its rows are one bounded group."""
    return df.groupBy("src", key).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("turn", "role", "text"))),
            lambda m: F.struct(m["role"].alias("role"), m["text"].alias("content")),
        ).alias("messages")
    )


def chat_examples(spark: SparkSession, sf_dir: str, upper_copy: bool = False) -> DataFrame:
    """``conversations`` as chat examples (M5) with ``ord = (src, conv_id)``.

    ``upper_copy`` appends the whole table a second time as input 1 with
    ASCII letters upper-cased (``translate``, so ``ß`` stays put): every
    passing example then has a case-only copy later in input order.
    """
    conv = table(spark, sf_dir, "conversations").select(
        F.lit(0).alias("src"), "conv_id", "turn", "role", "text")
    if upper_copy:
        conv = conv.unionByName(conv.select(
            F.lit(1).alias("src"), "conv_id", "turn", "role",
            F.translate("text", LOWER_ASCII, UPPER_ASCII).alias("text")))
    ex = _messages(conv)
    return ex.withColumn("ord", F.struct("src", "conv_id"))


def event_turns(spark: SparkSession, sf_dir: str, max_tool_chars: int = 4000,
                include_fallback: bool = False) -> DataFrame:
    """``events`` as normalised log turns (the output of
    ``segments.normalise``): session = user_id, order = (ts, event_id).

    signup -> human user turn; purchase -> assistant text; click / view ->
    tool-result-only user turn; error -> a record of another type.  The
    text of each row is ``<event_type> #<event_id> <props>``.
    """
    ev = table(spark, sf_dir, "events")
    body = F.concat(F.col("event_type"), F.lit(" #"), F.col("event_id").cast("string"),
                    F.lit(" "), F.coalesce(F.col("props"), F.lit("")))
    et = F.col("event_type")
    role = (F.when(et.isin("signup", "click", "view"), F.lit("user"))
            .when(et == "purchase", F.lit("assistant"))
            .otherwise(F.lit("error")))
    human = et == "signup"
    tool = et.isin("click", "view")
    user_text = (F.when(human, body)
                 .when(tool, T.strip(T.tool_block(body, max_tool_chars)))
                 .otherwise(F.lit("")))
    return ev.select(
        F.col("user_id").cast("string").alias("session_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts_raw"),
        F.col("ts").alias("ts"),   # TIMESTAMP_NTZ: window bounds do not depend on the zone
        F.struct(F.lit(0).alias("src"), F.col("event_id")).alias("ord"),
        F.col("event_id"),
        role.alias("role"),
        F.when(role == "user", user_text).otherwise(F.lit("")).alias("user_text"),
        F.when(et == "purchase", body).otherwise(F.lit("")).alias("assistant_text"),
        human.alias("has_human"),
        F.when(human, body).otherwise(F.lit("")).alias("human_text"),
    )


def conversation_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as normalised log turns: session = conv_id, order =
    turn, each text is string content (so user / assistant text is the
    stripped text and every user turn is a human turn)."""
    conv = table(spark, sf_dir, "conversations")
    txt = T.strip("text")
    role = F.col("role")
    return conv.select(
        F.col("conv_id").cast("string").alias("session_id"),
        F.lit(None).cast("string").alias("ts_raw"),
        F.lit(None).cast("timestamp").alias("ts"),
        F.struct(F.lit(0).alias("src"), F.col("conv_id"), F.col("turn")).alias("ord"),
        role.alias("role"),
        F.when(role == "user", txt).otherwise(F.lit("")).alias("user_text"),
        F.when(role == "assistant", txt).otherwise(F.lit("")).alias("assistant_text"),
        (role == "user").alias("has_human"),
        F.when(role == "user", txt).otherwise(F.lit("")).alias("human_text"),
    )


def _json_str(c):
    """A JSON string literal for a string column."""
    arr = F.to_json(F.array(c))
    return F.substring(arr, F.lit(2), F.length(arr) - F.lit(2))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` re-emitted as raw agent-log JSON lines (M1/M2):
    system turns carry ``session_id`` and string content; user turns a
    text segment plus a tool result (the ASCII upper-cased text), but every
    third one is string content, and every third other holds no segments
    and a ``toolUseResult`` instead; assistant turns a text segment plus a non-text tool-use segment.
    Columns ``ord, value`` like ``sources.jsonl.read_lines``."""
    conv = table(spark, sf_dir, "conversations")
    j = _json_str
    role = F.col("role")
    # wall-clock arithmetic on TIMESTAMP_NTZ: independent of the session zone
    ts = F.date_format(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
                       + F.make_dt_interval(secs=F.col("turn") * 60),
                       "yyyy-MM-dd'T'HH:mm:ss'Z'")
    up = F.translate("text", LOWER_ASCII, UPPER_ASCII)
    content = (
        F.when((role == "user") & (F.col("conv_id") % 3 == 1), j(F.col("text")))
        .when((role == "user") & (F.col("conv_id") % 3 == 2), F.lit("[]"))
        .when(role == "user", F.concat(
            F.lit('[{"type":"text","text":'), j(F.col("text")),
            F.lit('},{"type":"tool_result","content":'), j(up), F.lit("}]")))
        .when(role == "assistant", F.concat(
            F.lit('[{"type":"text","text":'), j(F.col("text")),
            F.lit('},{"type":"tool_use","name":"grep"}]')))
        .otherwise(j(F.col("text"))))
    key = F.when(role == "system", F.lit("session_id")).otherwise(F.lit("sessionId"))
    value = F.concat(
        F.lit('{"conv_id":'), F.col("conv_id").cast("string"), F.lit(',"turn":'), F.col("turn").cast("string"),
        F.lit(',"'), key, F.lit('":'), j(F.col("conv_id").cast("string")),
        F.lit(',"type":'), j(role), F.lit(',"timestamp":'), j(ts),
        F.lit(',"cwd":"/work/repo'), F.col("conv_id").cast("string"), F.lit('"'),
        F.when((role == "user") & (F.col("conv_id") % 3 == 2), F.concat(F.lit(',"toolUseResult":{"file":{"content":'), j(up), F.lit("}}")))
        .otherwise(F.lit("")),
        F.lit(',"message":{"role":'), j(role), F.lit(',"content":'), content, F.lit("}}"))
    return conv.select(F.struct(F.lit(0).alias("src"), "conv_id", "turn").alias("ord"),
                       value.alias("value"))


def document_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as exported commits + diffs (M8/M9).

    sha = md5(doc_id); message = the document text; parents: none for
    doc_id 0 (root), two for German documents (merge commits), else
    the previous doc_id; refs: ``main``, ``feature/<lang>`` and the
    symbolic ``origin/HEAD``; committed_at = 2024-01-01 + doc_id minutes.
    The diff rewrites the text as one file: header lines, then each line
    prefixed by position (pos % 5 = 1 removed, 3 added, else context).
    """
    docs = table(spark, sf_dir, "documents")
    sha = F.md5(F.col("doc_id").cast("string"))
    prev = F.md5((F.col("doc_id") - 1).cast("string"))
    prev2 = F.md5((F.col("doc_id") - 2).cast("string"))
    d = docs
    parents = (F.when(F.col("doc_id") == F.lit(0), F.array().cast("array<string>"))
               .when(F.col("lang") == "de", F.array(prev, prev2))
               .otherwise(F.array(prev)))
    lines = F.split(T.lf(F.col("text")), "\n")
    marked = F.transform(lines, lambda x, i: F.concat(
        F.when(i % 5 == 1, F.lit("-")).when(i % 5 == 3, F.lit("+")).otherwise(F.lit(" ")), x))
    path = F.col("doc_id").cast("string")
    header = F.concat(F.lit("diff --git a/"), path, F.lit(" b/"), path, F.lit("\n--- a/"), path,
                      F.lit("\n+++ b/"), path, F.lit("\n@@ -1 +1 @@\n"))
    diff = F.concat(header, F.array_join(marked, "\n"))
    # lines at positions 1 and 3 (mod 5) among N lines, in closed form
    n = F.size(lines)
    n_lines = F.floor((n + 3) / 5) + F.floor((n + 1) / 5)
    # the diff text is built once per document (a one-row Generate), even
    # where filters on it are pushed down
    d = d.select("*", F.explode(F.array(diff)).alias("_diff"))
    diff = F.col("_diff")
    return d.select(
        "doc_id", sha.alias("sha"), parents.alias("parents"),
        F.col("text").alias("message"), F.lit(1).alias("n_files"), n_lines.cast("int").alias("n_lines"),
        F.array(F.lit("main"), F.concat(F.lit("feature/"), F.col("lang")), F.lit("origin/HEAD")).alias("refs"),
        F.lit("repo0").alias("repo"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=F.col("doc_id"))).alias("committed_at"),
        diff.alias("diff"))


def document_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repository paths derived from documents: directory from the source
    (two sources sit under ``node_modules``/``build``), file name from the
    id, extension from the language."""
    d = table(spark, sf_dir, "documents")
    ext = (F.when(F.col("lang") == "en", F.lit(".ts")).when(F.col("lang") == "fr", F.lit(".min.js"))
           .when(F.col("lang") == "de", F.lit(".PNG")).otherwise(F.lit(".json")))
    top = (F.when(F.col("source") == "src3", F.lit("node_modules/"))
           .when(F.col("source") == "src7", F.lit("build/")).otherwise(F.lit("")))
    name = F.when(F.col("source") == "src5", F.lit("package-lock")).otherwise(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")))
    return d.select("doc_id", F.concat(top, F.col("source"), F.lit("/"), name, ext).alias("path"))


def log_files(spark: SparkSession, sf_dir: str) -> str:
    """``log_lines`` written once as text files under the shared checkpoint
    folder (raw logs are files); returns the folder.  Later calls in the
    same session reuse it."""
    import hashlib
    from ..session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/logs-{hashlib.md5(sf_dir.encode()).hexdigest()}"
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    if not hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath):
        log_lines(spark, sf_dir).select("value").write.mode("overwrite").text(path)
    return path
