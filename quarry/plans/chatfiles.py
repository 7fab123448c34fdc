"""Chat files derived from ``conversations``: written as JSONL with keys the
operators do not use, bad and blank lines, and read back through the chat
readers; queries over the files and their SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import quality as Q
from ..operators import split as SP
from ..operators import stats as ST
from ..operators.scan import running_sums
from ..session import ensure_checkpoint_dir
from ..sources import jsonl as J
from ..sources import sinks as KS
from . import oracle as O
from . import standins as S
from .queries import CLIP_CAP, QC_MAX_TOKENS, query

SQL = O.SQL


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _raw(spark: SparkSession, sf_dir: str, upper: bool = False) -> str:
    """Conversations as chat lines in conv_id order.  Each message has a
    ``weight`` of 1.0, a ``name`` and a ``tool_calls`` key, each record an ``id``; every tenth
    conversation has no user role, every eleventh a blank first user text;
    after every seventh line comes a bad one, after every ninth a blank one."""
    conv = S.table(spark, sf_dir, "conversations")
    text = F.translate("text", S.LOWER_ASCII, S.UPPER_ASCII) if upper else F.col("text")
    role = F.when((F.col("conv_id") % 10 == 3) & (F.col("role") == "user"), F.lit("tool")).otherwise(F.col("role"))
    blank = (F.col("conv_id") % 11 == 5) & (F.col("role") == "user")
    rows = conv.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "turn", role.alias("role"), F.when(blank, F.lit(" \t")).otherwise(text).alias("content")))).alias("m"))
    messages = F.transform("m", lambda x: F.struct(
        x["role"].alias("role"), x["content"].alias("content"), F.lit(1.0).alias("weight"), F.concat(F.lit("n"), x["turn"]).alias("name"),
        F.array(F.struct(x["turn"].alias("id"))).alias("tool_calls")))
    line = F.to_json(F.struct(F.col("conv_id").alias("id"), messages.alias("messages")))
    junk = F.when(F.col("conv_id") % 7 == 0, F.array(line, F.lit('{"messages": [}'))) \
        .when(F.col("conv_id") % 9 == 0, F.array(line, F.lit("   "))).otherwise(F.array(line))
    path = _folder(spark, "chat")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = rows.repartitionByRange(n, "conv_id").sortWithinPartitions("conv_id").select(F.explode(junk).alias("value"))
    lines.write.text(path)
    return path


def _clean(spark: SparkSession, sf_dir: str) -> list[str]:
    """The two raw files through read_chat, the cascade and write_chat."""
    out = []
    for upper in (False, True):
        rows = J.read_chat(spark, _raw(spark, sf_dir, upper))
        out.append(_folder(spark, "clean"))
        KS.write_chat(Q.qc_clean(rows, Q.qc_groups(rows), QC_MAX_TOKENS), out[-1])
    return out


@query("chat_qc_report")
def chat_qc_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + F2 + A1 on a file with bad and blank lines."""
    rows = J.read_chat(spark, _raw(spark, sf_dir))
    return Q.qc_report(Q.qc_groups(rows), QC_MAX_TOKENS, include_kept=True).select("drop_reason", "n")


@query("export_jsonl")
def export_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 -> QC -> K1: the written lines, as they are, with the message keys
    that no operator uses and their place in the file."""
    path = _clean(spark, sf_dir)[0]
    lines = J.read_lines(spark, path, recursive=False).withColumn("line", F.col("value"))
    places = running_sums(lines.select("ord"), [], ["ord"], {"place": F.lit(1)})
    back = J.parse_records(lines).join(places.withColumnRenamed("ord", "_ord"), F.col("ord") == F.col("_ord"))
    m = F.try_variant_get("rec", "$.messages", "array<struct<role:string,content:string,name:string,tool_calls:array<struct<id:bigint>>>>")
    line = F.array_join(F.transform(m, lambda x: F.concat_ws(":", x["role"], x["name"], F.get(x["tool_calls"], 0)["id"], x["content"])), "\n")
    first = F.get(m, 0)["content"]
    return back.select("place", F.md5(line).alias("line_md5"), F.md5(first).alias("first_md5"), F.md5("line").alias("written_md5"))


@query("merge_counts")
def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: rows that read_chat_many yields per input, in argument order."""
    return J.read_chat_many(spark, _clean(spark, sf_dir)).groupBy("src").agg(F.count(F.lit(1)).alias("n"))


@query("chat_merge_split")
def chat_merge_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 -> D2 -> L2 -> K2 -> S7: cleaned files, one given twice, merged,
    split, written and loaded again."""
    a, b = _clean(spark, sf_dir)
    rows = J.read_chat_many(spark, [a, b, a])
    flags = SP.merge_flags(rows)
    uniq = rows.join(flags.where(~F.col("is_dup")).select(F.col("ord").alias("_o"), "sig"), F.col("ord") == F.col("_o")).drop("_o")
    train, held = SP.split(uniq, "sig", seed=42)
    tp, ep = KS.write_split(train, held, _folder(spark, "split"), name="full")
    tr, ev = J.load_dataset(spark, tp, ep)

    def side(df, name):
        return df.select(F.lit(name).alias("split"), T.merge_signature("messages").alias("sig"))
    return side(tr, "train").unionByName(side(ev, "eval"))


@query("append_files")
def append_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: examples of several sources appended to one output, read back."""
    ex = S.chat_examples(spark, sf_dir, upper_copy=True)
    out = _folder(spark, "appended")
    for source in (0, 1):
        KS.write_chat(ex.where(F.col("src") == source), out, mode="append")
    return J.read_chat(spark, out).select(T.merge_signature("messages").alias("sig"))


@query("clip_files")
def clip_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 -> P16 -> K4 + A5: texts clipped in a file of records that hold
    text, messages or neither; other fields pass through."""
    d = S.table(spark, sf_dir, "documents")
    kind = F.col("doc_id") % 4
    path = _folder(spark, "records")
    d.select(F.to_json(F.struct(
        F.col("doc_id").alias("id"), F.struct("lang", "source").alias("meta"),
        F.when(kind < 2, F.col("text")).when(kind == 3, F.lit("")).alias("text"),
        F.when(kind == 2, F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))).alias("messages"))
    ).alias("value")).write.text(path)
    rows = ST.clip_tokens(J.read_examples(spark, path, keep_empty=True), CLIP_CAP, "text")
    out = _folder(spark, "clipped")
    KS.write_examples(rows.where(F.col("clip_status") != "dropped"), out)
    back = J.parse_records(J.read_lines(spark, out, recursive=False).withColumn("line", F.col("value")))

    def field(path, kind="string"):
        return F.try_variant_get("rec", path, kind)
    back = back.withColumn("keys", F.array_join(F.json_object_keys("line"), ","))
    written = back.select("keys", field("$.id", "bigint").alias("doc_id"), field("$.meta.lang").alias("lang"), field("$.meta.source").alias("source"),
                          F.md5(field("$.text")).alias("text_md5"), field("$.messages[0].role").alias("role"))
    dropped = rows.where(F.col("clip_status") == "dropped").select(
        F.lit(None).cast("string").alias("keys"), field("$.id", "bigint").alias("doc_id"), F.lit("dropped").alias("lang"), F.lit(None).cast("string").alias("source"),
        F.lit(None).cast("string").alias("text_md5"), F.lit(None).cast("string").alias("role"))
    return written.unionByName(dropped)


# ------------------------------------------------------------------ SQL twins
def _qc(text: str) -> str:
    """Lines, reasons and signatures of one raw file."""
    return f"""SELECT conv_id, m, CASE
    WHEN NOT list_contains(list_transform(m, lambda x: x.role), 'assistant') THEN 'no_assistant'
    WHEN NOT list_contains(list_transform(m, lambda x: x.role), 'user') OR conv_id % 11 = 5 THEN 'no_user'
    WHEN length({O.strip("list_filter(m, lambda x: x.role = 'user')[1].content")}) < 80 THEN 'short_user' END AS reason,
    md5(lower(array_to_string(list_transform(m, lambda x: lower(x.role) || ':' || {O.strip('x.content')}), chr(10)))) AS sig,
    md5(array_to_string(list_transform(m, lambda x: lower(x.role) || ':' || {O.strip('x.content')}), chr(10))) AS msig,
    floor(length(array_to_string(list_transform(m, lambda x: x.content), chr(10))) / 4) AS n_tok
  FROM (SELECT conv_id, list({{'role': role, 'content': content, 'turn': turn}} ORDER BY turn) AS m FROM (
    SELECT conv_id, turn, CASE WHEN conv_id % 10 = 3 AND role = 'user' THEN 'tool' ELSE role END AS role,
      CASE WHEN conv_id % 11 = 5 AND role = 'user' THEN ' ' || chr(9) ELSE {text} END AS content FROM conversations) c GROUP BY conv_id) g"""


def _file(name: str, text: str) -> str:
    return f"""{name}0 AS ({_qc(text)}), {name} AS (
  SELECT *, CASE WHEN reason IS NOT NULL THEN reason WHEN row_number() OVER (PARTITION BY reason IS NULL, sig ORDER BY conv_id) > 1 THEN 'duplicate'
    WHEN n_tok > 700 THEN 'too_long' ELSE 'kept' END AS drop_reason FROM {name}0)"""


SQL["chat_qc_report"] = f"""WITH {_file('a', 'text')}
SELECT drop_reason, count(*) AS n FROM a GROUP BY drop_reason
UNION ALL SELECT 'bad_json', count(*) FROM a WHERE conv_id % 7 = 0"""

SQL["export_jsonl"] = f"""WITH {_file('a', 'text')}
SELECT row_number() OVER (ORDER BY conv_id) AS place,
  md5(array_to_string(list_transform(m, lambda x: x.role || ':n' || CAST(x.turn AS VARCHAR) || ':' || CAST(x.turn AS VARCHAR) || ':' || x.content), chr(10))) AS line_md5,
  md5(m[1].content) AS first_md5,
  md5('{{"messages":[' || array_to_string(list_transform(m, lambda x: '{{"role":"' || x.role || '","content":' || CAST(to_json(x.content) AS VARCHAR)
    || ',"weight":1.0,"name":"n' || CAST(x.turn AS VARCHAR) || '","tool_calls":[{{"id":' || CAST(x.turn AS VARCHAR) || '}}]}}'), ',') || ']}}') AS written_md5
FROM a WHERE drop_reason = 'kept'"""

SQL["merge_counts"] = f"""WITH {_file('a', 'text')}, {_file('b', O.UP)}
SELECT 0 AS src, count(*) AS n FROM a WHERE drop_reason = 'kept' UNION ALL SELECT 1, count(*) FROM b WHERE drop_reason = 'kept'"""

SQL["chat_merge_split"] = f"""WITH {_file('a', 'text')}, {_file('b', O.UP)}, u AS (
  SELECT DISTINCT msig FROM (SELECT msig FROM a WHERE drop_reason = 'kept' UNION ALL SELECT msig FROM b WHERE drop_reason = 'kept') x
), k AS (SELECT msig, count(*) OVER () AS n, row_number() OVER (ORDER BY md5('42:' || msig)) AS rn FROM u)
SELECT CASE WHEN rn <= CASE WHEN n < 2 THEN 0 ELSE least(greatest(least(CAST(round_even(n * 0.15, 0) AS BIGINT), n // 2),
  CASE WHEN n >= 100 THEN least(100, n - 1) ELSE 1 END), n - 1) END THEN 'eval' ELSE 'train' END AS split, msig AS sig FROM k"""

SQL["clip_files"] = f"""WITH t AS (
  SELECT doc_id, lang, source, CASE doc_id % 4 WHEN 0 THEN text WHEN 1 THEN text
    WHEN 2 THEN '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10) ELSE '' END AS x FROM documents
)
SELECT doc_id, CASE WHEN x = '' THEN 'dropped' ELSE lang END AS lang, CASE WHEN x <> '' THEN source END AS source,
  CASE WHEN x <> '' THEN md5(CASE WHEN length(x) // 4 <= {CLIP_CAP} THEN x ELSE substr(x, 1, {CLIP_CAP} * 4 + 3) END) END AS text_md5,
  CASE WHEN doc_id % 4 = 2 THEN 'user' END AS role,
  CASE WHEN x = '' THEN NULL WHEN doc_id % 4 < 2 THEN 'id,meta,text' ELSE 'id,meta,messages,text' END AS keys FROM t"""

SQL["append_files"] = f"""WITH {O.EXAMPLES_2}
SELECT md5(array_to_string(list_transform(messages, lambda m: lower(coalesce(m.role, '')) || ':' || {O.strip("coalesce(m.content, '')")}), chr(10))) AS sig FROM ex"""
