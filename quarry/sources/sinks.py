"""Sinks (K1-K4): JSONL writers with the original overwrite contract."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_JSON_OPTS = {"ignoreNullFields": "false"}


def _exists(df: DataFrame, path: str) -> bool:
    jvm = df.sparkSession._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def _in_order(df: DataFrame, ordered: bool | None) -> DataFrame:
    """Rows laid out by ``ord`` over consecutive part files, so that a later
    scan sees them in input order."""
    if not (("ord" in df.columns) if ordered is None else ordered):
        return df
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, "ord").sortWithinPartitions("ord")


# ------------------------------------------------------------------- K1 / K3
def write_chat(df: DataFrame, path: str, mode: str = "errorifexists", ordered: bool | None = None) -> None:
    """One ``{"messages": [...]}`` object per line, UTF-8 unescaped.  Rows
    that still hold the text of their messages (``raw``) are written from
    it, keys in their order and numbers as they were; rows with their record
    (``rec``) keep every key; others are written from the typed
    ``messages``.  Rows with ``ord`` are
    written in input order (``ordered=False`` skips that shuffle).
    ``mode="append"`` gives the several-repositories-into-one-output sink."""
    value = F.to_json(F.struct("messages"), _JSON_OPTS)
    if "rec" in df.columns:
        parsed = F.to_json(F.try_variant_get("rec", "$.messages", "variant"))
        value = F.coalesce(F.concat(F.lit('{"messages":'), parsed, F.lit("}")), value)
    if "raw" in df.columns:
        value = F.coalesce(F.concat(F.lit('{"messages":'), F.col("raw"), F.lit("}")), value)
    cols = [value.alias("value")] + (["ord"] if "ord" in df.columns else [])
    _in_order(df.select(*cols), ordered).select("value").write.mode(mode).text(path)


# ------------------------------------------------------------------- K2
def write_split(train: DataFrame, eval: DataFrame, out_dir: str,
                name: str | None = None, force: bool = False,
                ordered: bool | None = None) -> tuple[str, str]:
    """Write ``train.<suffix>`` and ``eval.<suffix>``; both targets are
    checked before either is written and refused unless ``force``."""
    suffix = name or _dt.datetime.now().strftime("%Y%m%d-%H%M%S")
    tp = f"{out_dir.rstrip('/')}/train.{suffix}.jsonl"
    ep = f"{out_dir.rstrip('/')}/eval.{suffix}.jsonl"
    if not force:
        for p in (tp, ep):
            if _exists(train, p):
                raise FileExistsError(f"Refusing to overwrite {p} (use force=True).")
    mode = "overwrite" if force else "errorifexists"
    write_chat(train, tp, mode, ordered)
    write_chat(eval, ep, mode, ordered)
    return tp, ep


# ------------------------------------------------------------------- K4
def _quoted(c) -> Column:
    """A JSON string."""
    text = F.to_json(F.array(c))
    return F.substring(text, F.lit(2), F.length(text) - F.lit(2))


def _with_text(line: Column, rec: Column, text: Column) -> Column:
    """A record's JSON text with its ``text`` replaced in place, or added at
    the end; all else in its order and as it was written.  A value that
    cannot be cut out by its key is written from the parsed record."""
    fields = F.try_variant_get(rec, "$", "map<string,variant>")
    keys = F.json_object_keys(line)

    def value(k: Column) -> Column:
        own = fields[k]
        is_text = F.schema_of_variant(own) == "STRING"
        cut = F.call_function("get_json_object", line, F.concat(F.lit("$['"), k, F.lit("']")))
        return F.when(k == "text", _quoted(text)).when(is_text, F.to_json(own)).otherwise(F.coalesce(cut, F.to_json(own)))
    parts = F.transform(keys, lambda k: F.concat(_quoted(k), F.lit(":"), value(k)))
    more = F.when(F.array_contains(keys, "text"), F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit('"text":'), _quoted(text))))
    return F.concat(F.lit("{"), F.array_join(F.concat(parts, more), ","), F.lit("}"))


def write_examples(df: DataFrame, path: str, mode: str = "errorifexists", ordered: bool | None = None) -> None:
    """Rows with an added/overridden ``text``; all other fields pass through.
    With ``line`` and ``rec`` the record is written as it was, ``text``
    replaced; else the columns are the fields.  Order as in
    :func:`write_chat`."""
    if {"line", "rec"} <= set(df.columns):
        value = _with_text(F.col("line"), F.col("rec"), F.col("text"))
    else:
        value = F.to_json(F.struct(*[c for c in df.columns if c != "ord"]), _JSON_OPTS)
    cols = [value.alias("value")] + (["ord"] if "ord" in df.columns else [])
    _in_order(df.select(*cols), ordered).select("value").write.mode(mode).text(path)
