"""Raw log records -> normalised turns.

A log record's ``message.content`` is polymorphic: a string, or an array
whose items are bare strings or objects ``{type, text, content}``, where a
tool result's ``content`` may itself be a string or an array.  Records are
kept as VARIANT and every text rule is a higher-order function over the
segment array, evaluated per row: no explode, no regrouping shuffle.

Output columns of ``normalise``: ``ord, session_id, ts_raw, ts, cwd,
role, user_text, assistant_text, has_human, human_text``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T

HUMAN_TYPES = [t for t in K.USER_SEGMENT_TYPES if t != "tool_result"]


def _as_array(v) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _as_map(v) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def is_array(v) -> Column:
    return _as_array(v).isNotNull()


def is_object(v) -> Column:
    return _as_map(v).isNotNull()


def kind(v) -> Column:
    """Upper-case JSON type: ARRAY, OBJECT, STRING, BIGINT, BOOLEAN, VOID
    (JSON null), ... and MISSING for SQL null.  Containers are recognised
    by a cast, so ``schema_of_variant`` (which walks the whole value) only
    ever runs on scalars."""
    return (F.when(v.isNull(), F.lit("MISSING"))
            .when(is_array(v), F.lit("ARRAY"))
            .when(is_object(v), F.lit("OBJECT"))
            .otherwise(F.schema_of_variant(v)))


def as_string(v) -> Column:
    """The string value when the VARIANT is a JSON string, else null."""
    return F.when(kind(v) == F.lit("STRING"), F.try_variant_get(v, "$", "string"))


def truthy(v) -> Column:
    """Python truthiness of a JSON value."""
    k = kind(v)
    return (
        F.when(k.isin("MISSING", "VOID"), F.lit(False))
        .when(k == "STRING", F.length(F.try_variant_get(v, "$", "string")) > 0)
        .when(k == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(k == "ARRAY", F.size(_as_array(v)) > 0)
        .when(k == "OBJECT", F.size(_as_map(v)) > 0)
        .otherwise(F.coalesce(F.try_variant_get(v, "$", "double") != F.lit(0.0), F.lit(True)))
    )


def _field(v, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def _seg_value(seg) -> Column:
    """``seg.get("text") or seg.get("content")`` if it is a non-blank
    string, else null."""
    t, c = _field(seg, "text"), _field(seg, "content")
    v = F.when(truthy(t), as_string(t)).otherwise(as_string(c))
    return F.when(~T.is_blank(v), v)


def decode_segments(content) -> Column:
    """Each array item decoded once: ``bare`` (a string item), ``typ``
    (object type), ``val`` (non-blank text-or-content), ``tool`` (string
    content).  Null when the content is not an array."""
    def dec(seg):
        obj = is_object(seg)
        return F.struct(
            F.when(~obj, as_string(seg)).alias("bare"),
            F.when(obj, F.try_variant_get(seg, "$.type", "string")).alias("typ"),
            F.when(obj, _seg_value(seg)).alias("val"),
            F.when(obj, as_string(_field(seg, "content"))).alias("tool"),
        )
    return F.transform(_as_array(content), dec)


def _join_parts(parts) -> Column:
    return T.strip(F.array_join(parts, "\n"))


def _string_content(s) -> Column:
    """A non-empty string content (``content or []`` turns '' into [])."""
    return s.isNotNull() & (F.length(s) > 0)


def user_text(segs, s, max_tool_chars: int) -> Column:
    """User-visible text of a user record (tool results rendered).
    ``segs`` = ``decode_segments(content)``, ``s`` = string content."""
    def part(d):
        tool = d["tool"]
        return (
            F.when(d["bare"].isNotNull(), d["bare"])
            .when(d["typ"] == F.lit("tool_result"),
                  F.when(~T.is_blank(tool), T.tool_block(tool, max_tool_chars)))
            .when(d["typ"].isin(HUMAN_TYPES), d["val"])
        )
    return F.coalesce(F.when(_string_content(s), T.strip(s)),
                      _join_parts(F.transform(segs, part)), F.lit(""))


def assistant_text(segs, s) -> Column:
    """Text segments of an assistant record."""
    def part(d):
        return F.when(d["bare"].isNotNull(), d["bare"]).when(d["typ"] == F.lit("text"), d["val"])
    return F.coalesce(F.when(_string_content(s), T.strip(s)),
                      _join_parts(F.transform(segs, part)), F.lit(""))


def human_text(segs, s) -> Column:
    """User text without tool results."""
    def part(d):
        return F.when(d["bare"].isNotNull(), d["bare"]).when(d["typ"].isin(HUMAN_TYPES), d["val"])
    return F.coalesce(F.when(_string_content(s), T.strip(s)),
                      _join_parts(F.transform(segs, part)), F.lit(""))


def has_human(segs, s) -> Column:
    """A non-empty string content, any bare string item, or a kept
    non-tool item with non-blank text."""
    hit = F.exists(segs, lambda d: d["bare"].isNotNull()
                   | (F.coalesce(d["typ"].isin(HUMAN_TYPES), F.lit(False)) & d["val"].isNotNull()))
    return F.coalesce(F.when(_string_content(s), F.lit(True)), hit, F.lit(False))


def tool_use_fallback(rec) -> Column:
    """``toolUseResult.file.content`` (non-blank string) when ``file``
    is an object, else ``toolUseResult.text`` when a string; prefixed and
    not truncated.  Null when neither applies."""
    tur = _field(rec, "toolUseResult")
    file = _field(tur, "file")
    fc = as_string(_field(file, "content"))
    tx = as_string(_field(tur, "text"))
    return F.when(
        is_object(tur),
        F.when(is_object(file),
               F.when(~T.is_blank(fc), F.concat(F.lit(K.TOOL_FALLBACK_PREFIX), fc)))
        .otherwise(F.when(tx.isNotNull(), F.concat(F.lit(K.TOOL_FALLBACK_PREFIX), tx))),
    )


def session_id(rec) -> Column:
    """sessionId, then session_id, then 'default'."""
    return F.coalesce(
        T.first_nonempty(as_string(_field(rec, "sessionId")), as_string(_field(rec, "session_id"))),
        F.lit("default"))


def record_role(rec) -> Column:
    """Message.role, else the record type."""
    msg = _field(rec, "message")
    role = F.when(is_object(msg), F.try_variant_get(msg, "$.role", "string"))
    return T.first_nonempty(role, F.try_variant_get(rec, "$.type", "string"))


def normalise(recs: DataFrame, max_tool_chars: int = K.DEFAULT_PAIR_TOOL_CHARS,
              tool_fallback: bool = True) -> DataFrame:
    """``(ord, rec)`` -> one normalised turn per record (other input
    columns pass through).

    Two projections: the first decodes the record once (role, string
    content, decoded segment array); the second derives every text from
    those columns, so no VARIANT value is walked twice.
    """
    rec = F.col("rec")
    msg = _field(rec, "message")
    content = F.when(is_object(msg), _field(msg, "content"))
    ts_raw = as_string(_field(rec, "timestamp"))
    extra = [c for c in recs.columns if c not in ("ord", "rec", "bad_json")]
    stage = recs.select(
        "ord", *extra,
        session_id(rec).alias("session_id"),
        ts_raw.alias("ts_raw"),
        F.coalesce(as_string(_field(rec, "cwd")), F.lit("")).alias("cwd"),
        record_role(rec).alias("role"),
        as_string(content).alias("_s"),
        decode_segments(content).alias("_segs"),
        (tool_use_fallback(rec) if tool_fallback else F.lit(None).cast("string")).alias("_fb"),
    )
    segs, s, role = F.col("_segs"), F.col("_s"), F.col("role")
    ut = user_text(segs, s, max_tool_chars)
    if tool_fallback:
        ut = F.when(ut == F.lit(""), F.coalesce(F.col("_fb"), F.lit(""))).otherwise(ut)
    is_user, is_asst = role == F.lit("user"), role == F.lit("assistant")
    return stage.select(
        "ord", *extra, "session_id", "ts_raw", T.parse_ts("ts_raw").alias("ts"), "cwd", "role",
        F.when(is_user, ut).otherwise(F.lit("")).alias("user_text"),
        F.when(is_asst, assistant_text(segs, s)).otherwise(F.lit("")).alias("assistant_text"),
        F.coalesce(F.when(is_user, has_human(segs, s)), F.lit(False)).alias("has_human"),
        F.when(is_user, human_text(segs, s)).otherwise(F.lit("")).alias("human_text"),
    )
