"""Quality cascade, de-duplication and gates.

De-duplication never uses a window over the key: a single signature may
hold a third of all rows (the same boilerplate example copied
everywhere), and a window partition cannot be split.  Instead the first
occurrence per key is found with a partial (map-side) ``min``
aggregation over stored ``(key, order)`` rows, then joined back on the
unique order, which spreads even the hottest signature over all partitions.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType, StructType

from ..functions import constants as K
from ..functions import text as T
from ..session import materialize
from .frames import once

Counter = Callable[[Column], Column]


# ------------------------------------------------------------- D1 / D2 / D4
def packed_order(df: DataFrame, order: str = "ord") -> Column:
    """The input order as one fixed-width value (a decimal) where its parts
    are whole numbers of at most 126 bits together, else as it is.  A
    minimum over a fixed-width value is a hash aggregate; one over a struct
    or a string sorts."""
    kind = df.schema[order].dataType
    width = {ByteType: 8, ShortType: 16, IntegerType: 32, LongType: 64}
    if type(kind) in width:
        return F.col(order)
    parts = kind.fields if isinstance(kind, StructType) else []
    if not parts or any(type(f.dataType) not in width for f in parts) or sum(width[type(f.dataType)] for f in parts) > 120:
        return F.col(order)
    out = F.lit(0).cast("decimal(38,0)")
    for f in parts:
        bits = width[type(f.dataType)]
        out = (out * F.lit(str(2 ** bits)).cast("decimal(38,0)")).cast("decimal(38,0)") \
            + F.col(order)[f.name].cast("decimal(38,0)") + F.lit(str(2 ** (bits - 1))).cast("decimal(38,0)")
        out = out.cast("decimal(38,0)")
    return out


#: Bits of the parts of a file row's packed order: input, file, start of the split, place in its task.
FILE_ORDER_BITS = (15, 31, 46, 33)


def _with_packed(slim: DataFrame, order: str) -> DataFrame:
    """Narrow rows with ``_o``, their order as one fixed-width value.  The
    order of rows read from files (input, path, start of the split, row)
    holds a string: the distinct paths are ranked in a table as long as the
    list of files, and rank, start and row are packed."""
    kind = slim.schema[order].dataType
    if not (isinstance(kind, StructType) and kind.fieldNames() == ["src", "path", "block", "row"]):
        return slim.withColumn("_o", packed_order(slim, order))
    o = F.col(order)
    paths = slim.select(o["path"].alias("_path")).distinct()
    ranks = paths.select("_path", (F.row_number().over(_whole().orderBy("_path")) - 1).alias("_file"))
    parts = (o["src"], F.col("_file"), o["block"], o["row"].bitwiseAND(2 ** FILE_ORDER_BITS[3] - 1))
    packed = F.lit(0).cast("decimal(38,0)")
    for part, bits in zip(parts, FILE_ORDER_BITS, strict=True):
        packed = ((packed * F.lit(str(2 ** bits)).cast("decimal(38,0)")).cast("decimal(38,0)") + part.cast("decimal(38,0)")).cast("decimal(38,0)")
    return slim.join(ranks, o["path"] == F.col("_path")).select(*slim.columns, packed.alias("_o"))


def _flag_first(slim: DataFrame, key: str, order: str) -> DataFrame:
    """``slim`` with ``_first``: whether the row is the first of its key; null
    keys are never first.  The winners join back on the unique order, which
    spreads even the hottest key over all partitions."""
    o = _with_packed(slim, order)
    firsts = o.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("_o").alias("_f")).select("_f")
    return o.join(firsts, F.col("_o") == F.col("_f"), "left") \
        .withColumn("_first", F.col("_f").isNotNull()).drop("_o", "_f")


def duplicate_flags(df: DataFrame, key: str, order: str = "ord", flag: str = "is_dup") -> DataFrame:
    """(order, key, flag): flag is true for every row that is not the first
    of its key.  One scan of ``df``, for its key and order alone; rows with
    a null key are never duplicates.  ``order`` must be unique per row."""
    slim = materialize(df.select(order, key), "keys")
    out = _flag_first(slim, key, order)
    return out.select(order, key, (~F.col("_first") & F.col(key).isNotNull()).alias(flag))


def dedupe_first(df: DataFrame, key: str, order: str = "ord",
                 flag: str = "is_dup") -> DataFrame:
    """``df`` with the flag of :func:`duplicate_flags`; the payload is read
    once more and only meets the flags."""
    flags = duplicate_flags(df, key, order, flag).select(F.col(order).alias("_ord"), flag)
    return df.join(flags, F.col(order) == F.col("_ord")).select(*[F.col(f"`{c}`") for c in df.columns], flag)


def keep_first(df: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """Only the first row per key (null keys are one key).  Keys and orders
    are aggregated alone; the payload of the winners is fetched afterwards,
    so it is never sorted."""
    first = first_flags(df, key, order).where("_first")
    return df.join(first.select("_ord"), F.col(order) == F.col("_ord"), "left_semi")


def first_flags(df: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """(``_k``, ``_ord``, ``_first``): whether :func:`keep_first` keeps the row."""
    slim = materialize(df.select(F.coalesce(key, F.lit("")).alias("_k"), F.col(order).alias("_ord")), "keys")
    return _flag_first(slim, "_k", "_ord")


# ------------------------------------------------------------------- F2
def _stage1(min_user_chars: int) -> Column:
    user = T.first_content("messages", "user")
    return (
        F.when(F.col("bad_json"), F.lit("bad_json"))
        .when(~T.has_role("messages", "assistant"), F.lit("no_assistant"))
        .when(T.is_blank(user), F.lit("no_user"))
        .when(F.length(T.strip(user)) < F.lit(min_user_chars), F.lit("short_user"))
    )


def qc_groups(df: DataFrame, min_user_chars: int = K.DEFAULT_MIN_USER_CHARS) -> DataFrame:
    """(ord, reason, n_tok): the cascade without its length rule, from one
    scan.  Only order, reason, signature and estimate of a row are stored;
    no payload is sorted or carried for rows that fall."""
    if "bad_json" not in df.columns:
        df = df.withColumn("bad_json", F.lit(False))
    staged = once(df, "_stage1", _stage1(min_user_chars))
    passed = F.col("_stage1").isNull()
    slim = materialize(staged.select(
        "ord", F.col("_stage1").alias("reason"),
        F.when(passed, T.qc_signature("messages")).alias("_sig"),
        F.when(passed, T.token_estimate("messages")).alias("n_tok")), "qc")
    out = _flag_first(slim, "_sig", "ord")
    dup = F.when(~F.col("_first") & F.col("_sig").isNotNull(), F.lit("duplicate"))
    reason = F.coalesce("reason", dup)
    return out.select("ord", reason.alias("reason"), F.when(reason.isNull(), F.col("n_tok")).alias("n_tok"))


def _reason(max_tokens: int) -> Column:
    return F.coalesce("reason", F.when(F.col("n_tok") > F.lit(max_tokens), F.lit("too_long")), F.lit("kept"))


def qc_reasons(groups: DataFrame, max_tokens: int = K.DEFAULT_MAX_TOKENS) -> DataFrame:
    """(ord, n_tok, drop_reason) of every row, from :func:`qc_groups`."""
    return groups.select("ord", "n_tok", _reason(max_tokens).alias("drop_reason"))


def with_counter(df: DataFrame, groups: DataFrame, counter: str | Counter) -> DataFrame:
    """``groups`` with the token count of a tokenizer in place of the
    estimate; it runs only on rows that survive the dedupe."""
    if counter == "char4":
        return groups
    live = df.select(F.col("ord").alias("_ord"), "messages").join(
        groups.where(F.col("reason").isNull()).select("ord"), F.col("_ord") == F.col("ord"), "left_semi")
    n = materialize(live.select("_ord", counter(F.col("messages")).alias("_n")), "tokens")
    return groups.join(n, F.col("ord") == F.col("_ord"), "left").select("ord", "reason", F.col("_n").alias("n_tok"))


def qc(df: DataFrame, min_user_chars: int = K.DEFAULT_MIN_USER_CHARS,
       max_tokens: int = K.DEFAULT_MAX_TOKENS,
       counter: str | Counter = "char4") -> DataFrame:
    """Ordered quality cascade; adds ``drop_reason`` and ``n_tok``.

    Input: ``ord`` (unique, input order), ``messages`` and optionally
    ``bad_json``.  The first failing rule names the drop: bad_json,
    no_assistant, no_user, short_user, duplicate, too_long; else kept.
    De-duplication runs on rows that passed the first four rules, before
    the length rule, so an over-long first copy still claims its
    signature.  A tokenizer counter runs only on rows that survive the
    dedupe.
    """
    groups = with_counter(df, qc_groups(df, min_user_chars), counter)
    r = qc_reasons(groups, max_tokens).withColumnRenamed("ord", "_ord")
    return df.join(r, F.col("ord") == F.col("_ord")).drop("_ord")


def qc_clean(df: DataFrame, groups: DataFrame, max_tokens: int = K.DEFAULT_MAX_TOKENS) -> DataFrame:
    """The kept rows of ``df`` with ``n_tok``; the payload is read once for
    them and never sorted."""
    kept = groups.where(F.col("reason").isNull() & (F.col("n_tok") <= F.lit(max_tokens)))
    return df.join(kept.select(F.col("ord").alias("_ord"), "n_tok"), F.col("ord") == F.col("_ord")).drop("_ord")


def qc_report(groups: DataFrame, max_tokens: int = K.DEFAULT_MAX_TOKENS, include_kept: bool = False) -> DataFrame:
    """Drop report (A1) from ``qc_groups``."""
    return drop_report(qc_reasons(groups, max_tokens), include_kept)


def clean(df: DataFrame) -> DataFrame:
    """Rows the cascade kept."""
    return df.where(F.col("drop_reason") == F.lit("kept"))


# ------------------------------------------------------------------- A1
def drop_report(df: DataFrame, include_kept: bool = False) -> DataFrame:
    """Counts per drop reason with percent of all rows read (1 decimal).
    The total comes from the same aggregate (one row per reason), so no
    second pass over the data."""
    counts = df.groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(_whole())
    out = counts.select("drop_reason", "n", F.round(F.lit(100.0) * F.col("n") / total, 1).alias("pct"))
    if not include_kept:
        out = out.where(F.col("drop_reason") != F.lit("kept"))
    return out


def _whole():
    from pyspark.sql import Window
    # un-partitioned: only ever applied to an aggregate with a handful of rows, or to the list of files
    return Window.partitionBy(F.lit(1))


# ------------------------------------------------------------------- F9
def anchor_contains(df: DataFrame, s: str, messages: str = "messages") -> DataFrame:
    """Keep rows whose first user message contains ``s`` (case-insensitive)."""
    u = T.first_content(messages, "user")
    return df.where(F.coalesce(F.contains(F.lower(F.coalesce(u, F.lit(""))), F.lower(F.lit(s))), F.lit(False)))


# ------------------------------------------------------------------- F12
def assert_no_empty(df: DataFrame, text: str = "text") -> None:
    bad = df.where(F.coalesce(F.length(text), F.lit(0)) == 0).limit(1).count()
    if bad:
        raise AssertionError(f"column {text} has empty rows")


# ------------------------------------------------------------------- F13
def keep_quality(df: DataFrame, labels: DataFrame, key: str = "doc_id",
                 min_quality: int = 1, allow_toxic: bool = False) -> DataFrame:
    """Semi-join against labels: high quality and (by default) not toxic."""
    good = labels.where(F.col("quality") >= F.lit(min_quality))
    if not allow_toxic:
        good = good.where(F.coalesce(F.col("toxic"), F.lit(0)) == F.lit(0))
    return df.join(good.select(key), key, "left_semi")


# ------------------------------------------------------------------- F14
# License classes recognised in lower-cased text, checked in this order; the
# stricter licenses come first, so a text under two is judged by those.  A
# pattern names the license in full, by its tag, or as what a text is under.
_UNDER = r"(?:under|licen[sc]ed?|released|license-identifier)(?: as| under)?:?(?: the| terms of| an?)* "
LICENSE_PATTERNS = [
    ("proprietary", r"\ball rights reserved\b|\bproprietary (?:license|software|and confidential)\b|\bunauthori[sz]ed (?:copying|use)\b"),
    ("agpl", r"\bagpl(?:[ -]?v?[0-9](?:\.[0-9])?)?\b|\bgnu affero general public license"),
    ("lgpl", r"\blgpl(?:[ -]?v?[0-9](?:\.[0-9])?)?\b|\bgnu (?:lesser|library) general public license"),
    ("cc-by-nc-4.0", r"\bcc by-nc 4\.0"),
    ("cc-by-nc", r"\bcc[ -]by-nc\b|\battribution-noncommercial"),
    ("gpl-3.0", r"\bgnu general public license,? version 3|\bgpl[ -]?v?3(?:\.0)?\b"),
    ("gpl", r"\bgpl(?:[ -]?v?[0-9](?:\.[0-9])?)?\b|\bgnu general public license"),
    ("mpl-2.0", r"\bmpl[ -]?v?2(?:\.0)?\b|\bmozilla public license"),
    ("apache-2.0", r"\bapache license,? version 2\.0|\bapache[ -]?(?:license[ -]?)?v?2(?:\.0)?\b"),
    ("mit", r"\bmit license|\b" + _UNDER + r"mit\b"),
    ("bsd", r"\bbsd (?:[0-9]-clause )?license|\bbsd[ -][0-9](?:[ -]clause)?\b|\b" + _UNDER + r"bsd\b"),
]
# Letters in one of which every class has a match; texts without any of them skip the patterns.
_LICENSE_LETTERS = ("all rights reserved", "proprietary", "unauthori", "gpl", "public license", "cc by", "cc-by", "attribution", "mpl", "apache", "mit", "bsd")
_ANY_LICENSE = "|".join(f"(?:{p})" for _, p in LICENSE_PATTERNS)
# Words that speak of a license at all; with none of the classes above the text is "unknown".
LICENSE_WORDS = ("license", "licence", "copyright", "public domain")
#: What the gate lets pass.  Neither an unknown license nor none at all is among them: what is not recognised is not allowed.
DEFAULT_ALLOWED_LICENSES = ["apache-2.0", "mit", "bsd"]


def _holds_any(c: Column, words: Sequence[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(c, F.lit(w))
    return out


def license_class(c) -> Column:
    """First license class, in order, that an already lower-cased text
    names; ``unknown`` for license words of no known class, ``none`` without
    any.  One pass finds all places that name a license; the classes are told
    from those alone."""
    low = T.col(c)
    named = F.when(_holds_any(low, _LICENSE_LETTERS), F.array_join(F.regexp_extract_all(low, F.lit(_ANY_LICENSE), F.lit(0)), "\n")).otherwise("")
    spoken = _holds_any(low, LICENSE_WORDS) | (F.contains(low, F.lit("(c) ")) & low.rlike(r"\(c\) [0-9]{4}"))

    def told(x: Column) -> Column:
        out = F.when(spoken, F.lit("unknown")).otherwise(F.lit("none"))
        for name, pat in reversed(LICENSE_PATTERNS):
            out = F.when(x.rlike(pat), F.lit(name)).otherwise(out)
        return F.when(x == "", F.when(spoken, F.lit("unknown")).otherwise(F.lit("none"))).otherwise(out)
    # a one-element list binds the places found, so the text is searched once
    return F.get(F.transform(F.array(named), told), 0)


def license_gate(df: DataFrame, text: str = "text",
                 allowed: Sequence[str] = DEFAULT_ALLOWED_LICENSES) -> DataFrame:
    """Rows whose license class is ``allowed``, with the class.  The text is
    lower-cased once and searched once."""
    low = once(df, "_low", F.lower(F.col(text)))
    return (once(low, "license", license_class("_low")).drop("_low")
            .where(F.col("license").isin(list(allowed))))


# ------------------------------------------------------------------- P27
# Personal-data and secret classes, applied in this order.
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
REDACT_PATTERNS = [
    # the look-behind starts a match only where a run of name characters does: the same matches, found in one walk
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[EMAIL]"),
    ("secret", r"""(?i)\b(?:token|api[_-]?key|secret|passwd|password)["']? ?[:=] ?(?:"[^"]*"|'[^']*'|[^ \t\r\n"',;]+)""", "[SECRET]"),
    ("key", r"\b(?:AKIA[A-Z0-9]{16}|ghp_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}|xox[bp]-[A-Za-z0-9-]{10,})\b", "[KEY]"),
    ("card", r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}", "[CARD]"),
    ("ip", rf"\b(?:{_OCTET}\.){{3}}{_OCTET}\b", "[IP]"),
    ("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "[SSN]"),
    ("phone", r"(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|\b[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}\b", "[PHONE]"),
]
# What every match of the class contains: texts without it skip the pattern
# (an exact test, not a sample).
REDACT_REQUIRES = {"email": ("@",), "key": ("AKIA", "ghp_", "sk-", "xox"), "ip": (".",), "ssn": ("-",)}


def redact(df: DataFrame, c: str = "text", classes: Sequence[str] | None = None) -> DataFrame:
    """Replace personal data and secrets, quoted or not; add ``n_<class>``
    counts and ``n_redacted``.  Counts are taken on the text as it enters
    each step.  A class is searched once, where its letters occur at all, and
    replaces only where it was found."""
    out = df
    names = []
    for name, pat, rep in REDACT_PATTERNS:
        if classes is not None and name not in classes:
            continue
        need = REDACT_REQUIRES.get(name)
        hit = _holds_any(F.col(c), need) if need else F.lit(True)
        out = out.select("*", F.when(hit, F.regexp_count(F.col(c), F.lit(pat)))
                         .otherwise(F.lit(0)).cast("bigint").alias(f"n_{name}"))
        out = out.withColumn(c, F.when(F.col(f"n_{name}") > 0, F.regexp_replace(F.col(c), pat, rep))
                             .otherwise(F.col(c)))
        names.append(f"n_{name}")
    total = F.lit(0).cast("bigint")
    for n in names:
        total = total + F.col(n)
    return out.withColumn("n_redacted", total)
