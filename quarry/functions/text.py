"""Column-level text functions.

All of these return ``Column`` expressions built from Spark built-ins, so
they compose inside ``select``/``where`` and stay inside whole-stage
codegen.  Arguments accept a column name or a ``Column``.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

ColumnOrName = "Column | str"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------- P1
_STRIP_RE = r"\A" + K.JAVA_SPACE_CLASS + r"+|" + K.JAVA_SPACE_CLASS + r"+\z"
_LSTRIP_RE = r"\A" + K.JAVA_SPACE_CLASS + r"+"
_END_SPACE = "(?U)" + K.JAVA_SPACE_CLASS


def strip(c) -> Column:
    """Python ``str.strip()``: Unicode White_Space plus U+001C..U+001F.

    ``F.trim`` only removes ASCII space, so it is not used.  The regex runs
    only when the first or last character is whitespace; otherwise strip is
    the identity, which is the usual case for log lines and message text.
    """
    x = col(c)
    ends = F.substring(x, 1, 1).rlike(_END_SPACE) | F.substring(x, -1, 1).rlike(_END_SPACE)
    return F.when(ends, F.regexp_replace(x, "(?U)" + _STRIP_RE, "")).otherwise(x)


def lstrip(c) -> Column:
    """Python ``str.lstrip()``; the regex runs only when the first
    character is whitespace."""
    x = col(c)
    return F.when(F.substring(x, 1, 1).rlike(_END_SPACE),
                  F.regexp_replace(x, "(?U)" + _LSTRIP_RE, "")).otherwise(x)


def is_blank(c) -> Column:
    """True when the value is null or only whitespace.  A search for the
    first non-space character: stops at once on ordinary text instead of
    rewriting the whole string."""
    return F.coalesce(~col(c).rlike("(?U)[^" + K.JAVA_SPACE_CLASS[1:-1] + "]"), F.lit(True))


def nonblank_or_null(c) -> Column:
    return F.when(~is_blank(c), col(c))


# --------------------------------------------------------------------- P5
def tool_block(c, max_chars: int) -> Column:
    """Render a tool result: marker prefix, cut at ``max_chars`` (prefix
    included) followed by a truncation note."""
    txt = F.concat(F.lit(K.TOOL_RESULT_PREFIX), col(c))
    return F.when(
        F.length(txt) > F.lit(max_chars),
        F.concat(F.substring(txt, 1, max_chars), F.lit(K.TOOL_TRUNCATED_SUFFIX)),
    ).otherwise(txt)


# --------------------------------------------------------------------- P7
def first_nonempty(*cols) -> Column:
    """``a or b or ...``: empty strings count as missing."""
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in cols])


# --------------------------------------------------------------------- P8
_COMMON_TS = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T(?:[01][0-9]|2[0-3]):[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?(?:Z|[+-][0-9]{2}:[0-9]{2})$"
_ANY_TS = (r"(?s)^([0-9]{4})(-?)([0-9]{2})\2([0-9]{2})"
           r"(?:.([01][0-9]|2[0-3])(?:(:?)([0-9]{2})(?:\6([0-9]{2})(?:[.,]([0-9]+))?)?)?(Z|[+-][0-9]{2}(?::?[0-9]{2}(?::?[0-9]{2})?)?)?)?$")


def parse_ts(c) -> Column:
    """ISO-8601 date, or date and time, to TIMESTAMP; anything else is null
    (no bare years, months or times, no padding).  Extended and compact
    forms, any one character between date and time, ``Z`` and offsets are
    accepted; a value without an offset counts as UTC whatever the session
    zone.  Week dates are not."""
    x = col(c)

    def part(i, default):
        return F.coalesce(F.nullif(F.regexp_extract(x, _ANY_TS, i), F.lit("")), F.lit(default))
    offset = F.regexp_replace(F.regexp_replace(part(10, "Z"), ":", ""), r"^([+-][0-9]{2})([0-9]{2})?([0-9]{2})?$", "$1:$2:$3")
    offset = F.regexp_replace(F.regexp_replace(offset, r"^([+-][0-9]{2})::$", "$1:00"), ":$", "")
    full = F.concat(part(1, ""), F.lit("-"), part(3, ""), F.lit("-"), part(4, ""), F.lit("T"), part(5, "00"), F.lit(":"), part(7, "00"),
                    F.lit(":"), part(8, "00"), F.lit("."), part(9, "0"), offset)
    return F.when(x.rlike(_COMMON_TS), F.try_to_timestamp(x)).when(x.rlike(_ANY_TS), F.try_to_timestamp(full))


# --------------------------------------------------------------------- P9
def first_content(messages, role: str) -> Column:
    """Content of the first message with exactly this role (or null)."""
    first = F.get(F.filter(col(messages), lambda m: m["role"] == F.lit(role)), 0)
    return first["content"]


def has_role(messages, role: str) -> Column:
    return F.coalesce(F.exists(col(messages), lambda m: m["role"] == F.lit(role)), F.lit(False))


# ------------------------------------------------------------- P10 / P11
def qc_signature(messages) -> Column:
    """md5 of ``lower(strip(role)):strip(content)`` lines, lower-cased whole."""
    lines = F.transform(
        col(messages),
        lambda m: F.concat(
            F.lower(strip(F.coalesce(m["role"], F.lit("")))),
            F.lit(":"),
            strip(F.coalesce(m["content"], F.lit(""))),
        ),
    )
    return F.md5(F.lower(F.array_join(lines, "\n")))


def merge_signature(messages) -> Column:
    """md5 of ``lower(role):strip(content)`` lines; case of content kept."""
    lines = F.transform(
        col(messages),
        lambda m: F.concat(
            F.lower(F.coalesce(m["role"], F.lit(""))),
            F.lit(":"),
            strip(F.coalesce(m["content"], F.lit(""))),
        ),
    )
    return F.md5(F.array_join(lines, "\n"))


# --------------------------------------------------------------------- P12
def render_chat(messages, generation_prompt: bool = False,
                default_system: str | None = None,
                start: str = K.IM_START, end: str = K.IM_END) -> Column:
    """ChatML-style rendering: ``<start>role\\ncontent<end>\\n`` per turn."""
    m = col(messages)
    if default_system is not None:
        sys_msg = F.array(F.struct(F.lit("system").alias("role"), F.lit(default_system).alias("content")))
        m = F.when(F.get(m, 0)["role"] == F.lit("system"), m).otherwise(F.concat(sys_msg, m))
    body = F.array_join(
        F.transform(
            m,
            lambda x: F.concat(
                F.lit(start), F.coalesce(x["role"], F.lit("")), F.lit("\n"),
                F.coalesce(x["content"], F.lit("")), F.lit(end), F.lit("\n"),
            ),
        ),
        "",
    )
    if generation_prompt:
        body = F.concat(body, F.lit(start + "assistant\n"))
    return body


# --------------------------------------------------------------------- P13
def train_text(text, messages, **render_kw) -> Column:
    """``text`` when non-empty, else the rendered ``messages``."""
    return F.coalesce(F.nullif(col(text), F.lit("")), render_chat(messages, **render_kw))


# --------------------------------------------------------------------- P14
def joined_content(messages) -> Column:
    return F.array_join(F.transform(col(messages), lambda m: F.coalesce(m["content"], F.lit(""))), "\n")


def token_estimate(messages) -> Column:
    """``int(len('\\n'.join(contents)) / 4)``; Spark length counts code points."""
    return F.floor(F.length(joined_content(messages)) / F.lit(4)).cast("bigint")


def text_token_estimate(c) -> Column:
    return F.floor(F.length(col(c)) / F.lit(4)).cast("bigint")


def clip_estimate(c, cap: int) -> Column:
    """Longest prefix whose char estimate is <= cap (P16 with char4)."""
    return F.substring(col(c), 1, cap * 4 + 3)


# ---------------------------------------------------------- P17 / P18 / P19
def lf(c) -> Column:
    """CRLF and lone CR to LF."""
    return F.regexp_replace(col(c), "\r\n?", "\n")


def last_n(c, n: int) -> Column:
    """Python ``s if len(s) <= n else s[-n:]`` (n <= 0 follows slicing)."""
    if n > 0:
        return F.when(F.length(col(c)) <= F.lit(n), col(c)).otherwise(F.right(col(c), F.lit(n)))
    if n == 0:
        return col(c)
    return F.when(F.length(col(c)) <= F.lit(n), col(c)).otherwise(F.substr(col(c), F.lit(-n + 1)))


_LINE_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def subject(c) -> Column:
    """First line of the stripped message (Python ``splitlines`` breaks),
    stripped.  Only leading whitespace has to go before the split: trailing
    whitespace is either past the first break or removed by the final strip,
    so the whole message is never rewritten."""
    return strip(F.get(F.split(lstrip(col(c)), _LINE_BREAKS, 2), 0))


# ---------------------------------------------------------- P23 / P24
def extract_assistant(c, tag: str = K.ASSISTANT_TAG, end: str = K.IM_END) -> Column:
    """Text after the last assistant tag, cut at the end tag, left-stripped.
    Text without the tag is returned unchanged."""
    seg = F.substring_index(col(c), tag, -1)
    seg = F.substring_index(seg, end, 1)
    return F.when(F.instr(col(c), tag) > 0, lstrip(seg)).otherwise(col(c))


def strip_tool_markers(c, markers: Iterable[str] = K.TOOL_MARKERS) -> Column:
    """Cut at each marker in list order (keep what precedes it)."""
    out = col(c)
    for mk in markers:
        out = F.substring_index(out, mk, 1)
    return out


# ---------------------------------------------------------- P25 / P26
def preview(c, n: int) -> Column:
    """Collapse whitespace; if longer than ``n`` cut at a word boundary and
    append `` …`` so the total stays within ``n``.  A word may also be cut
    after a hyphen that stands between letters; when not even a part of the
    first word fits, ``…`` is left."""
    collapsed = strip(F.regexp_replace(F.coalesce(col(c), F.lit("")), "(?U)" + K.JAVA_SPACE_CLASS + "+", " "))
    keep = max(n - 2, 0)
    # the longest head that ends before a space, at the end, after a hyphen between
    # letters, or on either side of a dash of several hyphens
    brk = (r"(?:(?<=\p{L}{2}-)|(?<=\p{L}-\p{L}-))(?=\p{L}-?\p{L})|(?<=[\w!\"'&.,?])(?=-{2,}\w)|(?<=[\w!\"'&.,?]-{2,9})(?=\w)")
    head = F.regexp_extract(collapsed, r"(?U)^(.{0," + str(keep) + r"})(?:(?= |$)|" + brk + ")", 1)
    cut = F.when(head == F.lit(""), F.lit("…")).otherwise(F.concat(head, F.lit(" …")))
    return F.when(F.length(collapsed) <= F.lit(n), collapsed).otherwise(cut)


def turns(messages) -> Column:
    return F.size(col(messages)).cast("bigint")


def extra_turns(messages) -> Column:
    return F.greatest(F.lit(0), F.size(col(messages)) - F.lit(3)).cast("bigint")


# ---------------------------------------------------------- F4 / F6
def intentful(c) -> Column:
    """Non-blank, no 'boring' word, and an intent stem anywhere.  Both
    patterns give the same answer on the stripped and the raw message
    (whitespace is never part of a match and is itself a word boundary),
    so the message is not rewritten."""
    msg = col(c)
    return (
        ~is_blank(msg)
        & ~msg.rlike("(?iu)" + K.BORING_PATTERN)
        & msg.rlike("(?iu)" + K.INTENT_PATTERN)
    )


def path_suffix(c) -> Column:
    """``pathlib`` suffix of the last path part (``.png`` alone has none)."""
    name = F.regexp_extract(F.regexp_replace(col(c), "/+$", ""), r"([^/]*)$", 1)
    return F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)


def skip_path(c, skip_dirs=K.SKIP_DIRS, skip_ext=K.SKIP_EXTENSIONS,
              vendor=K.VENDOR_FILE_PATTERN, full_suffix: bool = False) -> Column:
    """Path gate: a skipped directory among the parts, a skipped last
    extension, or a lock-file name.  By default only the last suffix is
    compared (so ``.min.js`` in the list never matches, as originally);
    ``full_suffix=True`` also compares every multi-dot ending."""
    parts = F.split(col(c), "/")
    in_dir = F.arrays_overlap(parts, F.array(*[F.lit(d) for d in skip_dirs]))
    bad_ext = F.lower(path_suffix(c)).isin(list(skip_ext))
    if full_suffix:
        name = F.lower(F.regexp_extract(F.regexp_replace(col(c), "/+$", ""), r"([^/]*)$", 1))
        multi = [e for e in skip_ext if e.count(".") > 1]
        for e in multi:
            bad_ext = bad_ext | (name.endswith(e) & (F.length(name) > F.lit(len(e))))
    vendor_hit = col(c).rlike("(?i)" + vendor)
    return F.coalesce(in_dir, F.lit(False)) | bad_ext | vendor_hit
