"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule is a cheap or dear Boolean over measures of the text.  Rules are
tried on a bounded sample for cost and share rejected, and then run in the
order of most rejection per cost; a rejected row skips the later rules.
The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

MIN_WORDS = 50
#: Rows of the first files that the order of the rules is estimated on.
SAMPLE_ROWS = 400
_INDEX_BITS = 24


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text; splitting leaves at most empty ends."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def _repeated_by_sort(w: Column, n: Column) -> Column:
    """Positions of 3-word windows that occur twice or more, ascending:
    sorts the windows themselves."""
    at = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(
        w[i].alias("a"), w[i + 1].alias("b"), w[i + 2].alias("c"), i.cast("bigint").alias("i")))

    def same(x, y):
        return (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

    def pick(s):
        twice = F.filter(s, lambda x, j: F.coalesce(same(x, F.get(s, j - 1)), F.lit(False)) | F.coalesce(same(x, F.get(s, j + 1)), F.lit(False)))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))
    return let(F.sort_array(at), pick)


def _repeated_by_hash(w: Column, n: Column, otherwise: Callable[[], Column]) -> Column:
    """The same from a sort of numbers: high hash bits, then position.
    Windows that share the high bits but differ are seen when neighbours
    are compared word by word; such a text takes the exact sort."""
    low = (1 << _INDEX_BITS) - 1
    keys = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]).bitwiseAND(~low).bitwiseOR(i.cast("bigint")))

    def pick(s):
        def high(x):
            return F.shiftright(x, _INDEX_BITS)

        def place(x):
            return x.bitwiseAND(low).cast("int")
        near = F.filter(s, lambda x, j: F.coalesce(high(x) == high(F.get(s, j - 1)), F.lit(False)) | F.coalesce(high(x) == high(F.get(s, j + 1)), F.lit(False)))

        def verify(r):
            def differ(x, j):
                p, q = place(x), place(F.get(r, j - 1))
                return (j > 0) & (high(x) == high(F.get(r, j - 1))) & ~((w[p] == w[q]) & (w[p + 1] == w[q + 1]) & (w[p + 2] == w[q + 2]))
            clash = F.size(F.filter(r, lambda x, j: F.coalesce(differ(x, j), F.lit(False)))) > 0
            return F.when(clash, otherwise()).otherwise(F.sort_array(F.transform(r, lambda x: x.bitwiseAND(low))))
        return let(near, verify)
    return let(F.sort_array(keys), pick)


def repeat_words(w: Column) -> Column:
    """Words inside 3-word windows found twice or more in the text."""
    def count(p):
        gaps = F.transform(p, lambda x, j: F.least(F.lit(3).cast("bigint"), F.coalesce(F.get(p, j + 1) - x, F.lit(3).cast("bigint"))))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def body(v):
        n = F.size(v)
        exact = lambda: _repeated_by_sort(v, n)
        found = F.when(n < 4, F.array().cast("array<bigint>")) \
            .when(n < (1 << _INDEX_BITS), _repeated_by_hash(v, n, exact)).otherwise(exact())
        return let(found, count)
    return let(w, body)


def duplicate_lines(text: Column) -> tuple[Column, Column]:
    """Lines with a word; those equal to an earlier one."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, F.size).cast("bigint"), let(lines, lambda v: F.size(v) - F.size(F.array_distinct(v))).cast("bigint")


def measures(text: Column, w: Column) -> dict[str, Column]:
    lines, again = duplicate_lines(text)
    return {
        "n_words": F.size(w).cast("bigint"),
        "word_chars": F.char_length(F.array_join(w, "")).cast("bigint"),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("bigint"),
        "n_lines": lines,
        "n_dup_lines": again,
        "n_repeat_words": repeat_words(w),
    }


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps the measures (name -> Column) and the text to a
    Boolean Column; null rejects nothing."""

    name: str
    rejects: Callable[[dict, Column], Column]


RULES = (
    Rule("few_words", lambda m, t: m["n_words"] < MIN_WORDS),
    Rule("repeated_words", lambda m, t: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    Rule("long_words", lambda m, t: m["word_chars"] > 40 * m["n_words"]),
    Rule("short_words", lambda m, t: m["word_chars"] < 2 * m["n_words"]),
    Rule("symbols", lambda m, t: 2 * m["n_symbols"] > 3 * m["n_words"]),
    Rule("repeated_lines", lambda m, t: (m["n_lines"] >= 4) & (100 * m["n_dup_lines"] > 50 * m["n_lines"])),
    Rule("few_letters", lambda m, t: 2 * F.char_length(F.regexp_replace(t, r"\P{L}+", "")) < m["word_chars"]),
)
BASE = ("few_words", "repeated_words")


def order_rules(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS, column: str = "text") -> list[Rule]:
    """``rules`` by rejected share per second, most first, as measured on up
    to ``sample_rows`` rows of the first partitions.  Each trial takes only
    Booleans to the driver.  On an empty table the order stays."""
    base = docs.select(text_of(column).alias("t"))

    def trial(col):
        best, got = float("inf"), []
        for _ in range(2):
            began = time.perf_counter()
            got = base.select(col.alias("x")).take(sample_rows)
            best = min(best, time.perf_counter() - began)
        return best, got

    floor, rows = trial(F.octet_length("t") < 0)
    if not rows:
        return list(rules)
    m = measures(F.col("t"), words(F.col("t")))
    value = {}
    for r in rules:
        took, got = trial(F.coalesce(r.rejects(m, F.col("t")), F.lit(False)))
        value[r.name] = sum(x[0] for x in got) / len(got) / max(took - floor, 1e-3)
    return sorted(rules, key=lambda r: -value[r.name])


def rejected(rules: list[Rule], m: dict, text: Column) -> Column:
    """True if any rule rejects; later rules run only for rows that the
    earlier ones pass."""
    verdict = F.lit(False)
    for r in reversed(rules):
        verdict = F.when(F.coalesce(r.rejects(m, text), F.lit(False)), F.lit(True)).otherwise(verdict)
    return verdict


def judged(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row: doc_id, the measures, base_failed and kept.

    Null text counts as empty; a text without words has zero measures and
    fails on words.  Repeated rows are judged alike, empty input gives an
    empty result, other columns are not read."""
    t = F.col("_text")
    base = docs.select("doc_id", F.explode(F.array(text_of())).alias("_text"))
    w = base.select("*", F.explode(F.array(words(t))).alias("_words"))
    m = measures(t, F.col("_words"))
    rows = w.select("doc_id", "_text", F.explode(F.array(F.struct(*[c.alias(k) for k, c in m.items()]))).alias("m"))
    have = {k: F.col(f"m.{k}") for k in m}
    failed = F.lit(False)
    for r in rules:
        if r.name in BASE:
            failed |= r.rejects(have, t)
    rest = [r for r in order_rules(docs, rules, sample_rows) if r.name not in BASE]
    return rows.select("doc_id", *[c.alias(k) for k, c in have.items()], failed.alias("base_failed"),
                       (~failed & ~rejected(rest, have, t)).alias("kept"))


def quality_filter(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, all columns as they are."""
    t = text_of()
    ordered = order_rules(docs, rules, sample_rows)
    return docs.where(let(words(t), lambda w: ~rejected(ordered, measures(t, w), t)))
