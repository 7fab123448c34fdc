"""How filters interact, whatever their order.

A row fails a set of filters, its mask.  Orders of the filters are ranked
as permutations in lexicographic order (Lehmer rank), in which all orders
with a common beginning stand in a row.  A mask is removed at a step by the
orders that begin with filters it passes and go on with one it fails, so a
mask's removals at a step are whole intervals of ranks: counts are added at
the ends of the intervals, and a prefix sum over the ranks gives every
order's removals.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, stash, text_of

#: The filters of :func:`failures`, in order of their bits.
LETTERS = "ABCDE"
#: Counts that are followed through the orders.
COUNTS = ("n", "good", "toxic")


def interval(prefix: tuple[int, ...], filters: int) -> tuple[int, int]:
    """Ranks (end exclusive) of the orders of ``filters`` filters that begin
    with ``prefix``."""
    rest, lo = list(range(filters)), 0
    for i, f in enumerate(prefix):
        lo += rest.index(f) * factorial(filters - 1 - i)
        rest.remove(f)
    return lo, lo + factorial(len(rest))


def interval_ends(filters: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, rank, sign) of the ends of all masks' removal intervals."""
    ends = []
    for mask in range(1, 2**filters):
        fails = [f for f in range(filters) if mask >> f & 1]
        passes = [f for f in range(filters) if f not in fails]
        for step in range(1, len(passes) + 2):
            for prefix in permutations(passes, step - 1):
                for f in fails:
                    lo, hi = interval((*prefix, f), filters)
                    ends += [(mask, step, lo, 1), (mask, step, hi, -1)]
    return ends


def failures(doc_id: Column, first: Column) -> Column:
    """Bit of filter E: the text has a smaller document; a null id is no
    smaller and no greater than any."""
    return F.when(doc_id.isNotNull() & first.isNull(), 16).otherwise(0)


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (part, mask, n, good, toxic): documents of each source that fail
    exactly the filters of ``mask`` (bits 0 to 4 for A to E), and those of
    them whose label is of quality 1 and toxic 1.

    A: under 50 words; B: less than 65 % distinct words; C: more than 5 %
    of A-Z; D: one of #$%&*|; E: the same text has a smaller doc_id.  Null
    texts are empty, null sources are ''.  Documents without an id fail no E
    and have no label; repeated rows count each time; of several labels of
    an id any one counts.  Empty tables give no rows, other columns are not
    read.

    Only (doc_id, source, mask, digest) is shuffled, always by doc_id, so a
    text or source that a third of all rows share is spread."""
    text = text_of()
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"),
                       F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"))
    n, different = F.size("words"), F.size(F.array_distinct("words"))
    fails = [n < 50, 100 * different < 65 * n, 100 * F.regexp_count("text", F.lit("[A-Z]")) > 5 * F.char_length("text"),
             F.col("text").rlike("[#$%&*|]")]
    mask = sum((F.when(f, 2**i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    rows = stash(rows.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")), "masks")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    told = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    known = rows.where("doc_id is not null").join(first, ["doc_id", "digest"], "left").join(told, "doc_id", "left") \
        .select("part", (F.col("mask") + failures(F.col("doc_id"), F.col("first"))).alias("mask"), "good", "toxic")
    zero = F.lit(0)
    every = known.unionAll(rows.where("doc_id is null").select("part", "mask", zero, zero))
    return every.groupBy("part", "mask").agg(F.count("*").alias("n"), *[F.sum(F.coalesce(c, zero)).cast("bigint").alias(c) for c in COUNTS[1:]])


def interactions(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Every order of the filters ``letters`` over rows (part, mask, n, good,
    toxic): per part, filter_order and step the rows kept, removed,
    redundant (fail here, removed before), unique_fails (fail this filter
    only), good_lost and toxic_lost (of the removed), and shapley (removed by
    this filter over all orders, at any step).  Zeros are included; a mask
    of 0 fails nothing; no rows give no rows.

    All orders of one part are len(letters)! x len(letters) small rows,
    whatever its number of documents."""
    spark, k = counts.sparkSession, len(letters)
    counts = stash(counts, "mask-counts")
    ends = spark.createDataFrame(interval_ends(k), "mask int, step int, rank int, sign int")
    orders = spark.createDataFrame([(r, s, "".join(p), p[s - 1]) for r, p in enumerate(permutations(letters)) for s in range(1, k + 1)],
                                   "rank int, step int, filter_order string, letter string")
    steps = F.explode(F.sequence(F.lit(1), F.lit(k)))
    ranks = F.explode(F.sequence(F.lit(0), F.lit(factorial(k) - 1)))
    zeros = counts.select("part").distinct().select("part", steps.alias("step")).select("part", "step", ranks.alias("rank"), *[F.lit(0).cast("bigint").alias(c) for c in COUNTS])
    changes = counts.join(F.broadcast(ends), "mask").where(f"rank < {factorial(k)}") \
        .select("part", "step", "rank", *[(F.col("sign") * F.col(c)).alias(c) for c in COUNTS])
    changes = changes.unionAll(zeros).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in COUNTS])
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    removed = changes.select("part", "step", "rank", *[F.sum(c).over(along).alias(c) for c in COUNTS])

    def fails(i, only=False):
        hit = F.col("mask") == 2**i if only else F.col("mask").bitwiseAND(2**i) > 0
        return F.struct(F.lit(letters[i]).alias("letter"), F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n"))
    parts = counts.groupBy("part").agg(F.sum("n").alias("total"), *[F.array(*[fails(i, only) for i in range(k)]).alias(name)
                                                                  for name, only in (("all_fails", False), ("only_fails", True))])
    of = lambda name: F.filter(name, lambda x: x["letter"] == F.col("letter"))[0]["n"]
    down = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return removed.join(F.broadcast(orders), ["rank", "step"]).join(parts, "part").select(
        "part", "filter_order", "step", (F.col("total") - F.sum("n").over(down)).alias("kept"), F.col("n").alias("removed"),
        (of("all_fails") - F.col("n")).alias("redundant"), of("only_fails").alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), F.sum("n").over(Window.partitionBy("part", "letter")).alias("shapley"))
