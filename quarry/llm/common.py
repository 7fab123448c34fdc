"""Shared pieces of the operators: stored intermediates, row keys, prefix
sums and integer names that no task, group or driver holds whole."""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

#: Characters that separate words, everywhere in this subpackage.
SPACES = " \t\n\x0b\x0c\r"
#: Java pattern of one word.
WORD = r"[^\x20\x09-\x0D]+"
#: Name of the row-key column that :func:`keyed` adds.
KEY = "_row_key"
_OWN = f"{KEY}_own"


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder and
    read it back: cuts the lineage, survives lost executors, and later
    readers prune its columns."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a :func:`stash` result that nothing reads any more."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def meet(rows: DataFrame, other: DataFrame, on, how: str) -> DataFrame:
    """Whole rows joined to a narrow table by a shuffle, at every size alike:
    the plan that is tested on little data is the one that runs on much."""
    return rows.join(other.hint("shuffle_hash"), on, how)


def give_back_memory() -> None:
    """Return freed memory to the system; a Python worker is used again."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # a GNU function
    if trim:
        trim(0)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("bigint")


def columns_of(docs: DataFrame) -> list[Column]:
    """The columns of ``docs``, of itself or of a frame keyed from it."""
    return [F.col(f"`{_OWN if c == KEY else c}`").alias(c) for c in docs.columns]


def _numbers_rows(docs: DataFrame) -> bool:
    """Whether the file format of ``docs`` tells row numbers (Parquet does,
    text formats and ORC do not)."""
    try:
        return "row_index" in docs.select("_metadata.row_index").columns
    except AnalysisException:
        return False


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a column KEY that tells its rows apart, repeated rows
    and null ids included, and is the same in every later read.

    A plain read of files that number their rows is keyed by file and row
    number, so nothing is written; any other frame is stored once with
    generated numbers.  A
    column of docs by that name is set aside for :func:`columns_of`."""
    docs = docs.withColumnRenamed(KEY, _OWN) if KEY in docs.columns else docs
    relation = docs._jdf.queryExecution().analyzed().getClass().getSimpleName()
    if relation == "LogicalRelation" and "_metadata" not in docs.columns and _numbers_rows(docs):
        key = F.struct(F.xxhash64(F.col("_metadata.file_path")).alias("f"),
                       F.col("_metadata.row_index").alias("i"))
        return docs.select("*", key.alias(KEY))
    key = F.struct(F.lit(0).cast("bigint").alias("f"), F.monotonically_increasing_id().alias("i"))
    return stash(docs.select("*", key.alias(KEY)), "rows")


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before."""
    a, b = column.slice(1), column.slice(0, len(column) - 1)
    differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
    return differ | (pc.is_null(a).to_numpy(zero_copy_only=False) != pc.is_null(b).to_numpy(zero_copy_only=False))


def _running(key: list[str], value: str | None):
    """mapInArrow function over a sorted partition: number of each row and
    running sum of ``value`` within its key's run, batch by batch."""
    def run(batches):
        from pyspark import TaskContext

        pid, last, count, total = TaskContext.get().partitionId(), None, 0, 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            for k in key:
                new[1:] |= _changes(b.column(k))
            first = tuple(b.column(k)[0].as_py() for k in key)
            new[0] = first != last
            v = np.ones(n, np.int64) if value is None else b.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(new, at, -1))
            c = np.cumsum(v)
            before = np.where(start >= 0, c[start] - v[start], -total)
            idx = np.where(start >= 0, at - start, at + count)
            cum = c - before
            last, count, total = tuple(b.column(k)[n - 1].as_py() for k in key), int(idx[-1]) + 1, int(cum[-1])
            cols = [*b.columns, pa.array(np.full(n, pid, np.int64)), pa.array(idx), pa.array(cum)]
            yield pa.RecordBatch.from_arrays(cols, names=[*b.schema.names, "_pid", "_idx", "_cum"])
    return run


def prefix_sums(df: DataFrame, key: list[str], order: list, value: str | None = None,
                index: str = "idx", cum: str = "cum") -> DataFrame:
    """Add ``index`` (0-based place of the row within its key) and ``cum``
    (inclusive sum of ``value``) in ``order``, which must be total.

    The rows are range-sorted by key and order, so a hot key is split over
    many tasks; each task counts its own rows, and one small row per task
    and key carries the totals on.  ``df`` is read twice (range sampling)
    and should be narrow and stored.  Null keys form a key of their own."""
    n = partitions(df)
    cols = [*(F.col(k) for k in key), *(F.col(o) if isinstance(o, str) else o for o in order)]
    ranged = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    schema = T.StructType([*df.schema.fields, *(T.StructField(c, T.LongType()) for c in ("_pid", "_idx", "_cum"))])
    local = stash(ranged.mapInArrow(_running(key, value), schema), "prefix")
    sums = local.groupBy("_pid", *key).agg(F.max("_idx").alias("_n"), F.max("_cum").alias("_s"))
    w = Window.partitionBy(*key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stash(sums.select(
        F.col("_pid").alias("_opid"), *[F.col(k).alias(f"_o_{k}") for k in key],
        F.coalesce(F.sum(F.col("_n") + 1).over(w), F.lit(0)).alias("_on"),
        F.coalesce(F.sum("_s").over(w), F.lit(0)).alias("_os")), "offsets")
    on = F.col("_pid") == F.col("_opid")
    for k in key:
        on &= F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    return local.join(offsets, on).select(
        *df.columns, (F.col("_idx") + F.col("_on")).alias(index), (F.col("_cum") + F.col("_os")).alias(cum))


def _neighbours(key: list[str], order: list[str]):
    """mapInArrow function over a sorted partition: the rows whose key a
    neighbour shares, with the ``order`` of the one before or, for a key's
    first row, after (kind 0); the partition's first row, and its last one
    if it is alone, of which other partitions may know more (kind 1); and
    both ends of the partition (kind 2)."""
    names = ["_kind", "first", *(f"near_{o}" for o in order)]

    def rows(t, kind, first, near, known):
        size = t.num_rows
        more = [pa.array(np.full(size, kind, np.int32)), pa.array(np.broadcast_to(first, size)), *(pa.array(x, mask=~known) for x in near)]
        return pa.Table.from_arrays([*t.columns, *more], names=[*t.schema.names, *names]).combine_chunks().to_batches()

    def run(batches):
        held, before, start = None, None, True  # the last row, the row before it if of its key, whether it is the partition's first
        for b in (b for b in batches if b.num_rows):
            t = pa.Table.from_batches([b] if held is None else [*held.to_batches(), b]).combine_chunks()
            n, places = t.num_rows, [t.column(o).to_numpy() for o in order]
            if held is None:
                yield from rows(t.slice(0, 1), 2, False, [p[:1] for p in places], np.ones(1, bool))
            same = np.zeros(n + 1, bool)  # as the row before
            same[1:n] = True
            for k in key:
                same[1:n] &= ~_changes(t.column(k).chunk(0))
            same[0] = before is not None
            prev, after = same[:n], same[1:]
            near = [np.where(prev, np.append(f, p[:-1]), np.append(p[1:], f)) for p, f in zip(places, before or [p[0] for p in places], strict=True)]
            lead = (np.arange(n) == 0) & start
            out = np.arange(n) < n - 1
            for kind, pick in ((0, out & (prev | after) & ~lead), (1, out & lead)):
                at = np.flatnonzero(pick)
                if len(at):
                    yield from rows(t.take(pa.array(at)), kind, ~prev[at], [x[at] for x in near], (prev | after)[at])
            if n > 1:
                before, start = [p[-2] for p in places] if prev[-1] else None, False
            held = t.slice(n - 1, 1)
        if held is not None:
            known = np.full(1, before is not None)
            near = [np.array([x]) for x in before] if before is not None else [held.column(o).to_numpy() for o in order]
            yield from rows(held, 0 if before is not None else 1, before is None, near, known)
            yield from rows(held, 2, False, near, known)
    return run


def repeated(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The rows of ``df`` whose ``key`` occurs twice or more, with ``first``,
    whether the row is the key's first in ``order`` (whole numbers, total
    with the key), and ``near_<o>``, the order of the row of that key before
    it, for the first one of the row after it.

    One shuffle: the rows are range-sorted by key and order, so a hot key is
    split over many tasks and what is equal lies side by side.  Two small
    rows per task tell what its ends share with its neighbours.  ``df`` is
    read twice and should be narrow and stored.  Null keys are equal."""
    cols = [F.col(c) for c in (*key, *order)]
    near = [f"near_{o}" for o in order]
    fields = [*df.schema.fields, T.StructField("_kind", T.IntegerType()), T.StructField("first", T.BooleanType()),
              *(T.StructField(f"near_{o}", df.schema[o].dataType) for o in order)]
    ranged = df.repartitionByRange(partitions(df), *cols).sortWithinPartitions(*cols)
    local = stash(ranged.mapInArrow(_neighbours(key, order), T.StructType(fields)), "repeated")
    w = Window.partitionBy(*key).orderBy(*order)  # at most two rows per task of the sort
    place = F.struct(*[F.col(o).alias(n) for o, n in zip(order, near, strict=True)])
    ends = local.where("_kind = 2").select(*key, *order).distinct().select(
        *[F.col(c).alias(f"_e_{c}") for c in (*key, *order)], F.lag(place).over(w).alias("_prev"), F.lead(place).over(w).alias("_next"))
    on = F.lit(True)
    for c in (*key, *order):
        on &= F.col(c).eqNullSafe(F.col(f"_e_{c}"))
    own = F.when(F.col(near[0]).isNotNull(), F.struct(*near))
    unsure = local.where("_kind = 1").join(F.broadcast(ends), on).withColumn("_near", F.coalesce("_prev", own, "_next")).where("_near is not null") \
        .select(*df.columns, F.col("_prev").isNull().alias("first"), *[F.col(f"_near.{n}") for n in near])
    return local.where("_kind = 0").select(*df.columns, "first", *near).unionAll(unsure)


def sorted_names(df: DataFrame, cols: list[str], name: str = "name") -> DataFrame:
    """One row per distinct ``cols`` with its rank in sorted order."""
    distinct = stash(df.select(*cols).distinct(), "names")
    return stash(prefix_sums(distinct, [], cols, index=name).select(*cols, name), "named")
