"""Secret scans with an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its content.
The ledger holds (blob, rule version, spans) of what was scanned before;
only unseen pairs are scanned, each blob once, and findings join back to
all paths and versions that hold the blob.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import KEY, keyed, stash, text_of

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
LEDGER = T.StructType([T.StructField("blob", T.StringType()), T.StructField("rule_version", T.StringType()),
                       T.StructField("spans", T.ArrayType(SPAN))])

#: (kind, cheap condition on the lower-cased text, pattern, measured group, its least length).
#: The first three kinds are the base, in the order that breaks ties.
RULES = (
    ("assign", ("passw", "secret", "token", "api"),
     r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", ("akia",), r"AKIA[A-Z0-9]+", 0, 20),
    # a maximal run; shorter ones would be dropped anyway
    ("hex", (), r"[0-9a-f]{24,}", 0, 24),
    ("private_key", ("private key",), r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("provider", ("gh", "xox", "aiza", "sk_live_"),
     r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|sk_live_[A-Za-z0-9]{16,})", 0, 1),
    ("jwt", ("eyj",), r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+", 0, 1),
    ("url_password", ("://",), r"[a-z][a-z0-9+]{1,30}://[^\s/:@]{1,200}:[^\s/:@]{3,200}@", 0, 1),
)
BASE = ("assign", "access", "hex")


def version_of(rules) -> str:
    """Version of a set of rules: a digest of all their parts."""
    return hashlib.sha256(repr(tuple(tuple(r) for r in rules)).encode()).hexdigest()[:16]


def spans(text: str, rules=RULES) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then rule order; per
    rule the leftmost matches that do not overlap, dropped after matching if
    their measured group is too short."""
    low = text.lower()
    found = []
    for order, (kind, needs, pattern, group, least) in enumerate(rules):
        if needs and not any(x in low for x in needs):
            continue
        for m in re.finditer(pattern, text, re.ASCII):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), order, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def _scan(rules, version: str):
    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                hits = [[{"kind": k, "start": s, "end": e} for k, s, e in spans(t or "", rules)] for t in part.column("content").to_pylist()]
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("blob"), pa.array([version] * part.num_rows, pa.string()), pa.array(hits, kind)],
                    names=["blob", "rule_version", "spans"])
    return run


def scan_versions(versions: DataFrame, ledger: DataFrame | None = None, rules=RULES,
                  rule_version: str | None = None, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(findings, additions): ``versions`` with ``blob`` and ``spans``
    (array of kind, start, end in code points), and the ledger rows that
    were missing.  Append the additions to the stored ledger; the next call
    scans only blobs, or rule versions, that it does not hold.  The version
    is a digest of the rules unless it is given, so changed rules scan again;
    ledger rows held twice, after a repeated append, count once.

    Texts move once, combined by blob before the shuffle.  Blobs without
    findings are in the ledger too, with no spans.  Null content counts as
    empty; repeated versions and paths share one scan; an empty table gives
    no rows and no additions; columns named blob or spans are replaced."""
    versions = versions.drop("blob", "spans")
    spark = versions.sparkSession
    rule_version = rule_version or version_of(rules)
    ledger = (ledger if ledger is not None else spark.createDataFrame([], LEDGER)).where(F.col("rule_version") == rule_version).dropDuplicates(["blob"])
    blobs = versions.select(F.sha2(text_of(text), 256).alias("blob"), text_of(text).alias("content"))
    unseen = blobs.groupBy("blob").agg(F.first("content").alias("content")).join(ledger, "blob", "left_anti")
    new = stash(unseen.mapInArrow(_scan(rules, rule_version), LEDGER), "ledger")
    known = new.unionByName(ledger.select(*new.columns)).where(F.size("spans") > 0) \
        .select("blob", "spans")
    paths = versions.withColumn("blob", F.sha2(text_of(text), 256))
    none = F.array().cast(T.ArrayType(SPAN))
    return paths.join(known, "blob", "left").withColumn("spans", F.coalesce("spans", none)), new


def scan_documents(docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """(doc_id, blob, spans) of every document; see :func:`scan_versions`."""
    narrow = keyed(docs).select(KEY, "doc_id", "text")
    return scan_versions(narrow, ledger)[0].select("doc_id", "blob", "spans")
