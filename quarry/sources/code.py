"""Source-file and Git-export scans."""

from __future__ import annotations

import codecs

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import constants as K

#: Bytes that one task of the source scan reads at most, one file excepted.
TASK_BYTES = 64 << 20
_PIECE = 1 << 20


# ------------------------------------------------------------------- S5
class _Files(InputPartition):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files


def _file_system(path: str):
    """(file system, path within it) of a URI or a plain path."""
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def read_head(stream, max_chars: int) -> str:
    """The first ``max_chars`` characters of a binary stream: UTF-8 decoded
    piece by piece, undecodable bytes dropped, newlines normalised.  What
    lies behind is not read."""
    decoder, out, size, held = codecs.getincrementaldecoder("utf-8")("ignore"), [], 0, False
    while size < max_chars:
        data = stream.read(_PIECE)
        text = decoder.decode(data, final=not data)
        if held:
            text = "\r" + text
        held = bool(data) and text.endswith("\r")  # its newline may follow
        text = (text[:-1] if held else text).replace("\r\n", "\n").replace("\r", "\n")
        out.append(text)
        size += len(text)
        if not data:
            break
    return "".join(out)[:max_chars]


class SourceFiles(DataSource):
    """Files below a path whose last suffix is allowed, each cut to its first
    ``max_chars`` characters: only the bytes needed for those are read, so a
    file of any size is one bounded row.  Options: ``exts`` (space-joined),
    ``max_chars``, ``max_file_bytes``, ``skip_dirs``."""

    @classmethod
    def name(cls) -> str:
        return "source_files"

    def schema(self) -> str:
        return "path string, size bigint, text string"

    def reader(self, schema) -> DataSourceReader:
        return _SourceReader(self.options)


class _SourceReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.exts = set(options.get("exts", " ".join(K.CODE_EXTENSIONS)).split())
        self.max_chars = int(options.get("max_chars", K.MAX_SOURCE_CHARS))
        self.max_bytes = int(options["max_file_bytes"]) if options.get("max_file_bytes") else None
        self.skip = set(options.get("skip_dirs", "").split())

    def _wanted(self, path: str, size: int) -> bool:
        name = path.rpartition("/")[2]
        dot = name.rfind(".")
        return (dot > 0 and name[dot:].lower() in self.exts and (self.max_bytes is None or size <= self.max_bytes)
                and not self.skip.intersection(path.split("/")))

    def partitions(self) -> list[_Files]:
        """Files dealt to tasks by the bytes that will be read of them."""
        from pyarrow import fs

        system, path = _file_system(self.path)
        info = system.get_file_info(path)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(path, recursive=True))
        tasks, size = [[]], 0
        for f in sorted(found, key=lambda f: f.path):
            if f.type != fs.FileType.File or not self._wanted(f.path, f.size):
                continue
            need = min(f.size, 4 * self.max_chars + _PIECE)
            if tasks[-1] and size + need > TASK_BYTES:
                tasks.append([])
                size = 0
            tasks[-1].append((f.path, f.size))
            size += need
        return [_Files(t) for t in tasks]

    def read(self, partition: _Files):
        system, _ = _file_system(self.path)
        for path, size in partition.files:
            with system.open_input_stream(path) as stream:
                yield path, size, read_head(stream, self.max_chars)


def read_code(spark: SparkSession, path, exts=K.CODE_EXTENSIONS,
              max_chars: int = K.MAX_SOURCE_CHARS,
              max_file_bytes: int | None = None,
              skip_dirs: bool = False) -> DataFrame:
    """Source files whose last suffix (lower-cased) is allowed: ``path`` (the
    plain path) and ``text``.

    Of each file only the bytes of its first ``max_chars`` characters are
    read and decoded, undecodable bytes dropped and newlines normalised
    (universal newlines), so a huge file costs no more than another.
    ``max_file_bytes`` skips giant files by their size.  The original FIM walk
    does not apply the directory skip list (it reads ``node_modules`` and
    hidden folders); ``skip_dirs=True`` applies it."""
    spark.dataSource.register(SourceFiles)
    reader = spark.read.format("source_files").option("exts", " ".join(exts)).option("max_chars", str(max_chars))
    if max_file_bytes is not None:
        reader = reader.option("max_file_bytes", str(max_file_bytes))
    if skip_dirs:
        reader = reader.option("skip_dirs", " ".join(K.SKIP_DIRS))
    return reader.load(path).select("path", "text")


# ------------------------------------------------------------------- S6
COMMIT_COLUMNS = {"repo": "string", "sha": "string", "parents": "array<string>", "message": "string", "n_files": "int", "n_lines": "int",
                  "refs": "array<string>"}


def _table(spark: SparkSession, path, fmt: str, columns: dict[str, str]) -> DataFrame:
    """An exported table whose ``columns`` must be there; they get their
    types, others stay."""
    df = spark.read.format(fmt).load(path)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} (has {', '.join(df.columns)})")
    return df.withColumns({c: F.col(c).cast(t) for c, t in columns.items() if dict(df.dtypes)[c] != t})


def read_commits(spark: SparkSession, path, fmt: str = "parquet") -> DataFrame:
    """Exported commits: repo, sha, parents array<string>, message, n_files,
    n_lines, refs array<string> (and optionally committed_at)."""
    return _table(spark, path, fmt, COMMIT_COLUMNS)


def read_diffs(spark: SparkSession, path, fmt: str = "parquet") -> DataFrame:
    """Exported unified diffs: sha, diff (3 context lines), optionally repo."""
    return _table(spark, path, fmt, {"sha": "string", "diff": "string"})


def read_git_log(spark: SparkSession, path, repo: str) -> DataFrame:
    """Commits with their diffs from the text of ``git log -p --parents
    --decorate=short --date=iso-strict``: the columns of
    :func:`read_commits` with ``committed_at``, ``author`` and ``diff`` (null
    where the log shows none).

    A record begins at a line ``commit <sha>``; in messages and diffs every
    line is indented or marked, so none looks like it.  The scan splits files
    at those lines: a large log is read by many tasks, and a commit that
    spans two splits is read whole by the first.  All parts come from one
    pass over the record.  Files of one log may be cut anywhere between
    commits."""
    rec = F.col("value")
    rows = spark.read.option("lineSep", "\ncommit ").text(path).select(
        F.regexp_replace("value", r"\A\s*(?:commit )?", "").alias("value"))
    rows = rows.where(rec.rlike(r"\A[0-9a-f]{40,64}\b|\A[0-9a-f]{32}\b"))
    head = F.substring_index(rec, "\n", 1)
    # the header ends at the first empty line, the message at the first diff
    gap = F.instr(rec, "\n\n")
    body = F.when(gap > 0, F.substr(rec, gap + 2)).otherwise("")
    at = F.regexp_instr(F.concat(F.lit("\n"), body), F.lit(r"\ndiff --(?:git|cc|combined) "))
    message = F.when(at > 0, F.substr(body, F.lit(1), at - 1)).otherwise(body)
    diff = F.when(at > 0, F.substr(body, at))
    parts = rows.select(head.alias("head"), F.regexp_extract(rec, r"(?m)^Author:\s*(.*)$", 1).alias("author"),
                        F.regexp_extract(rec, r"(?m)^(?:Commit)?Date:\s*(.*)$", 1).alias("_at"),
                        F.regexp_replace(F.regexp_replace(message, r"(?dm)^ {4}", ""), r"\n+\z", "").alias("message"), diff.alias("diff"))
    names = F.split(F.regexp_extract("head", r"\A([0-9a-f ]+)", 1), " +")
    names = F.filter(names, lambda x: x != "")
    refs = F.filter(F.split(F.regexp_replace(F.regexp_extract("head", r"\((.*)\)", 1), "HEAD -> ", ""), ", "),
                    lambda x: (x != "") & ~x.startswith("tag: ") & (x != "HEAD"))
    lines = F.regexp_replace(F.concat(F.lit("\n"), F.coalesce("diff", F.lit(""))), r"\ndiff --git [^\n]*(?:\n(?!@@|diff --git )[^\n]*+)*+", "\n")
    return parts.select(
        F.lit(repo).alias("repo"), F.get(names, 0).alias("sha"), F.slice(names, 2, F.greatest(F.size(names) - 1, F.lit(0))).alias("parents"),
        "message", F.regexp_count(F.concat(F.lit("\n"), F.coalesce("diff", F.lit(""))), F.lit(r"\ndiff --git ")).alias("n_files"),
        F.regexp_count(lines, F.lit(r"\n[+-]")).alias("n_lines"), refs.alias("refs"), "author",
        F.try_to_timestamp("_at").alias("committed_at"), "diff")
