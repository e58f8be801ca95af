"""Zip archives.

Expanding is the one step Spark has no reader for. The central directories are
read first, one task per archive; then every member is a row of its own, dealt
over tasks by (archive, member), and each task copies its members to the shared
folder. The extracted members are ordinary files, read by the distributed scans
(and split by Spark when large). An archive's folder below the source and a
member's folder inside the archive are kept, the name cleaner is applied to each
part, and two members that would get one path raise before anything is written.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from statmart.functions.names import clean_name
from statmart.sources.files import charset, filesystem, publish
from statmart.sources.listing import list_files, qualified

MEMBER_SCHEMA = "archive string, member string, path string, size long"
TASKS_PER_CORE = 8  # more files than this share tasks
_COPY_CHUNK = 8 * 1024 * 1024


def clean_member(member: str) -> str:
    """Clean every folder and the file stem of a member path."""
    parts = member.split("/")
    out = [clean_name(p) for p in parts[:-1]]
    last = parts[-1]
    stem, dot, suffix = last.rpartition(".")
    out.append(clean_name(stem) + dot + suffix if dot and stem else clean_name(last))
    return "/".join(out)


def map_files(listing: DataFrame, fn: Callable[..., Iterator[dict]], schema: str,
              n_tasks: int | None = None, columns: Sequence[str] = ("path",)) -> DataFrame:
    """Apply ``fn(*columns)`` to every row of a listing in parallel (X1); ``fn``
    yields output rows, passed on file by file. Constants reach ``fn`` by closure."""
    n = n_tasks or max(1, min(listing.count(), TASKS_PER_CORE * listing.sparkSession.sparkContext.defaultParallelism))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                rows = list(fn(*row))
                if rows:
                    yield pd.DataFrame(rows)

    return listing.select(*columns).repartition(n, *columns).mapInPandas(run, schema)


def _directory(path: str, relative: str) -> Iterator[dict]:
    """Central directory of one archive, with each member's cleaned path."""
    fs, p = filesystem(path)
    folder = "/".join(clean_name(x) for x in relative.rsplit(".", 1)[0].split("/"))
    with fs.open_input_file(p) as fh, zipfile.ZipFile(fh) as z:
        for info in z.infolist():
            if not info.is_dir():
                yield {"archive": path, "member": info.filename, "size": info.file_size,
                       "path": f"{folder}/{clean_member(info.filename)}"}


def expand_archives(spark: SparkSession, source: str, out_dir: str,
                    suffix: str = ".zip") -> DataFrame:
    """Expand every ``*.zip`` below ``source`` into ``out_dir/<its path without suffix>/``
    (S2); returns ``archive, member, path, size`` per extracted member."""
    out_root = qualified(spark, out_dir)
    listing = list_files(spark, source, suffix)
    found = f"{out_root}/_found.parquet"
    map_files(listing, _directory, MEMBER_SCHEMA, columns=("path", "relative")).write.mode("overwrite").parquet(found)
    members = spark.read.parquet(found)
    twice = members.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("member").alias("a"),
                                        F.max("member").alias("b")).where("n > 1").take(1)
    if twice:
        raise ValueError(f"several archive members would be written to {twice[0]['path']!r}: "
                         f"{twice[0]['a']!r}, {twice[0]['b']!r}")

    def expand(archive: str, member: str, path: str, size: int) -> Iterator[dict]:
        target = f"{out_root}/{path}"
        fs, p = filesystem(archive)

        def copy(dst):
            with fs.open_input_file(p) as fh, zipfile.ZipFile(fh) as z, z.open(member) as src:
                while buf := src.read(_COPY_CHUNK):
                    dst.write(buf)

        publish(target, copy)
        yield {"archive": archive, "member": member, "path": target, "size": size}

    manifest = f"{out_root}/_members.parquet"
    # Materialise once: the tasks write files, so the plan must not run twice.
    map_files(members, expand, MEMBER_SCHEMA, columns=("archive", "member", "path", "size")) \
        .write.mode("overwrite").parquet(manifest)
    return spark.read.parquet(manifest)


def list_members(spark: SparkSession, source: str, suffix: str | None = None) -> DataFrame:
    """Member names of every archive without extracting (S7); ``suffix``
    keeps e.g. only ``.xml`` members."""
    def names(path: str) -> Iterator[dict]:
        fs, p = filesystem(path)
        with fs.open_input_file(p) as fh, zipfile.ZipFile(fh) as z:
            for info in z.infolist():
                if not info.is_dir():
                    yield {"archive": path, "member": info.filename, "path": None,
                           "size": info.file_size}

    out = map_files(list_files(spark, source, ".zip"), names, MEMBER_SCHEMA)
    return out.where(F.col("member").endswith(suffix)) if suffix else out


def write_zip(files: Sequence[tuple[str, bytes]]) -> bytes:
    """Zip bytes for (member name, content) pairs (used to stage test archives)."""
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in files:
            z.writestr(name, data)
    return buf.getvalue()


def table_of(path: str, root: str) -> str:
    """Table id of a converted member: its path below ``root`` without suffix, as one word."""
    inside = path[len(root):].strip("/").rsplit(".", 1)[0]
    return re.sub(r"\W+", "_", inside).strip("_").lower()


class Converted(tuple):
    """``(table id, path, format)`` of a converted member, with the ``schema`` its header fixed."""

    schema: StructType

    def __new__(cls, table: str, path: str, fmt: str, names: Sequence[str]):
        own = super().__new__(cls, (table, path, fmt))
        own.schema = StructType([StructField(n, StringType()) for n in names])
        return own


DESCRIBED = "path string, kind string, head string, filled boolean"
LONGEST_HEAD = 1 << 20  # characters


def describe_members(members: DataFrame, encoding: str = "utf-8") -> DataFrame:
    """``path, kind, head, filled`` of every ``.csv`` and ``.txt`` member, found by tasks
    that read a member no further than its second line.

    ``head`` is the header line: the first line that is not blank (``.csv``), or the first
    one (``.txt``); null if there is none. ``filled`` says whether any row follows.
    """
    enc = charset(encoding)

    def describe(path: str, kind: str) -> Iterator[dict]:
        fs, p = filesystem(path)
        with fs.open_input_stream(p) as raw, io.TextIOWrapper(raw, encoding=enc) as text:
            head, filled = None, False
            while (line := text.readline(LONGEST_HEAD)) and not filled:
                if head is None and not line.endswith("\n") and len(line) >= LONGEST_HEAD:
                    raise ValueError(f"no header line in the first {LONGEST_HEAD} characters of {path!r}")
                if kind == "csv" and not line.strip():
                    continue
                if head is None:
                    head = line.rstrip("\r\n").removeprefix("\ufeff")
                else:
                    filled = True
        yield {"path": path, "kind": kind, "head": head, "filled": filled}

    kind = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    wanted = members.select("path", kind.alias("kind")).where(F.col("kind").isin("csv", "txt"))
    return map_files(wanted, describe, DESCRIBED, columns=("path", "kind"))


def header_names(kind: str, head: str | None, sep: str = ",") -> list[str]:
    """Column names of a header line: blank ones are numbered, repeated ones get their number behind."""
    if head is None:
        given = [""]  # an empty file: one column that nothing is known of
    elif kind == "csv":
        given = next(csv.reader([head], delimiter=sep), []) or [""]
    else:
        given = head.split() or [""]
    low = [g.lower() for g in given]
    return [f"_c{i}" if not g else f"{g}{i}" if low.count(g.lower()) > 1 else g for i, g in enumerate(given)]


def _write_empty(tables: DataFrame, sep: str) -> None:
    """One file without rows for every (path, kind, head, target): Parquet with its columns, or NDJSON."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    def write(path: str, kind: str, head: str | None, target: str) -> Iterator[dict]:
        if kind == "csv":
            none = pa.schema([(n, pa.string()) for n in header_names(kind, head, sep)]).empty_table()
            publish(f"{target}/part-00000.parquet", lambda out: pq.write_table(none, out))
        else:
            publish(f"{target}/part-00000.json", lambda out: None)
        yield {"path": target}

    map_files(tables, write, "path string", columns=("path", "kind", "head", "target")) \
        .write.format("noop").mode("overwrite").save()


def convert_members(spark: SparkSession, members: DataFrame, out_dir: str, csv_sep: str = ",",
                    encoding: str = "utf-8") -> list[Converted]:
    """Convert extracted members by suffix (S16), each to a table of its own:
    ``.csv`` to parquet, ``.txt`` (fixed width, inferred layout) to NDJSON; other
    members are left alone.

    The columns of every member are fixed from its header before rows are written, so a
    member of a header alone becomes a table with its columns and no rows, and an empty
    file one with the column ``_c0``. Members with one header line are read in one scan
    and written per member, so files with other columns or another layout never mix.
    Returns ``(table id, path, format)`` per member, with its ``schema``; one entry per
    table reaches the driver, as the catalog needs each, and each header line once.
    Two members with one table id raise.
    """
    from statmart.session import scratch_path
    from statmart.sinks.tables import NDJSON_OPTIONS
    from statmart.sources.delimited import read_delimited
    from statmart.sources.fixed_width import infer_layout, read_fixed_width

    out_dir = qualified(spark, out_dir).rstrip("/")
    found = scratch_path(spark, "described")
    describe_members(members, encoding).write.parquet(found)
    # members that are read together: of one kind and header, with rows or without
    group = F.sha2(F.to_json(F.struct("kind", "head", "filled"), {"ignoreNullFields": "false"}), 256)
    described = spark.read.parquet(found).withColumn("group", group)
    heads = {r["group"]: r for r in described.groupBy("group").agg(
        *[F.first(c).alias(c) for c in ("kind", "head", "filled")]).collect()}  # one row per header line
    paths = {r["path"]: r["group"] for r in described.select("path", "group").collect()}
    if not paths:
        return []
    folders = {p.rsplit("/", 1)[0] for p in paths}
    root = min(folders, key=len)
    while not all((f + "/").startswith(root + "/") for f in folders):
        root = root.rsplit("/", 1)[0]
    tables = {p: table_of(p, root) for p in paths}
    times = Counter(tables.values())
    twice = sorted(t for t, n in times.items() if n > 1)
    if twice:
        raise ValueError(f"several members would become one table: {twice}")
    groups: dict[str, list[str]] = {}
    for p in sorted(paths):
        groups.setdefault(paths[p], []).append(p)
    names = spark.createDataFrame([(file_uri(p), t) for p, t in tables.items()], "uri string, table string")
    if not all(h["filled"] for h in heads.values()):
        empty = described.where(~F.col("filled"))
        target = {p: f"{out_dir}/{heads[g]['kind']}-empty/table={tables[p]}" for p, g in paths.items() if not heads[g]["filled"]}
        where = spark.createDataFrame(list(target.items()), "path string, target string")
        _write_empty(empty.join(F.broadcast(where), "path"), csv_sep)  # a row per member
    out = []
    for i, (g, group_paths) in enumerate(groups.items()):
        suffix, head = heads[g]["kind"], heads[g]["head"]
        fmt = "parquet" if suffix == "csv" else "json"
        columns = header_names(suffix, head, csv_sep)
        if not heads[g]["filled"]:
            out += [Converted(tables[p], target[p], fmt, columns) for p in group_paths]
            continue
        to = f"{out_dir}/{suffix}-{i:05d}"
        if suffix == "csv":
            schema = StructType([StructField(n, StringType()) for n in columns])
            rows = read_delimited(spark, group_paths, sep=csv_sep, encoding=encoding, schema=schema)
            rows = rows.select("*", plain_uri(F.col("_metadata.file_path")).alias("__uri"))
        else:
            layout = infer_layout(spark, group_paths, header=True, encoding=encoding)
            rows = read_fixed_width(spark, group_paths, layout, header=True, encoding=encoding,
                                    parse_dates=False, file_col="__uri")
            columns = layout.names
            rows = rows.withColumn("__uri", plain_uri(F.col("__uri")))
        by = "table"
        while by in {c.lower() for c in columns}:  # a member may have a column of that name
            by += "_"
        rows = rows.join(F.broadcast(names.select(F.col("uri").alias("__uri"), F.col("table").alias(by))), "__uri").drop("__uri")
        write = rows.write.mode("overwrite").partitionBy(by)
        if suffix == "csv":
            write.parquet(to)
        else:
            write.options(**NDJSON_OPTIONS).json(to)
        out += [Converted(tables[p], f"{to}/{by}={tables[p]}", fmt, columns) for p in group_paths]
    return out


def file_uri(path: str) -> str:
    """A path in one spelling: decoded, one slash after ``file:``."""
    return re.sub(r"^file:/+", "file:/", path if "://" in path or path.startswith("file:") else "file:" + path)


def plain_uri(c):
    """A file path of Spark's metadata in the spelling of :func:`file_uri`."""
    return F.regexp_replace(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
