"""Small per-file helpers shared by the scans."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.session import local_path

# Accepted aliases of character-set names seen in the loaders.
ENCODING_ALIASES = {"8859": "ISO-8859-1", "latin1": "ISO-8859-1", "latin-1": "ISO-8859-1",
                    "iso-8859-1": "ISO-8859-1", "utf8": "UTF-8", "utf-8": "UTF-8"}


def charset(encoding: str) -> str:
    return ENCODING_ALIASES.get(encoding.lower(), encoding)


def as_list(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _open_text(path: str, encoding: str):
    from pyarrow import fs as pafs
    import io
    if "://" in path and not path.startswith("file:"):
        f, p = pafs.FileSystem.from_uri(path)
        return io.TextIOWrapper(f.open_input_stream(p), encoding=encoding, newline="")
    return open(local_path(path), encoding=encoding, newline="")


def first_lines(spark: SparkSession, files: Sequence[str], encoding: str = "UTF-8") -> dict[str, str]:
    """First line of every file, read by tasks that open each file and stop
    after one line (the file list is split over tasks)."""
    enc = charset(encoding)
    listing = spark.createDataFrame([(f,) for f in files], "path string")
    n = max(1, min(len(files), spark.sparkContext.defaultParallelism))

    def read_heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            heads = []
            for p in pdf["path"]:
                with _open_text(p, enc) as fh:
                    heads.append(fh.readline().rstrip("\r\n"))
            yield pd.DataFrame({"path": pdf["path"], "head": heads})

    rows = listing.repartition(n).mapInPandas(read_heads, "path string, head string").collect()
    return {r["path"]: r["head"] for r in rows}


def input_files(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """Data files behind ``paths`` (folders expanded, hidden files skipped),
    as plain (percent-decoded) paths that readers and tasks accept alike."""
    from urllib.parse import unquote
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                  .load(as_list(paths)).select("path").inputFiles())
    return sorted(_plain(unquote(p)) for p in found)


def _plain(p: str) -> str:
    return "file:/" + p[len("file:///"):] if p.startswith("file:///") else p


def file_key(c: str = "file"):
    """A metadata file path (a URI) in the plain form :func:`input_files` gives."""
    return F.url_decode(F.replace(F.col(c), F.lit("+"), F.lit("%2B")))  # a plus sign is no blank here


def write_partition_files(df: DataFrame, root: str,
                          render: Callable[[pd.DataFrame, int], list[tuple[str, bytes]]]) -> DataFrame:
    """Each task renders its partition (as one pandas frame) into files
    ``(relative name, bytes)`` and writes them below ``root``. File names must
    be a function of the partition id, so a retried task rewrites the same
    files. Returns ``(path, size)`` of the written files."""
    from pyspark import TaskContext
    root = root.rstrip("/")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = list(batches)
        pdf = pd.concat(frames, ignore_index=True) if frames else pd.DataFrame()
        pid = TaskContext.get().partitionId()
        out = []
        if len(pdf):
            for name, data in render(pdf, pid):
                target = f"{root}/{name}"
                _write_bytes(target, data)
                out.append((target, len(data)))
        yield pd.DataFrame(out, columns=["path", "size"])

    return df.mapInPandas(run, "path string, size long")


def filesystem(uri: str):
    """(pyarrow filesystem, path) for a URI or a local path."""
    from pyarrow import fs as pafs
    if "://" in uri and not uri.startswith("file:"):
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), local_path(uri)


def publish(uri: str, write: Callable[[object], None]) -> None:
    """Write a file from a task so that a retried or speculative attempt never
    leaves a mix of two attempts: each attempt writes its own temporary file,
    then moves it over the final name."""
    import uuid
    from pyspark import TaskContext
    f, p = filesystem(uri)
    f.create_dir(p.rsplit("/", 1)[0], recursive=True)
    ctx = TaskContext.get()
    attempt = f"{ctx.attemptNumber()}-" if ctx is not None else ""
    tmp = f"{p}.tmp-{attempt}{uuid.uuid4().hex[:8]}"
    with f.open_output_stream(tmp) as out:
        write(out)
    f.move(tmp, p)


def _write_bytes(uri: str, data: bytes) -> None:
    publish(uri, lambda out: out.write(data))
