"""Path parts as column expressions over a file listing.

They follow ``pathlib.PurePosixPath`` for the parts used in the loaders: name,
suffix (last dot, not a leading dot), stem, parent ``n`` levels up, path
relative to a base (null when outside it), suffix replacement and joining.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def last_segment(c: Column | str, sep: str = "/") -> Column:
    """Last segment of a URL or path (F7): ``a/b/c.csv`` → ``c.csv``."""
    return F.regexp_extract(_c(c), f"([^{_re(sep)}]*)$", 1)


def name(c: Column | str) -> Column:
    return last_segment(c)


def suffix(c: Column | str) -> Column:
    """``.csv`` of ``x/y.tar.csv``; empty for ``.bashrc`` and ``y.``."""
    return F.regexp_extract(name(c), r"^.+(\.[^.]+)$", 1)


def stem(c: Column | str) -> Column:
    n = name(c)
    return F.when(F.length(suffix(c)) > 0,
                  F.regexp_replace(n, r"\.[^.]+$", "")).otherwise(n)


def parent(c: Column | str, level: int = 1) -> Column:
    """Drop ``level`` trailing segments; ``.`` when nothing is left."""
    out = _c(c)
    for _ in range(level):
        out = F.when(F.instr(out, "/") > 0,
                     F.regexp_replace(out, r"/[^/]*$", "")).otherwise(F.lit("."))
        out = F.when(out == "", F.lit("/")).otherwise(out)
    return out


def relative_to(c: Column | str, base: str | Column) -> Column:
    """Path below ``base`` (null when the path is not below it)."""
    b = F.lit(base.rstrip("/")) if isinstance(base, str) else base
    col = _c(c)
    prefix = F.concat(b, F.lit("/"))
    rest = F.substr(col, F.length(prefix) + 1)
    return F.when(col.startswith(prefix), rest)


def with_suffix(c: Column | str, new_suffix: str) -> Column:
    col = _c(c)
    return F.concat(F.when(F.length(suffix(col)) > 0,
                           F.regexp_replace(col, r"\.[^./]+$", "")).otherwise(col),
                    F.lit(new_suffix))


def join_path(*parts: Column) -> Column:
    """Join path columns with ``/`` (use ``F.lit`` for constant parts)."""
    return F.concat_ws("/", *parts)


def table_id(c: Column | str) -> Column:
    """Table id of a staged file (F9): the dot-part before the suffix of the
    last path segment (``a/x.y.parquet`` → ``y``); null when there is no dot."""
    return F.try_element_at(F.split(last_segment(c), r"\."), F.lit(-2))


def _re(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch for ch in s)
