"""Tabular sheet exports.

A sheet saved as delimited text: a header line, sometimes filler lines right
under it (units, notes) to skip by line number, missing values written as
tokens such as ``.``. The scan leaves these lines out while it reads
(:mod:`statmart.sources.ranges`); the others are parsed with
``from_csv`` into text columns named by the header, tokens become null, and an
explicit lenient cast types the columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.functions.columns import SHEET_NA_TOKENS, cast_columns, null_tokens_all
from statmart.sources.files import file_key, first_lines, input_files
from statmart.sources.ranges import lines, sized_files


def _split_header(head: str, sep: str) -> list[str]:
    import csv
    return next(csv.reader([head], delimiter=sep))


def read_sheet_export(spark: SparkSession, paths: str | Sequence[str], sep: str = ",",
                      skip_rows: Iterable[int] | Mapping[str, Iterable[int]] = (),
                      na_tokens: Iterable[str] = SHEET_NA_TOKENS,
                      types: dict[str, str] | None = None, encoding: str = "utf-8") -> DataFrame:
    """Read sheet exports with a header line (line 0).

    ``skip_rows`` are 0-based file line numbers to drop (the header is line 0),
    as a sheet reader's ``skiprows`` list; a mapping gives them per file, keyed
    by a part of the file's own name, without its folder (sheets of different years differ). Blank lines
    are dropped. Files are grouped by header; the groups are aligned by column
    name. ``types`` casts columns leniently (bad → null).
    """
    files = input_files(spark, paths)
    heads = first_lines(spark, files, encoding)
    groups: dict[str, list[str]] = {}
    for f in files:
        groups.setdefault(heads[f], []).append(f)
    skip: list[tuple[str | None, list[int]]] = [(None, [0])]
    skip += [(pattern, list(nums)) for pattern, nums in skip_rows.items()] if isinstance(skip_rows, Mapping) \
        else [(None, list(skip_rows))]
    name = file_key("file")
    kept = lines(spark, sized_files(spark, paths), encoding, skip).where(F.length(F.trim("value")) > 0)
    out = None
    for head, group in groups.items():
        names = _split_header(head, sep)
        schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
        part = (kept.where(name.isin(group) if len(groups) > 1 else F.lit(True))
                    .select(F.from_csv("value", schema, {"sep": sep}).alias("r")).select("r.*"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    rows = null_tokens_all(out, list(na_tokens))
    return cast_columns(rows, types, lenient=True) if types else rows
