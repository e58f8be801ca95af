"""Stage source-format files from the test tables.

The scan queries need files in the formats the loaders read (latin-1 ``;``
text, fixed-width registers, sheet exports with filler rows, yearly files,
XML, JSON responses, zip archives). Each helper writes them from a table with
Spark: either a DataFrame writer, or tasks that render their own partition
(:func:`statmart.sources.files.write_partition_files`). Nothing passes through
the driver.
"""

from __future__ import annotations

import csv
import io

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statmart.sources.archives import write_zip
from statmart.sources.files import write_partition_files
from statmart.functions.columns import pad_right
from statmart.sources.fixed_width import Layout, header_line


def _csv_text(pdf: pd.DataFrame, sep: str, header: bool = True) -> str:
    buf = io.StringIO()
    pdf.to_csv(buf, sep=sep, index=False, header=header, lineterminator="\n",
               quoting=csv.QUOTE_MINIMAL)
    return buf.getvalue()


def stage_sheet_exports(df: DataFrame, root: str, filler: list[str], sep: str = ",",
                        name: str = "sheet") -> list[str]:
    """Sheet exports: header, ``filler`` lines, then the rows (one file per task)."""
    def render(pdf: pd.DataFrame, pid: int):
        text = _csv_text(pdf, sep)
        head, _, body = text.partition("\n")
        return [(f"{name}-{pid:05d}.csv", "\n".join([head, *filler, body]).encode())]
    return [r["path"] for r in write_partition_files(df, root, render).collect()]


def stage_yearly_files(df: DataFrame, root: str, year_col: str, drop_in_year: dict[int, list[str]],
                       sep: str = ";") -> list[str]:
    """``orders <year> - gemeente - p<task>.csv`` per year and task, upper-case
    headers; columns in ``drop_in_year[year]`` left out of that year's files."""
    def render(pdf: pd.DataFrame, pid: int):
        files = []
        for year, part in pdf.groupby(year_col, sort=True):
            part = part.drop(columns=[year_col] + drop_in_year.get(int(year), []))
            part.columns = [c.upper() for c in part.columns]
            files.append((f"orders {int(year)} - gemeente - p{pid:05d}.csv",
                          _csv_text(part, sep).encode()))
        return files
    return [r["path"] for r in write_partition_files(df, root, render).collect()]


def _xml_text(c) -> Column:
    """Element text of any value; null is empty."""
    t = F.coalesce(F.col(c).cast("string"), F.lit(""))
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        t = F.replace(t, F.lit(sign), F.lit(entity))
    return t


def stage_xml(df: DataFrame, root: str, record: str, id_col: str, fields: list[str],
              nested: str, nested_fields: list[str], declare_on_record_col: str) -> list[str]:
    """XML files with namespaced records ``b:<record>``; the namespace prefix
    ``b`` is declared on the root, and rows with a true ``declare_on_record_col``
    declare another prefix on the record itself."""
    def element(name: str) -> Column:
        return F.concat(F.lit(f"<b:{name}>"), _xml_text(name), F.lit(f"</b:{name}>"))

    own = F.when(F.col(declare_on_record_col), ' xmlns:d="http://example.org/d"').otherwise("")
    line = F.concat(F.lit(f"<b:{record}"), own, F.lit(' id="'), _xml_text(id_col), F.lit('">'), *map(element, fields),
                    F.lit(f"<b:{nested}>"), *map(element, nested_fields), F.lit(f"</b:{nested}></b:{record}>"))

    def render(pdf: pd.DataFrame, pid: int):
        out = ['<?xml version="1.0" encoding="UTF-8"?>',
               '<b:root xmlns:b="http://example.org/b" xmlns:c="http://example.org/c">', *pdf["line"], "</b:root>"]
        return [(f"records-{pid:05d}.xml", "\n".join(out).encode())]
    return [r["path"] for r in write_partition_files(df.select(line.alias("line")), root, render).collect()]


def fixed_cell(name: str, width: int) -> Column:
    """A value in its fixed-width column; a wider one fails the job."""
    t = F.coalesce(F.col(name).cast("string"), F.lit(""))
    return F.when(F.length(t) <= width, pad_right(t, width)).otherwise(
        F.raise_error(F.concat(F.lit(f"value wider than column {name}: "), t)))


def stage_zips(df: DataFrame, root: str, layout: Layout) -> list[str]:
    """One archive per task, all of one name in folders of their own, with a nested CSV
    member and a fixed-width TXT member whose names carry characters the name cleaner
    replaces. Archives of odd tasks have their columns in reverse order."""
    back = Layout(layout.names[::-1], [w + 3 for w in layout.widths[::-1]])
    cells = {name: F.concat(*[fixed_cell(n, w) for n, w in zip(lay.names, lay.widths)])
             for name, lay in (("__even", layout), ("__odd", back))}

    def render(pdf: pd.DataFrame, pid: int):
        lay, line = (back, "__odd") if pid % 2 else (layout, "__even")
        csv_member = _csv_text(pdf[lay.names], ",").encode()
        txt_member = ("\n".join([header_line(lay), *pdf[line]]) + "\n").encode()
        data = write_zip([(f"export data/customers (p{pid:05d}).csv", csv_member),
                          (f"fixed-width/customers%{pid:05d}.txt", txt_member),
                          ("docs/readme.md", b"customer export\n")])
        return [(f"batch {pid:05d}/customers.zip", data)]
    return [r["path"] for r in write_partition_files(df.withColumns(cells), root, render).collect()]


def stage_member_zips(df: DataFrame, root: str, by: str, layout: Layout) -> list[str]:
    """One archive per value of ``by``, with the rows as CSV and as fixed-width text, each
    next to a member of the header alone, and with an empty CSV member."""
    line = F.concat(*[fixed_cell(n, w) for n, w in zip(layout.names, layout.widths)])

    def render(pdf: pd.DataFrame, pid: int):
        out = []
        for value, part in pdf.groupby(by, sort=True):
            text = _csv_text(part[layout.names], ",")
            head = header_line(layout)
            data = write_zip([("rows.csv", text.encode()), ("head.csv", (text.split("\n")[0] + "\n").encode()), ("none.csv", b""),
                              ("lines.txt", ("\n".join([head, *part["__line"]]) + "\n").encode()),
                              ("names.txt", (head + "\n").encode())])
            out.append((f"batch {int(value):05d}/set.zip", data))
        return out
    staged = df.withColumn("__line", line).repartition(by)  # a value has a bounded number of rows
    return [r["path"] for r in write_partition_files(staged, root, render).collect()]


def envelope_pages(df: DataFrame, page_col, key: str = "value") -> DataFrame:
    """One JSON response document ``{"<key>": [...]}`` per page of rows; a page
    is a bounded group (``page_col``) so no document grows with the table."""
    cols = [c for c in df.columns]
    return (df.groupBy(page_col.alias("__page"))
              .agg(F.collect_list(F.struct(*cols)).alias(key))
              .select(F.to_json(F.struct(key)).alias("value")))
