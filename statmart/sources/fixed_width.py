"""Fixed-width text scans.

Every line is cut with ``substring`` per column and trimmed; columns stay text
until an explicit cast step. With ``header=True`` the first line of every file
is dropped by its exact line number, so a large file is still split over many
tasks.

Layout inference (S4) is one aggregation over all lines: for every character
position "is any line non-blank here" (bit masks OR-ed with ``bit_or``), then
maximal runs of such positions are columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.functions.columns import parse_date, trim_all
from statmart.sources.files import as_list, charset, first_lines, input_files
from statmart.sources.ranges import lines, sized_files

# Field separator for writing whole lines through the CSV writer (which puts
# the header line at the top of every file): never present in register text.
_LINE_SEP = "\u0001\u0002\u0003"


@dataclass(frozen=True)
class Layout:
    names: Sequence[str]
    widths: Sequence[int]
    date_cols: Sequence[str] = field(default_factory=tuple)

    def __post_init__(self):
        if len(self.names) != len(self.widths):
            raise ValueError(f"{len(self.names)} names for {len(self.widths)} widths")

    def to_json(self) -> str:
        """Store an inferred layout so later reads skip the inference pass."""
        import json
        return json.dumps({"names": list(self.names), "widths": list(self.widths),
                           "date_cols": list(self.date_cols)})

    @staticmethod
    def from_json(text: str) -> "Layout":
        import json
        d = json.loads(text)
        return Layout(d["names"], d["widths"], d.get("date_cols", []))

    @property
    def starts(self) -> list[int]:
        out, pos = [], 1
        for w in self.widths:
            out.append(pos)
            pos += w
        return out


def read_lines(spark: SparkSession, paths: str | Sequence[str], header: bool = False,
               encoding: str = "utf-8", keep_file: bool = False) -> DataFrame:
    """Whole lines as ``value``, with ``file`` if ``keep_file``; ``header`` drops the first line of every file
    while it is read (see :mod:`statmart.sources.ranges`)."""
    if not header:
        r = spark.read.option("encoding", charset(encoding)) if charset(encoding) != "UTF-8" \
            else spark.read
        raw = r.text(as_list(paths))
        return raw.select("value", F.col("_metadata.file_path").alias("file")) if keep_file else raw
    kept = lines(spark, sized_files(spark, paths), encoding, skip=[(None, [0])])
    return kept.select("value", *(["file"] if keep_file else []))


def cut(lines: DataFrame, layout: Layout, parse_dates: bool = True, *extra: Column) -> DataFrame:
    """Cut ``value`` into the layout's columns (S3, P11, F5, F6), ``extra`` columns after them."""
    cols = []
    for name, start, width in zip(layout.names, layout.starts, layout.widths):
        text = F.nullif(trim_all(F.substring("value", start, width)), F.lit(""))
        if parse_dates and name in layout.date_cols:
            text = parse_date(text, "ddMMyyyy", pad_to=8)
        cols.append(text.alias(name))
    return lines.select(*cols, *extra)


def read_fixed_width(spark: SparkSession, paths: str | Sequence[str], layout: Layout,
                     header: bool = False, encoding: str = "utf-8",
                     parse_dates: bool = True, file_col: str | None = None) -> DataFrame:
    """Fixed-width scan with a known layout (S3). Every record is kept; ``file_col``
    adds the file each came from."""
    lines = read_lines(spark, paths, header, encoding, keep_file=file_col is not None)
    return cut(lines, layout, parse_dates, *([F.col("file").alias(file_col)] if file_col else []))


_WORD = 63        # positions per aggregated word (bits of a positive BIGINT)
_FIRST_WORDS = 8  # words computed with the longest line in the first pass (504 positions)


def _word_aggs(first: int, last: int) -> list:
    mask = F.regexp_replace(F.regexp_replace("value", r"\S", "1"), r"\s", "0")
    return [F.bit_or(F.conv(F.rpad(F.substring(mask, w * _WORD + 1, _WORD), _WORD, "0"), 2, 10)
                     .cast("bigint")).alias(f"w{w}") for w in range(first, last)]


def infer_spans(lines: DataFrame) -> list[tuple[int, int]]:
    """Column spans (1-based start, width) from the non-blank positions of
    every line. Each line becomes a 0/1 mask; each 63-position slice of the
    mask is read as a binary number and OR-ed over all lines (``bit_or``), so
    only ceil(longest line / 63) small aggregates are kept. Lines up to 504
    characters need one pass; longer lines one more pass for the rest."""
    first = lines.agg(F.max(F.length("value")).alias("max_len"), *_word_aggs(0, _FIRST_WORDS)).first()
    max_len = first["max_len"] or 0
    if max_len == 0:
        return []
    n_words = (max_len + _WORD - 1) // _WORD
    words = {f"w{w}": first[f"w{w}"] for w in range(min(n_words, _FIRST_WORDS))}
    if n_words > _FIRST_WORDS:
        rest = lines.agg(*_word_aggs(_FIRST_WORDS, n_words)).first()
        words.update({f"w{w}": rest[f"w{w}"] for w in range(_FIRST_WORDS, n_words)})
    bits = "".join(format(words[f"w{w}"] or 0, f"0{_WORD}b") for w in range(n_words))[:max_len]
    spans, start = [], None
    for p, bit in enumerate(bits, start=1):
        if bit == "1" and start is None:
            start = p
        elif bit == "0" and start is not None:
            spans.append((start, p - start))
            start = None
    if start is not None:
        spans.append((start, max_len + 1 - start))
    return spans


def infer_layout(spark: SparkSession, paths: str | Sequence[str], header: bool = True,
                 encoding: str = "utf-8") -> Layout:
    """Find the layout of fixed-width files (S4); header names from the first
    line of the first file, else ``col_<i>``. Store the result to skip this
    pass on later reads."""
    lines = read_lines(spark, paths, header=False, encoding=encoding)
    spans = infer_spans(lines)
    widths = [w for _, w in spans]
    # A column runs up to the next one, so gaps stay inside the left column.
    starts = [s for s, _ in spans]
    widths = [starts[i + 1] - starts[i] for i in range(len(starts) - 1)] + widths[-1:]
    if starts and starts[0] > 1:
        widths[0] += starts[0] - 1
        starts[0] = 1
    if header:
        files = input_files(spark, paths)
        head = first_lines(spark, files[:1], encoding)[files[0]]
        names = [head[s - 1:s - 1 + w].strip() or f"col_{i}"
                 for i, (s, w) in enumerate(zip(starts, widths))]
    else:
        names = [f"col_{i}" for i in range(len(spans))]
    return Layout(names, widths)


def read_fixed_width_inferred(spark: SparkSession, paths: str | Sequence[str],
                              header: bool = True, encoding: str = "utf-8") -> DataFrame:
    """Infer the layout, then scan as S3."""
    layout = infer_layout(spark, paths, header, encoding)
    return read_fixed_width(spark, paths, layout, header=header, encoding=encoding,
                            parse_dates=False)


def to_fixed_width_lines(df: DataFrame, layout: Layout, right_align: Sequence[str] = ()) -> DataFrame:
    """Render rows as fixed-width lines (``value``); text longer than its
    width is an error, not silently cut."""
    parts, checks = [], []
    for name, width in zip(layout.names, layout.widths):
        v = F.coalesce(F.col(name).cast("string"), F.lit(""))
        checks.append(F.length(v) <= width)
        parts.append(F.lpad(v, width, " ") if name in right_align else F.rpad(v, width, " "))
    ok = checks[0]
    for c in checks[1:]:
        ok = ok & c
    line = F.when(ok, F.concat(*parts)).otherwise(F.raise_error(F.lit("value wider than its column")))
    return df.select(line.alias("value"))


def header_line(layout: Layout) -> str:
    """Column names in their columns; a name wider than its column raises."""
    wide = [n for n, w in zip(layout.names, layout.widths) if len(n) > w]
    if wide:
        raise ValueError(f"column names wider than their columns: {wide}")
    return "".join(n.ljust(w) for n, w in zip(layout.names, layout.widths))


def write_fixed_width(df: DataFrame, path: str, layout: Layout, header: bool = True,
                      right_align: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write fixed-width text; with ``header`` every file starts with the names."""
    lines = to_fixed_width_lines(df, layout, right_align)
    if not header:
        lines.write.mode(mode).text(path)
        return
    safe = F.when(~F.col("value").contains(_LINE_SEP), F.col("value")).otherwise(
        F.raise_error(F.lit("line holds the writer's field separator")))
    (lines.select(safe.alias(header_line(layout)))
          .write.mode(mode).option("header", True).option("sep", _LINE_SEP)
          .option("quote", "").option("escape", "").option("quoteAll", False)
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
          .csv(path))


# The six health-care register layouts (column names, widths,
# ddMMyyyy date columns).
REGISTER_LAYOUTS = {
    "zorgverlener": Layout(
        ["aanduiding_oud", "bestandcode", "zorgverlenersoort", "zorgverlenernummer", "naam",
         "voorletters", "voorvoegsels", "adelijke_titel", "academische_titel", "straat",
         "huisnummer", "huisnummer_toev", "postcode", "plaatsnaam", "telefoonnummer",
         "geboortedatum", "geslacht", "datum_aanvang_beroep", "datum_einde_beroep",
         "verbijzondering_zvlsrt", "reserve"],
        [1, 2, 2, 6, 25, 6, 10, 2, 3, 24, 5, 5, 6, 24, 11, 8, 1, 8, 8, 2, 97],
        ["geboortedatum", "datum_aanvang_beroep", "datum_einde_beroep"]),
    "specialist": Layout(
        ["aanduiding_oud", "bestandcode", "zorgverlenersoort", "zorgverlenernummer",
         "indicatie_hoogleraar", "reden_einde_beroep", "reserve"],
        [1, 2, 2, 6, 1, 1, 143]),
    "zorgverlener_praktijk": Layout(
        ["aanduiding_oud", "bestandcode", "zorgverlenersoort", "zorgverlenernummer",
         "praktijknummer", "datum_toetreding_praktijk", "datum_uittreding_praktijk",
         "status_in_de_praktijk", "leeg", "praktijksoort", "reserve"],
        [1, 2, 2, 6, 5, 8, 8, 1, 1, 2, 220],
        ["datum_toetreding_praktijk", "datum_uittreding_praktijk"]),
    "praktijk": Layout(
        ["aanduiding_oud", "bestandcode", "zorgverlenersoort", "praktijknummer", "naam",
         "telefoonnummer", "datum_aanvang_praktijk", "datum_einde_praktijk", "filler",
         "organisatievorm", "reserve"],
        [1, 2, 2, 5, 46, 11, 8, 8, 1, 1, 143],
        ["datum_aanvang_praktijk", "datum_einde_praktijk"]),
    "zorgverlener_instelling": Layout(
        ["aanduiding_oud", "bestandcode", "zorgverlenersoort", "zorgverlenernummer",
         "instellingsnummer", "datum_toetreding_instelling", "datum_uittreding_instelling",
         "status_in_de_instelling", "reserve"],
        [1, 2, 2, 6, 6, 8, 8, 1, 221],
        ["datum_toetreding_instelling", "datum_uittreding_instelling"]),
    "adres_praktijk": Layout(
        ["aanduiding_oud", "bestandcode", "zorgverlenersoort", "praktijknummer",
         "praktijkadres_volgnummer", "straat", "huisnummer", "huisnummer_toev", "postcode",
         "plaatsnaam", "reserve"],
        [1, 2, 2, 5, 2, 24, 5, 5, 6, 24, 180]),
}
