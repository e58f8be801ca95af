"""Column expressions for cleaning codes, numbers and dates.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen and push down where Catalyst can push them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The missing-value tokens of the statistical sheet exports
# (a dot, and the dot padded with spaces as the sheets hold it).
SHEET_NA_TOKENS = [".", "        .", "        .       "]

# Java regex with UNICODE_CHARACTER_CLASS: \s is every Unicode white space, as
# the warehouse TRIM removes; Spark's own trim() only removes the space char.
_UNICODE_EDGES = r"(?U)^\s+|\s+$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_all(c: Column | str) -> Column:
    """TRIM that removes all leading/trailing Unicode white space."""
    return F.regexp_replace(_c(c), _UNICODE_EDGES, "")


def substr_from(c: Column | str, pos: int) -> Column:
    """SQL ``SUBSTR(s, pos)``: rest of the string from 1-based ``pos`` (F2)."""
    return F.expr(f"substr({_sql_ref(c)}, {int(pos)})") if isinstance(c, str) else \
        F.substring(_c(c), pos, 2_147_483_647)


def _sql_ref(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def period_year(c: Column | str) -> Column:
    """Year of a period code such as ``2018JJ00``: first four chars as BIGINT (F1+P8).

    A code whose first four chars are not a number fails the job (ANSI cast),
    like the warehouse cast does.
    """
    return F.substring(_c(c), 1, 4).cast("bigint")


def to_int64(c: Column | str, lenient: bool = False) -> Column:
    """Text → 64-bit integer the way the warehouse casts it.

    Bad text fails the job under ANSI, as the warehouse cast does; ``lenient``
    turns it into null instead, for use right after a loose scan.
    """
    col = _c(c)
    return col.try_cast("bigint") if lenient else col.cast("bigint")


def round_to_int64(c: Column | str) -> Column:
    """Double → BIGINT, half away from zero (§2.10.1)."""
    return F.round(_c(c)).cast("bigint")


def null_tokens(c: Column | str, tokens: Iterable[str] = SHEET_NA_TOKENS) -> Column:
    """Missing-value tokens → null (P9). Null stays null."""
    col = _c(c)
    return F.when(~col.isin(list(tokens)), col)


def null_tokens_all(df: DataFrame, tokens: Iterable[str] = SHEET_NA_TOKENS) -> DataFrame:
    """Apply :func:`null_tokens` to every string column of ``df``."""
    toks = list(tokens)
    return df.select([
        null_tokens(df[f.name], toks).alias(f.name) if isinstance(f.dataType, StringType)
        else df[f.name]
        for f in df.schema.fields
    ])


def pad_code(c: Column | str, width: int = 8, fill: str = "0") -> Column:
    """Left-pad a code that lost its leading zeros.

    Only shorter values are padded: ``lpad`` would cut longer text.
    """
    col = _c(c)
    return F.when(F.length(col) < width, F.lpad(col, width, fill)).otherwise(col)


def pad_right(c: Column | str, width: int, fill: str = " ") -> Column:
    """Right-pad text to ``width``; longer text stays whole (``rpad`` would cut it)."""
    col = _c(c)
    return F.when(F.length(col) < width, F.rpad(col, width, fill)).otherwise(col)


def parse_date(c: Column | str, fmt: str = "ddMMyyyy", pad_to: int | None = 8) -> Column:
    """Parse a compact date to a timestamp; impossible or blank values become null.

    With ``pad_to`` the text is first left-padded with zeros, restoring a
    leading zero lost by a numeric round trip (``1012020`` → ``01012020``).
    """
    col = F.nullif(trim_all(_c(c)), F.lit(""))
    if pad_to:
        col = pad_code(col, pad_to, "0")
    return F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")


def year_in_name(c: Column | str) -> Column:
    """First 19xx/20xx year found in a file name, as INT; null when none."""
    return F.nullif(F.regexp_extract(_c(c), r"((19|20)\d{2})", 1), F.lit("")).cast("int")


def record_json(*cols: Column | str) -> Column:
    """Record → JSON text."""
    return F.to_json(F.struct(*[_c(c) for c in cols]))


def get_key(c: Column | str, key: str) -> Column:
    """Fetch a key from a struct column, or from JSON text."""
    return _c(c).getField(key)


def json_key(c: Column | str, key: str) -> Column:
    return F.get_json_object(_c(c), f"$.{key}")


def parse_decimal_comma(c: Column | str) -> Column:
    """Number text that may use a decimal comma (``5,0``) → double; junk → null."""
    col = trim_all(_c(c))
    return F.regexp_replace(col, ",", ".").try_cast("double")


def cast_columns(df: DataFrame, types: dict[str, str], lenient: bool = False) -> DataFrame:
    """Explicit cast step after a string-typed scan.

    A floating column cast to ``bigint``/``long`` is rounded half away from
    zero first (a plain cast would truncate). ``lenient`` maps bad values to null.
    """
    out = []
    lower = {k.lower(): v for k, v in types.items()}
    src = {f.name: f.dataType.typeName() for f in df.schema.fields}
    for name in df.columns:
        t = lower.get(name.lower())
        if t is None:
            out.append(df[name])
        elif t in ("bigint", "long") and src[name] in ("double", "float", "decimal"):
            out.append(round_to_int64(df[name]).alias(name))
        else:
            out.append((df[name].try_cast(t) if lenient else df[name].cast(t)).alias(name))
    return df.select(out)
