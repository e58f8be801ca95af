"""Identifier rules (P10-P14): the same rule as a column expression, for
listings and other data, and as a Python function, for column and table names
the driver puts into a plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters that a name cannot hold, and what stands in for them.
CLEAN_CHARS, STAND_IN = "-.()%", "_"

# The topic-title rewrite, in order:
# lower case, " " -> "_", drop "(" and ")", "%" -> "per", drop ",".
TOPIC_RULES = [(" ", "_"), ("(", ""), (")", ""), ("%", "per"), (",", "")]


# --- Python forms (names only, never data) ---------------------------------

def clean_name(s: str, extra_chars: str = "") -> str:
    """Each of ``-.()%`` (plus ``extra_chars``) → ``_``, then strip."""
    return s.translate(_stand_ins(extra_chars)).strip()


def _stand_ins(extra_chars: str) -> dict[int, str]:
    """The cleaning rule as a table, for both forms."""
    return str.maketrans(dict.fromkeys(CLEAN_CHARS + extra_chars, STAND_IN))


def dimension_alias(title: str) -> str:
    """Dimension title → column name: lower, space → ``_``."""
    return title.lower().replace(" ", "_")


def topic_alias(title: str) -> str:
    """Topic title → column name."""
    s = title.lower()
    for old, new in TOPIC_RULES:
        s = s.replace(old, new)
    return s


def lower_columns(df: DataFrame) -> DataFrame:
    """Rename every column to lower case (P10); raise on a resulting clash."""
    names = [c.lower() for c in df.columns]
    _no_duplicates(names)
    return df.toDF(*names)


def assign_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Give unnamed columns a fixed list of names."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    _no_duplicates(names)
    return df.toDF(*names)


def _no_duplicates(names: list[str]) -> None:
    seen, dup = set(), []
    for n in names:
        if n in seen:
            dup.append(n)
        seen.add(n)
    if dup:
        raise ValueError(f"duplicate column names: {sorted(set(dup))}")


# --- Column forms ------------------------------------------------------------

# What Python's str.strip() removes: Unicode white space plus the four
# information separators U+001C..U+001F.
_PY_STRIP = r"(?U)^[\s\x{1C}-\x{1F}]+|[\s\x{1C}-\x{1F}]+$"


def clean_name_col(c: Column | str, extra_chars: str = "") -> Column:
    """:func:`clean_name` as a column expression, for path listings."""
    rule = _stand_ins(extra_chars)
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.translate(col, "".join(map(chr, rule)), "".join(rule.values())), _PY_STRIP, "")
