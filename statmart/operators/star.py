"""Star joins: fact ⋈ dimension tables.

Design
------
* A dimension is joined on the fact's key column. For inner and left joins the
  dimension is the build side; it is broadcast only after a bounded check of
  its size (:func:`bounded_broadcast`), otherwise the join stays a shuffle join
  and adaptive execution may still turn it into a broadcast from real sizes,
  or split skewed keys. The fact is never collected or broadcast.
* Right and full joins keep the dimension rows, so the dimension cannot be the
  broadcast build side of that join. :func:`flatten` rewrites a RIGHT or FULL
  chain into inner or left joins plus the unmatched dimension rows, found in
  one more pass over the fact's distinct keys for all dimensions together.
* :func:`flatten` builds one logical plan from the dataset's column metadata:
  the metadata table is small (one row per column of the dataset) and is the
  only thing collected to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statmart.functions.names import dimension_alias, topic_alias

JOIN_TYPES = ("inner", "left", "right", "full")

# Defaults for the size check before a broadcast.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024


def check_join_type(how: str) -> str:
    """INNER / LEFT / RIGHT / FULL in any case; anything else is rejected."""
    h = (how or "").strip().lower()
    if h not in JOIN_TYPES:
        raise ValueError(f'join type must be one of "INNER", "LEFT", "RIGHT", "FULL", got {how!r}')
    return h


# Bytes of a value of fixed width, by type.
_TYPE_WIDTH = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "date": 4, "float": 4,
               "long": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8, "decimal": 16}


def row_bytes(df: DataFrame) -> Column:
    """Size of a row: fixed widths by type, text and binary as long as they are, nested values as JSON."""
    total = F.lit(16)
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind in _TYPE_WIDTH:
            total = total + _TYPE_WIDTH[kind]
        else:
            c = F.col(f"`{f.name}`")
            c = c if kind in ("string", "binary", "varchar", "char") else F.to_json(F.struct(c))
            total = total + F.coalesce(F.octet_length(c), F.lit(0)) + 8
    return total


@dataclass(frozen=True)
class TableSize:
    rows: int
    bytes: int
    widest: int  # bytes of the largest row


def table_sizes(dfs: Sequence[DataFrame]) -> list[TableSize]:
    """Sizes of several tables in one job, each reduced inside its tasks (one row per task is shuffled)."""
    if not dfs:
        return []
    union = None
    for i, d in enumerate(dfs):
        own = row_bytes(d)
        part = d.agg(F.count(F.lit(1)).alias("n"), F.sum(own).alias("b"), F.max(own).alias("w")) \
                .select(F.lit(i).alias("i"), "n", "b", "w")
        union = part if union is None else union.unionAll(part)
    got = {r["i"]: TableSize(r["n"], r["b"] or 0, r["w"] or 0) for r in union.collect()}
    return [got[i] for i in range(len(dfs))]


def fits_broadcast_many(dfs: Sequence[DataFrame], max_rows: int = BROADCAST_MAX_ROWS,
                        max_bytes: int = BROADCAST_MAX_BYTES) -> list[bool]:
    """Per table: at most ``max_rows`` rows and ``max_bytes`` bytes, as counted."""
    return [s.rows <= max_rows and s.bytes <= max_bytes for s in table_sizes(dfs)]


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                   max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    return fits_broadcast_many([df], max_rows, max_bytes)[0]


def max_key_multiplicity(dfs: Sequence[DataFrame], keys: Sequence[str]) -> list[int]:
    """Largest number of rows sharing one key value, per (table, key), in one
    job. Use on tables already proven small."""
    if not dfs:
        return []
    parts = [d.groupBy(F.col(k)).agg(F.count(F.lit(1)).alias("__m"))
              .select(F.lit(i).alias("__i"), "__m") for i, (d, k) in enumerate(zip(dfs, keys))]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionAll(p)
    got = {r["__i"]: r["m"] for r in union.groupBy("__i").agg(F.max("__m").alias("m")).collect()}
    return [got.get(i, 0) for i in range(len(dfs))]


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` when its size is proven small, else ``df`` unchanged."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def join_dimension(fact: DataFrame, dim: DataFrame, on: tuple[str, str] | str,
                   how: str = "inner", check_size: bool = True, broadcast: bool | None = None,
                   **bounds) -> DataFrame:
    """Join one dimension to ``fact``; ``on`` is ``(fact_col, dim_col)``.

    Column names may be qualified by DataFrame aliases (``fct.Postcode``).
    Duplicate dimension keys multiply fact rows, as in SQL. ``broadcast``
    forces the decision a caller has already proven; ``None`` checks here.
    """
    how = check_join_type(how)
    fact_col, dim_col = (on, on) if isinstance(on, str) else on
    if how in ("inner", "left"):
        if broadcast is None and check_size:
            dim = bounded_broadcast(dim, **bounds)
        elif broadcast:
            dim = F.broadcast(dim)
    return fact.join(dim, F.col(fact_col) == F.col(dim_col), how)


# --- metadata-driven flatten (J3) --------------------------------------------

DIMENSION_KINDS = ("Dimension", "TimeDimension", "GeoDimension", "GeoDetail")


def split_properties(properties: DataFrame, key_col: str = "Key",
                     title_col: str = "Title", type_col: str = "Type",
                     order_col: str | None = None) -> dict[str, list[tuple[str, str]]]:
    """Read the column metadata of a dataset and split it by kind.

    Returns ``{"Dimension": [(key, title), ...], "TimeDimension": ..., ...,
    "Topic": [...]}``. Dimensions are rows whose type contains ``Dimension`` or
    ``Geo``; topics are rows whose type contains ``Topic``. Order is
    ``order_col`` when given, else the key.
    """
    t = F.col(type_col)
    sel = properties.where(t.contains("Dimension") | t.contains("Geo") | t.contains("Topic"))
    order = [order_col] if order_col else [key_col]
    rows = sel.select(key_col, title_col, type_col, *([order_col] if order_col else [])) \
        .orderBy(*order).collect()
    out: dict[str, list[tuple[str, str]]] = {k: [] for k in DIMENSION_KINDS + ("Topic",)}
    for r in rows:
        kind = r[type_col]
        if "Topic" in kind:
            out["Topic"].append((r[key_col], r[title_col]))
        elif kind in out:
            out[kind].append((r[key_col], r[title_col]))
    return out


def flatten(fact: DataFrame, dims: Mapping[str, DataFrame], properties: DataFrame,
            how: str = "inner", kinds: Sequence[str] = ("Dimension",),
            key_col: str = "Key", title_col: str = "Title", type_col: str = "Type",
            order_col: str | None = None, **bounds) -> DataFrame:
    """Flatten a fact table and its dimension tables into one table.

    For every dimension ``k`` of the selected ``kinds`` the output has
    ``<title>_code`` (the dimension key) and ``<title>`` (its title), then one
    column per topic named by the topic rule. ``dims[k]`` is the dimension
    table for fact column ``k`` with columns ``Key`` and ``Title``. With no
    dimension the result is the topics alone. Duplicate output names raise.
    """
    how = check_join_type(how)
    meta = split_properties(properties, key_col, title_col, type_col, order_col)
    dim_items = [kv for kind in kinds for kv in meta.get(kind, [])]
    topics = meta["Topic"]

    names = [n for k, t in dim_items for n in (dimension_alias(t) + "_code", dimension_alias(t))]
    names += [topic_alias(t) for _, t in topics]
    dup = sorted({n for n in names if names.count(n) > 1})
    if dup:
        raise ValueError(f"flatten would produce duplicate column names: {dup}")

    missing = [k for k, _ in dim_items if k not in dims]
    if missing:
        raise KeyError(f"no dimension table for {missing}")
    picked = [dims[k].select(F.col(key_col).alias(f"__d{i}_key"), F.col(title_col).alias(f"__d{i}_title"))
              for i, (k, _) in enumerate(dim_items)]
    small = fits_broadcast_many(picked, **bounds)
    keys = [f"fct.{k}" for k, _ in dim_items]
    dim_columns = [(F.col(f"__d{i}_key").alias(dimension_alias(t) + "_code"),
                    F.col(f"__d{i}_title").alias(dimension_alias(t))) for i, (_, t) in enumerate(dim_items)]
    select = [c for pair in dim_columns for c in pair] + \
        [F.col(f"fct.{key}").alias(topic_alias(title)) for key, title in topics]
    base = fact.alias("fct")
    chain = base
    for i in range(len(dim_items)):
        chain = join_dimension(chain, picked[i], (keys[i], f"__d{i}_key"),
                               {"right": "inner", "full": "left"}.get(how, how), broadcast=small[i], check_size=False)
    out = chain.select(select)
    if how in ("inner", "left") or not dim_items:
        return out
    extra = _unmatched(base, picked, keys, how, small)
    titles = [dimension_alias(t) for _, t in dim_items]
    return out.unionByName(extra.select(
        *[F.when(F.col("__i") == i, F.col(c)).alias(n) for i, t in enumerate(titles)
          for c, n in (("__key", t + "_code"), ("__title", t))]), allowMissingColumns=True)


def _unmatched(fact: DataFrame, picked: list[DataFrame], keys: list[str], how: str, small: list[bool]) -> DataFrame:
    """(__i, __key, __title): dimension rows that a RIGHT or FULL chain adds.

    FULL adds the rows of every dimension whose key no fact row has. In a RIGHT chain
    a row kept by one join has null keys for the next, so only the last dimension's rows
    stay, those that no fact row with a match in all other dimensions has. The keys of
    all dimensions come from one pass over the fact, reduced to distinct pairs before
    the shuffle.
    """
    last = len(picked) - 1
    if how == "right":
        for i in range(last):
            known = picked[i].select(f"__d{i}_key")
            fact = fact.join(F.broadcast(known) if small[i] else known,
                             F.col(keys[i]) == F.col(f"__d{i}_key"), "left_semi")
    asked = range(len(picked)) if how == "full" else [last]
    seen = fact.select(F.explode(F.array(*[F.struct(F.lit(i).alias("__j"), F.col(keys[i]).cast("string").alias("__k"))
                                           for i in asked])).alias("p")).select("p.*").distinct()
    rows = None
    for i in asked:
        part = picked[i].select(F.lit(i).alias("__i"), F.col(f"__d{i}_key").alias("__key"),
                                F.col(f"__d{i}_title").alias("__title"))
        rows = part if rows is None else rows.unionAll(part)
    # An anti join would be pushed into the union, one pass over the fact per branch.
    met = (F.col("__i") == F.col("__j")) & (F.col("__key").cast("string") == F.col("__k"))
    return rows.join(seen, met, "left").where(F.col("__j").isNull()).drop("__j", "__k")
