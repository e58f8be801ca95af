"""Datasets as catalog databases, tables as registered files (K3, K4, K5).

A dataset is a database named ``{source}_{name}``; each staged file (a parquet
or NDJSON table folder) becomes one table whose name is the file's table id. Data
files are never deleted by a drop, because the tables only point at them.

A full refresh registers the files in a new version (a database of its own) and then
points the dataset's names at it: each name is a view that is replaced in one step. A
reader finds every table at any moment, in its old or its new state, and whatever fails
on the way leaves the old state: names that were already moved are moved back.
"""

from __future__ import annotations

import logging
import re
import uuid
from collections import Counter
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from statmart.sources.archives import file_uri, plain_uri
from statmart.sources.listing import list_prefix

log = logging.getLogger(__name__)

# File suffix → table format. Any other suffix is an error.
FORMATS = {"parquet": "parquet", "json": "json"}


def dataset_name(source: str | None, name: str) -> str:
    """``{source}_{name}``, or the bare name without a source (K4)."""
    return f"{source}_{name}" if source else name


def _q(ident: str) -> str:
    return "`" + ident.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_id(uri: str) -> tuple[str, str]:
    """(table id, suffix) of a staged file: ``…/a.b.parquet`` → (``b``, ``parquet``)."""
    last = uri.rstrip("/").split("/")[-1]
    parts = last.split(".")
    if len(parts) < 2:
        raise TypeError(f"no file suffix in {uri!r}")
    return parts[-2], parts[-1]


def dataset_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.databaseExists(name)


VERSION = "statmart.version"  # the database a dataset's names point at
CATALOG_THREADS = 8  # statements of independent tables that run side by side


def _version(spark: SparkSession, name: str) -> str | None:
    """The version database of a dataset; none if it has none, or is not there."""
    if not dataset_exists(spark, name):
        return None
    told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE DATABASE EXTENDED {_q(name)}").collect()}
    for pair in str(told.get("Properties") or "").strip("()").replace("(", "").replace(")", "").split(", "):
        key, _, value = pair.partition(",")
        if key == VERSION:
            return value
    return None


def drop_dataset(spark: SparkSession, name: str) -> None:
    """Drop a dataset with the version that its names point at."""
    version = _version(spark, name)
    spark.sql(f"DROP DATABASE IF EXISTS {_q(name)} CASCADE")
    if version:
        spark.sql(f"DROP DATABASE IF EXISTS {_q(version)} CASCADE")


def create_dataset(spark: SparkSession, name: str, description: str | None = None,
                   location: str | None = None) -> None:
    sql = f"CREATE DATABASE IF NOT EXISTS {_q(name)}"
    if description:
        sql += f" COMMENT {_text(description)}"
    if location:
        sql += f" LOCATION {_text(location)}"
    spark.sql(sql)


def _checked(uris: list[str | tuple[str, str, str]]) -> list[tuple[str, str, str, StructType | None]]:
    """(table id, uri, format, schema if it is known) of every file; raises before anything has been touched."""
    plan = []
    for given in uris:
        uri = given if isinstance(given, str) else given[1]
        tid, suffix = table_id(uri) if isinstance(given, str) else (given[0], given[2])
        if suffix not in FORMATS:
            raise TypeError(f"no table can be made of {uri!r}: its suffix is none of {sorted(FORMATS)}")
        plan.append((tid, uri, FORMATS[suffix], getattr(given, "schema", None)))
    twice = sorted(t for t, n in Counter(tid.lower() for tid, *_ in plan).items() if n > 1)
    if twice:
        raise ValueError(f"several files would become one table: {twice}")
    return plan


def _exists(spark: SparkSession, uri: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _readable(spark: SparkSession, plan: list[tuple[str, str, str, StructType | None]]) \
        -> list[tuple[str, str, str, StructType]]:
    """The files that exist, with their schemas; a missing one is reported, an unreadable one raises.

    Schemas that are not known yet are inferred by jobs that run side by side.
    """
    there = []
    for tid, uri, fmt, schema in plan:
        if _exists(spark, uri):
            there.append((tid, uri, fmt, schema))
        else:
            log.warning("no file at %s, it gets no table", uri)

    def schema_of(entry: tuple) -> StructType:
        tid, uri, fmt, schema = entry
        return schema if schema is not None else spark.read.format(fmt).load(uri).schema

    with ThreadPoolExecutor(CATALOG_THREADS) as pool:
        return [(tid, uri, fmt, schema) for (tid, uri, fmt, _), schema in zip(there, pool.map(schema_of, there))]


def _register(spark: SparkSession, dataset: str, tables: list[tuple[str, str, str, StructType]]) -> list[str]:
    def create(entry: tuple) -> None:
        tid, uri, fmt, schema = entry
        spark.catalog.createTable(f"{_q(dataset)}.{_q(tid)}", path=uri, source=fmt, schema=schema)

    with ThreadPoolExecutor(CATALOG_THREADS) as pool:
        list(pool.map(create, tables))
    return [f"{dataset}.{tid}" for tid, *_ in tables]


def link_files(spark: SparkSession, dataset: str, uris: list[str]) -> list[str]:
    """Register one unmanaged table per staged file (K5).

    Only ``.parquet`` and ``.json`` (NDJSON) are accepted; another suffix raises
    ``TypeError``, a file that cannot be read raises as well, both before anything is
    registered. A missing file is reported and skipped. Returns the table names.
    """
    return _register(spark, dataset, _readable(spark, _checked(uris)))


def _names(spark: SparkSession, dataset: str) -> dict[str, bool]:
    """Names in a dataset, with whether each is a view."""
    return {t.name: t.tableType == "VIEW" for t in spark.catalog.listTables(_q(dataset)) if not t.isTemporary}


def _point(spark: SparkSession, dataset: str, name: str, version: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {_q(dataset)}.{_q(name)} AS SELECT * FROM {_q(version)}.{_q(name)}")


def _switch(spark: SparkSession, ds: str, old: str | None, new: str, tables: list[str]) -> None:
    """Point every name of the dataset at its new version; if a step fails, all at the old one again."""
    before = _names(spark, ds)
    done: list[tuple[str, str | None]] = []  # name, and where its own table (no view) was put aside
    try:
        for t in tables:
            aside = None
            if before.get(t) is False:  # registered by link_files
                aside = f"{t}__{uuid.uuid4().hex[:8]}"
                spark.sql(f"ALTER TABLE {_q(ds)}.{_q(t)} RENAME TO {_q(ds)}.{_q(aside)}")
            done.append((t, aside))
            _point(spark, ds, t, new)
        spark.sql(f"ALTER DATABASE {_q(ds)} SET DBPROPERTIES ('{VERSION}' = {_text(new)})")
    except Exception:
        for t, aside in reversed(done):
            if aside:
                spark.sql(f"DROP VIEW IF EXISTS {_q(ds)}.{_q(t)}")
                spark.sql(f"ALTER TABLE {_q(ds)}.{_q(aside)} RENAME TO {_q(ds)}.{_q(t)}")
            elif t in before and old:
                _point(spark, ds, t, old)
            else:
                spark.sql(f"DROP VIEW IF EXISTS {_q(ds)}.{_q(t)}")
        raise
    gone = sorted(set(before) - set(tables))
    for t, is_view in [(t, before[t]) for t in gone] + [(aside, False) for _, aside in done if aside]:
        spark.sql(f"DROP {'VIEW' if is_view else 'TABLE'} IF EXISTS {_q(ds)}.{_q(t)}")


def replace_dataset(spark: SparkSession, source: str | None, name: str, uris: list[str | tuple[str, str, str]],
                    description: str | None = None, location: str | None = None) -> list[str]:
    """Full refresh of a dataset (K3): exactly the given files are its tables afterwards.

    A file is a URI whose last segment names table and format, or (table id, URI,
    format), with a ``schema`` if it is known. All are checked first and registered under
    a new version; only then do the dataset's names move to it, one by one, each in one
    step. Bad input or a failure on the way leaves the old dataset as it was. Returns the
    table names.
    """
    tables = _readable(spark, _checked(uris))
    ds = dataset_name(source, name)
    old, is_new = _version(spark, ds), not dataset_exists(spark, ds)
    new = f"{ds}__v{uuid.uuid4().hex[:12]}"
    try:
        create_dataset(spark, new, location=f"{location.rstrip('/')}/{new}" if location else None)
        _register(spark, new, tables)
        create_dataset(spark, ds, description, location)
        if description and not is_new:
            spark.sql(f"COMMENT ON DATABASE {_q(ds)} IS {_text(description)}")
        # the catalog keeps names in lower case
        _switch(spark, ds, old, new, [tid.lower() for tid, *_ in tables])
    except Exception:
        spark.sql(f"DROP DATABASE IF EXISTS {_q(new)} CASCADE")
        if is_new:
            spark.sql(f"DROP DATABASE IF EXISTS {_q(ds)} CASCADE")
        raise
    if old:
        spark.sql(f"DROP DATABASE IF EXISTS {_q(old)} CASCADE")
    return [f"{ds}.{tid}" for tid, *_ in tables]


def _places(spark: SparkSession, dataset: str) -> dict[str, tuple[str, str]]:
    """Format and location of every file table that a dataset's names stand for."""
    def told(key: str):
        return F.regexp_extract("information", rf"(?m)^{key}: (.*)$", 1)

    found = {}
    for database in filter(None, (dataset, _version(spark, dataset))):
        listed = spark.sql(f"SHOW TABLE EXTENDED IN {_q(database)} LIKE '*'").where(~F.col("isTemporary") & (told("Type") != "VIEW"))
        found.update({r[0]: (r[1], r[2]) for r in listed.select(
            "tableName", told("Provider"), told("Location")).collect()})  # one row per table
    return found


def read_tables(spark: SparkSession, tables: Sequence[str], name_col: str = "__table") -> list[tuple[list[str], DataFrame]]:
    """Rows of many registered tables (names as :func:`replace_dataset` returns them), ``name_col``
    telling which table each is of: one (table names, rows) per format and schema.

    Formats, locations and schemas are the catalog's. Tables of one format and schema are
    read in one scan, so a plan grows with the number of schemas and not of tables.
    """
    places = {ds: _places(spark, ds) for ds in {t.split(".", 1)[0] for t in tables}}
    with ThreadPoolExecutor(CATALOG_THREADS) as pool:
        schemas = list(pool.map(lambda t: spark.table(".".join(map(_q, t.split(".", 1)))).schema, tables))
    groups: dict[tuple, tuple[StructType, list[tuple[str, str]]]] = {}
    for t, schema in zip(tables, schemas):
        ds, tid = t.split(".", 1)
        fmt, location = places[ds][tid.lower()]
        location = file_uri(location).rstrip("/")
        # a file's table is told by as many parts of its path as the location has
        groups.setdefault((fmt, schema.json(), location.count("/") + 1), (schema, []))[1].append((location, t))
    out = []
    for (fmt, _, depth), (schema, members) in groups.items():
        if name_col.lower() in {c.lower() for c in schema.names}:
            raise ValueError(f"a table has a column {name_col!r}")
        paths = [re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in sorted({p for p, _ in members})]  # no patterns
        rows = spark.read.format(fmt).schema(schema).load(paths)
        rows = rows.select("*", F.substring_index(plain_uri(F.col("_metadata.file_path")), "/", depth).alias("__place"))
        names = spark.createDataFrame(members, f"__place string, `{name_col}` string")
        out.append(([t for _, t in members], rows.join(F.broadcast(names), "__place").drop("__place")))
    return out


def replace_dataset_from_folder(spark: SparkSession, root: str, prefix: str, name: str,
                                source: str | None = None, description: str | None = None,
                                location: str | None = None) -> list[str]:
    """Full refresh from a folder: every table file whose path below ``root`` starts with ``prefix``.

    A table file is a ``.parquet`` or ``.json`` file, or a folder so named that a writer
    made. One row per table reaches the driver, as the catalog needs each.
    """
    listed = list_prefix(spark, root, prefix)
    table = F.regexp_extract("relative", r"^(.*?\.(?:parquet|json))(?:/|$)", 1)
    found = listed.select(table.alias("table")).where("table <> ''").distinct().collect()
    return replace_dataset(spark, source, name, sorted(f"{root.rstrip('/')}/{r['table']}" for r in found),
                           description, location)
