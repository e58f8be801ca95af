"""Registered queries on the driver's test tables, each with its DuckDB oracle.

Every query reads the whole test tables of ``sf_dir`` (or files Spark writes
from them into the shared scratch folder) and returns a DataFrame; nothing is
collected. ``ORACLE`` holds, per key, SQL over the same tables that DuckDB runs
as the correctness reference. Column names and types match between the two.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from statmart.functions.columns import (SHEET_NA_TOKENS, cast_columns, get_key, null_tokens_all,
                                        pad_code, pad_right, parse_decimal_comma, record_json,
                                        round_to_int64, substr_from, to_int64, trim_all)
from statmart.operators.catalog import (batches, distinct_sources, expect_one, ids_by_source,
                                        needs_refresh, source_filter)
from statmart.operators.nesting import map_items, nest, unnest
from statmart.operators.runlog import count_failed, failed_runs, first_last_by
from statmart.functions import paths
from statmart.functions.names import assign_columns, clean_name_col
from statmart.operators.sequence import batch_number
from statmart.operators.star import flatten
from statmart.session import scratch_path
from statmart.sinks.datasets import (dataset_name, drop_dataset, read_tables, replace_dataset,
                                     replace_dataset_from_folder)
from statmart.sinks.tables import read_range, replace_table, write_ndjson, write_range_partitioned
from statmart.plans.staging import (envelope_pages, stage_member_zips, stage_sheet_exports, stage_xml,
                                    stage_yearly_files, stage_zips)
from statmart.sinks.tables import load_ndjson_files
from statmart.sources.archives import convert_members, expand_archives, list_members
from statmart.sources.dataset import flatten_dataset
from statmart.sources.delimited import read_delimited, read_yearly
from statmart.sources.files import input_files
from statmart.sources.fixed_width import (Layout, read_fixed_width, read_fixed_width_inferred,
                                          write_fixed_width)
from statmart.sources.json_records import portal_datasets, read_envelope, resource_urls
from statmart.sources.sheet import read_sheet_export
from statmart.sources.xml_records import read_xml_records
from statmart.streaming.incremental import load_new_files
from statmart.sources.listing import list_prefix, with_path_parts
from statmart.plans.marts import Dim, MartSpec, build_mart, write_mart
from statmart.plans.sql import population_pc4, run_sql
from statmart.sinks.tables import RangeBuckets

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def load(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def _padded(value: str, width: int, fill: str = "0", side: str = "l") -> str:
    """SQL of a padded code that never shortens a longer one."""
    return f"(CASE WHEN length({value}) < {width} THEN {side}pad({value}, {width}, '{fill}') ELSE {value} END)"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco


# --- marts ---------------------------------------------------------------------

LEFT_STAR = MartSpec(
    name="lineitem_part_supplier",
    fact="lineitem",
    dims=[Dim("p", "part", "l_partkey", "p_partkey", how="left"),
          Dim("s", "supplier", "l_suppkey", "s_suppkey", how="left")],
    select=[("jaar", "cast(substr(cast(fct.l_shipdate as string), 1, 4) as bigint)"),
            ("l_orderkey", "fct.l_orderkey"),
            ("l_linenumber", "fct.l_linenumber"),
            ("part_name", "p.p_name"),
            ("part_type", "p.p_type"),
            ("supplier_name", "s.s_name"),
            ("quantity", "cast(round(fct.l_quantity) as bigint)")],
    where=["p.p_type != {excluded_type}", "s.s_suppkey != {excluded_supplier}"],
    partition=RangeBuckets("jaar", 1999, 2030, 1),
    params={"excluded_type": "PROMO", "excluded_supplier": 0},
)

_LEFT_STAR_SQL = """
SELECT CAST(substr(CAST(fct.l_shipdate AS VARCHAR), 1, 4) AS BIGINT) AS jaar,
       fct.l_orderkey AS l_orderkey, fct.l_linenumber AS l_linenumber,
       p.p_name AS part_name, p.p_type AS part_type, s.s_name AS supplier_name,
       CAST(round(fct.l_quantity) AS BIGINT) AS quantity
FROM lineitem AS fct
LEFT JOIN part AS p ON p.p_partkey = fct.l_partkey
LEFT JOIN supplier AS s ON s.s_suppkey = fct.l_suppkey
WHERE p.p_type != 'PROMO' AND s.s_suppkey != 0
"""


@register("mart_left_star", _LEFT_STAR_SQL)
def mart_left_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_mart(LEFT_STAR, load(spark, sf_dir, "lineitem", "part", "supplier"))


_LEFT_STAR_TEMPLATE = """
SELECT CAST(substr(CAST(fct.l_shipdate AS STRING), 1, 4) AS BIGINT) AS jaar,
       fct.l_orderkey AS l_orderkey, fct.l_linenumber AS l_linenumber,
       p.p_name AS part_name, p.p_type AS part_type, s.s_name AS supplier_name,
       CAST(round(fct.l_quantity) AS BIGINT) AS quantity
FROM IDENTIFIER(:fact) AS fct
LEFT JOIN IDENTIFIER(:part) AS p ON p.p_partkey = fct.l_partkey
LEFT JOIN IDENTIFIER(:supplier) AS s ON s.s_suppkey = fct.l_suppkey
WHERE p.p_type != :excluded_type AND s.s_suppkey != :excluded_supplier
"""


@register("mart_left_star_sql", _LEFT_STAR_SQL)
def mart_left_star_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load(spark, sf_dir, "lineitem", "part", "supplier")
    return run_sql(spark, _LEFT_STAR_TEMPLATE,
                   {"fact": t["lineitem"], "part": t["part"], "supplier": t["supplier"]},
                   {"excluded_type": "PROMO", "excluded_supplier": 0})


INNER_STAR = MartSpec(
    name="lineitem_order_region",
    fact="lineitem",
    dims=[Dim("o", "orders", "l_orderkey", "o_orderkey"),
          Dim("c", "customer", "o.o_custkey", "c_custkey"),
          Dim("n", "nation", "c.c_nationkey", "n_nationkey"),
          Dim("r", "region", "n.n_regionkey", "r_regionkey")],
    select=[("jaar", "cast(year(o.o_orderdate) as bigint)"),
            ("region_name", "r.r_name"),
            ("nation_name", "n.n_name"),
            ("segment", "c.c_mktsegment"),
            ("priority", "o.o_orderpriority"),
            ("l_orderkey", "fct.l_orderkey"),
            ("l_linenumber", "fct.l_linenumber"),
            ("extended_price", "fct.l_extendedprice")],
    where=["o.o_orderpriority NOT IN ({subtotals})"],
    params={"subtotals": ["1-URGENT", "2-HIGH"]},
)


@register("mart_inner_star", """
SELECT CAST(year(o.o_orderdate) AS BIGINT) AS jaar, r.r_name AS region_name,
       n.n_name AS nation_name, c.c_mktsegment AS segment, o.o_orderpriority AS priority,
       fct.l_orderkey AS l_orderkey, fct.l_linenumber AS l_linenumber,
       fct.l_extendedprice AS extended_price
FROM lineitem AS fct
JOIN orders AS o ON o.o_orderkey = fct.l_orderkey
JOIN customer AS c ON c.c_custkey = o.o_custkey
JOIN nation AS n ON n.n_nationkey = c.c_nationkey
JOIN region AS r ON r.r_regionkey = n.n_regionkey
WHERE o.o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
""")
def mart_inner_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_mart(INNER_STAR, load(spark, sf_dir, "lineitem", "orders", "customer",
                                       "nation", "region"))


WIDE_CONSTANT = MartSpec(
    name="orders_customer_wide",
    fact="orders",
    dims=[Dim("c", "customer", "o_custkey", "c_custkey")],
    select=[("jaar", "2018"),
            ("segment", "c.c_mktsegment"),
            ("customer_name", "regexp_replace(concat(' ', c.c_name, '  '), '(?U)^\\\\s+|\\\\s+$', '')"),
            ("order_key", "fct.o_orderkey"),
            ("order_status", "fct.o_orderstatus"),
            ("total_price", "fct.o_totalprice"),
            ("acctbal", "c.c_acctbal")],
    order_by=["segment", "order_key"],
)


@register("mart_wide_constant", """
SELECT 2018 AS jaar, c.c_mktsegment AS segment,
       TRIM(concat(' ', c.c_name, '  ')) AS customer_name, fct.o_orderkey AS order_key,
       fct.o_orderstatus AS order_status, fct.o_totalprice AS total_price,
       c.c_acctbal AS acctbal
FROM orders AS fct JOIN customer AS c ON c.c_custkey = fct.o_custkey
ORDER BY segment, order_key
""")
def mart_wide_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_mart(WIDE_CONSTANT, load(spark, sf_dir, "orders", "customer"))


TYPE_PREFIX = MartSpec(
    name="orders_priority_text",
    fact="orders",
    dims=[Dim("c", "customer", "o_custkey", "c_custkey")],
    select=[("jaar", "cast(year(fct.o_orderdate) as bigint)"),
            ("customer_code", "c.c_custkey"),
            ("customer_number", "substr(c.c_name, 10)"),
            ("priority_code", "fct.o_orderpriority"),
            ("priority_text", "substr(fct.o_orderpriority, 3)"),
            ("total_price", "fct.o_totalprice")],
    where=["fct.o_orderpriority LIKE '4-%'", "c.c_name LIKE 'Custom%'",
           "fct.o_orderstatus != 'P'"],
)


@register("mart_type_prefix", """
SELECT CAST(year(fct.o_orderdate) AS BIGINT) AS jaar, c.c_custkey AS customer_code,
       substr(c.c_name, 10) AS customer_number, fct.o_orderpriority AS priority_code,
       substr(fct.o_orderpriority, 3) AS priority_text, fct.o_totalprice AS total_price
FROM orders AS fct JOIN customer AS c ON c.c_custkey = fct.o_custkey
WHERE fct.o_orderpriority LIKE '4-%' AND c.c_name LIKE 'Custom%' AND fct.o_orderstatus != 'P'
""")
def mart_type_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_mart(TYPE_PREFIX, load(spark, sf_dir, "orders", "customer"))


@register("dim_extract", """
SELECT CAST(c_custkey AS VARCHAR) AS customer_code,
       TRIM(concat(c_name, '   ')) AS customer_name
FROM customer
WHERE starts_with(c_mktsegment, 'MACHINE_') OR starts_with(c_mktsegment, 'AUTO')
ORDER BY customer_code
""")
def dim_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    # '_' is literal here: startswith is not a LIKE pattern.
    c = load(spark, sf_dir, "customer")["customer"]
    return (c.where(F.col("c_mktsegment").startswith("MACHINE_") |
                    F.col("c_mktsegment").startswith("AUTO"))
             .select(trim_all(pad_code(F.col("c_custkey").cast("string"), 12, " ")).alias("customer_code"),
                     trim_all(F.concat("c_name", F.lit("   "))).alias("customer_name"))
             .orderBy("customer_code"))


# --- metadata-driven flatten ------------------------------------------------------

# Column metadata of the lineitem fact, as a statistical dataset describes itself.
LINEITEM_PROPERTIES = [
    ("l_partkey", "Part", "Dimension"),
    ("l_suppkey", "Supplier", "Dimension"),
    ("l_shipdate", "Ship date", "TimeDimension"),
    ("l_quantity", "Quantity", "Topic"),
    ("l_extendedprice", "Extended price (EUR)", "Topic"),
    ("l_discount", "Discount %", "Topic"),
    ("l_tax", "Tax, rate", "Topic"),
]


def _lineitem_flatten(spark: SparkSession, sf_dir: str, how: str, removed_keys: bool) -> DataFrame:
    t = load(spark, sf_dir, "lineitem", "part", "supplier")
    props = spark.createDataFrame(LINEITEM_PROPERTIES, "Key string, Title string, Type string")
    fact = t["lineitem"]
    part = t["part"].select(F.col("p_partkey").cast("string").alias("Key"), F.col("p_name").alias("Title"),
                            (F.col("p_type") != "PROMO").alias("kept"), (F.col("p_size") <= 25).alias("unused"))
    supplier = t["supplier"].select(F.col("s_suppkey").cast("string").alias("Key"), F.col("s_name").alias("Title"),
                                    (F.col("s_acctbal") >= 0).alias("kept"),
                                    (F.col("s_nationkey") <= 12).alias("unused"))
    if removed_keys:
        # some fact rows lose their dimension row, and some dimension rows have no fact row
        part, supplier = (d.where("kept").unionByName(d.where("unused").withColumns(
            {"Key": F.concat(F.lit("X"), "Key"), "Title": F.concat(F.lit("unused "), "Title")}))
            for d in (part, supplier))
    # Statistical datasets carry dimension codes as text, in the fact and in
    # the dimension tables alike.
    fact = fact.withColumns({"l_partkey": F.col("l_partkey").cast("string"),
                             "l_suppkey": F.col("l_suppkey").cast("string")})
    dims = {"l_partkey": part.select("Key", "Title"), "l_suppkey": supplier.select("Key", "Title")}
    return flatten(fact, dims, props, how=how)


def _flatten_sql(how: str, removed_keys: bool) -> str:
    part = "SELECT CAST(p_partkey AS VARCHAR) AS Key, p_name AS Title FROM part"
    supp = "SELECT CAST(s_suppkey AS VARCHAR) AS Key, s_name AS Title FROM supplier"
    if removed_keys:
        part += (" WHERE p_type != 'PROMO' UNION ALL SELECT 'X' || CAST(p_partkey AS VARCHAR), 'unused ' || p_name"
                 " FROM part WHERE p_size <= 25")
        supp += (" WHERE s_acctbal >= 0 UNION ALL SELECT 'X' || CAST(s_suppkey AS VARCHAR), 'unused ' || s_name"
                 " FROM supplier WHERE s_nationkey <= 12")
    part, supp = f"({part})", f"({supp})"
    fact = (f"(SELECT CAST(l_partkey AS VARCHAR) AS l_partkey, CAST(l_suppkey AS VARCHAR) AS l_suppkey,"
            " l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)")
    return f"""
SELECT l_partkey.Key AS part_code, l_partkey.Title AS part,
       l_suppkey.Key AS supplier_code, l_suppkey.Title AS supplier,
       fct.l_quantity AS quantity, fct.l_extendedprice AS extended_price_eur,
       fct.l_discount AS discount_per, fct.l_tax AS tax_rate
FROM {fact} AS fct
{how} JOIN {part} AS l_partkey ON l_partkey.Key = fct.l_partkey
{how} JOIN {supp} AS l_suppkey ON l_suppkey.Key = fct.l_suppkey
"""


@register("flatten_meta_inner", _flatten_sql("INNER", False))
def flatten_meta_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineitem_flatten(spark, sf_dir, "INNER", False)


@register("flatten_meta_left", _flatten_sql("LEFT", True))
def flatten_meta_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineitem_flatten(spark, sf_dir, "LEFT", True)


@register("flatten_meta_right", _flatten_sql("RIGHT", True))
def flatten_meta_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineitem_flatten(spark, sf_dir, "RIGHT", True)


@register("flatten_meta_full", _flatten_sql("FULL", True))
def flatten_meta_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineitem_flatten(spark, sf_dir, "FULL", True)


# --- casts and missing values ---------------------------------------------------

@register("int_round_half_away", """
SELECT l_orderkey, l_linenumber,
       CAST(round(l_extendedprice) AS BIGINT) AS price_int,
       CAST(round(-l_extendedprice) AS BIGINT) AS neg_price_int,
       CAST(round(l_quantity * 0.5) AS BIGINT) AS half_qty_int,
       CAST(round(-l_quantity * 0.5) AS BIGINT) AS neg_half_qty_int,
       CAST(CAST(l_linenumber AS VARCHAR) AS BIGINT) AS line_from_text
FROM lineitem
""")
def int_round_half_away(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")["lineitem"]
    return li.select("l_orderkey", "l_linenumber",
                     round_to_int64("l_extendedprice").alias("price_int"),
                     round_to_int64(-F.col("l_extendedprice")).alias("neg_price_int"),
                     round_to_int64(F.col("l_quantity") * 0.5).alias("half_qty_int"),
                     round_to_int64(-F.col("l_quantity") * 0.5).alias("neg_half_qty_int"),
                     to_int64(F.col("l_linenumber").cast("string")).alias("line_from_text"))


@register("na_tokens", """
SELECT l_orderkey, l_linenumber,
       CAST(CASE WHEN raw IN ('.', '        .', '        .       ') THEN NULL ELSE raw END AS DOUBLE)
         AS quantity
FROM (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_linenumber = 3 THEN '.'
                  WHEN l_linenumber = 5 THEN '        .'
                  WHEN l_linenumber = 7 THEN '        .       '
                  ELSE CAST(l_quantity AS VARCHAR) END AS raw
      FROM lineitem)
""")
def na_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")["lineitem"]
    raw = (F.when(F.col("l_linenumber") == 3, F.lit(SHEET_NA_TOKENS[0]))
            .when(F.col("l_linenumber") == 5, F.lit(SHEET_NA_TOKENS[1]))
            .when(F.col("l_linenumber") == 7, F.lit(SHEET_NA_TOKENS[2]))
            .otherwise(F.col("l_quantity").cast("string")))
    staged = li.select("l_orderkey", "l_linenumber", raw.alias("quantity"))
    return cast_columns(null_tokens_all(staged), {"quantity": "double"})


# --- catalog ------------------------------------------------------------------------

def _part_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a dataset catalog: id → brand (case varies), and a second,
    conflicting catalog entry for the smallest parts (a repeated id)."""
    p = load(spark, sf_dir, "part")["part"]
    brand = F.when(F.col("p_size") > 25, F.upper("p_brand")).otherwise(F.col("p_brand"))
    main = p.select(F.col("p_partkey").alias("Identifier"), brand.alias("Catalog"))
    extra = p.where(F.col("p_size") == 1).select(F.col("p_partkey").alias("Identifier"),
                                                 F.col("p_type").alias("Catalog"))
    return main.unionByName(extra)


_PART_CATALOG_SQL = """
cat AS (
  SELECT p_partkey AS Identifier,
         CASE WHEN p_size > 25 THEN upper(p_brand) ELSE p_brand END AS Catalog FROM part
  UNION ALL
  SELECT p_partkey AS Identifier, p_type AS Catalog FROM part WHERE p_size = 1)
"""


@register("catalog_group", f"""
WITH {_PART_CATALOG_SQL},
latest AS (SELECT Identifier, max(Catalog) AS Catalog FROM cat GROUP BY Identifier),
keyed AS (SELECT lower(Catalog) AS source, Identifier,
                 row_number() OVER (PARTITION BY lower(Catalog) ORDER BY Identifier) - 1 AS seq
          FROM latest)
SELECT source, CAST(floor(seq / 1000) AS BIGINT) AS part, count(*) AS n_ids,
       string_agg(CAST(Identifier AS VARCHAR), ',' ORDER BY Identifier) AS ids
FROM keyed GROUP BY source, CAST(floor(seq / 1000) AS BIGINT)
""")
def catalog_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = ids_by_source(_part_catalog(spark, sf_dir))
    return g.select("source", "part", "n_ids", F.array_join("ids", ",").alias("ids"))


@register("catalog_group_hot", """
WITH keyed AS (
  SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'cbs' ELSE lower(o_orderpriority) END AS source, o_orderkey,
         row_number() OVER (PARTITION BY CASE WHEN o_orderkey % 3 = 0 THEN 'cbs' ELSE lower(o_orderpriority) END
                            ORDER BY o_orderkey) - 1 AS seq
  FROM orders)
SELECT source, CAST(floor(seq / 1000) AS BIGINT) AS part, count(*) AS n_ids,
       string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS ids
FROM keyed GROUP BY source, CAST(floor(seq / 1000) AS BIGINT)
""")
def catalog_group_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source holds a third of all ids: its list is cut into parts of 1000."""
    o = load(spark, sf_dir, "orders")["orders"]
    catalog = o.select(F.col("o_orderkey").alias("Identifier"),
                       F.when(F.col("o_orderkey") % 3 == 0, F.lit("CBS")).otherwise(F.col("o_orderpriority")).alias("Catalog"))
    g = ids_by_source(catalog)
    return g.select("source", "part", "n_ids", F.array_join("ids", ",").alias("ids"))


@register("catalog_distinct", f"""
WITH {_PART_CATALOG_SQL}
SELECT DISTINCT Catalog AS source FROM cat
""")
def catalog_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_sources(_part_catalog(spark, sf_dir))


@register("catalog_assert_one", """
SELECT * FROM customer WHERE lower(c_name) = lower('CUSTOMER#000000042')
""")
def catalog_assert_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")["customer"]
    return expect_one(c.where(source_filter("c_name", "CUSTOMER#000000042")), "customer")


def _refresh_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = load(spark, sf_dir, "orders")["orders"]
    modified = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    source = o.select(F.col("o_orderkey").alias("id"), modified.alias("modified"))
    changed = (F.when(F.col("o_orderstatus") == "P", F.lit(None))
                .when(F.col("o_orderpriority") == "3-MEDIUM", F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"))
                .when((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "F"),
                      F.lit(None))
                .otherwise(F.col("o_orderdate")))
    loaded = o.where(F.col("o_orderpriority") != "5-LOW") \
              .select(F.col("o_orderkey").alias("id"), changed.cast("timestamp_ntz").alias("modified"))
    return source, loaded


_REFRESH_SQL = """
WITH src AS (
  SELECT o_orderkey AS id, CASE WHEN o_orderstatus != 'P' THEN o_orderdate END AS modified
  FROM orders),
ld AS (
  SELECT o_orderkey AS id,
         CASE WHEN o_orderstatus = 'P' THEN NULL
              WHEN o_orderpriority = '3-MEDIUM' THEN o_orderdate + INTERVAL 1 DAY
              WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN NULL
              ELSE o_orderdate END AS modified
  FROM orders WHERE o_orderpriority != '5-LOW')
"""


@register("batches_hot", """
SELECT kind, l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(floor((row_number() OVER (PARTITION BY kind ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1) / 10)
            AS BIGINT) AS batch
FROM (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE l_returnflag END AS kind FROM lineitem)
""")
def batches_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One group holds a third of all rows."""
    li = load(spark, sf_dir, "lineitem")["lineitem"]
    kind = F.when(F.col("l_orderkey") % 3 == 0, F.lit("hot")).otherwise(F.col("l_returnflag"))
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return batch_number(li.select(kind.alias("kind"), *cols), ["kind"], cols, size=10).select("kind", *cols, "batch")


@register("refresh_needed", _REFRESH_SQL + """
SELECT s.id, s.modified,
       CASE WHEN EXISTS (SELECT 1 FROM ld WHERE ld.id = s.id) THEN 'changed' ELSE 'new' END AS reason
FROM src s
WHERE NOT EXISTS (SELECT 1 FROM ld WHERE ld.id = s.id AND ld.modified IS NOT DISTINCT FROM s.modified)
""")
def refresh_needed(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, loaded = _refresh_frames(spark, sf_dir)
    return needs_refresh(source, loaded, "id", "modified")


@register("refresh_forced", _REFRESH_SQL + """
SELECT s.id, s.modified, 'forced' AS reason FROM src s
""")
def refresh_forced(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, loaded = _refresh_frames(spark, sf_dir)
    return needs_refresh(source, loaded, "id", "modified", force=True)


@register("batches_of_ten", """
SELECT p_type, p_partkey,
       CAST(floor((row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) - 1) / 10) AS BIGINT)
         AS batch
FROM part
""")
def batches_of_ten(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")["part"].select("p_type", "p_partkey")
    return batches(p, "p_type", "p_partkey", size=10)


# --- run log --------------------------------------------------------------------------

def _runs_and_logs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Users as load runs: a run is named by its first event, fails when its
    last event is an error; every event is a log record."""
    e = load(spark, sf_dir, "events")["events"]
    order = F.struct("ts", "event_id")
    runs = e.groupBy("user_id").agg(
        F.min_by("event_type", order).alias("first_type"),
        F.max_by("event_type", order).alias("last_type"),
        F.min("ts").alias("start_time"), F.max("ts").alias("end_time"))
    runs = runs.select(
        F.col("user_id").alias("run_id"),
        F.concat(F.when(F.col("first_type").isin("purchase", "click"), F.lit("CBS_v3_"))
                  .otherwise(F.lit("bag_")), F.col("user_id").cast("string")).alias("name"),
        F.when(F.col("last_type") == "error", F.lit("Failed")).otherwise(F.lit("Success")).alias("state"),
        "start_time", "end_time")
    logs = e.select(F.col("user_id").alias("run_id"),
                    F.when(F.col("event_type") == "error", F.lit("ERROR")).otherwise(F.lit("INFO")).alias("level"),
                    F.col("ts").alias("timestamp"),
                    F.concat(F.lit("event "), F.col("event_id").cast("string"), F.lit(" "),
                             F.col("event_type")).alias("message"))
    return runs, logs


_RUNS_SQL = """
WITH runs AS (
  SELECT user_id AS run_id,
         CASE WHEN first(event_type ORDER BY ts, event_id) IN ('purchase', 'click') THEN 'CBS_v3_'
              ELSE 'bag_' END || CAST(user_id AS VARCHAR) AS name,
         CASE WHEN last(event_type ORDER BY ts, event_id) = 'error' THEN 'Failed'
              ELSE 'Success' END AS state,
         min(ts) AS start_time, max(ts) AS end_time
  FROM events GROUP BY user_id),
logs AS (
  SELECT user_id AS run_id, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
         ts AS timestamp, 'event ' || CAST(event_id AS VARCHAR) || ' ' || event_type AS message
  FROM events)
"""


@register("failed_runs", _RUNS_SQL + """,
ranked AS (
  SELECT run_id, timestamp, message,
         row_number() OVER (PARTITION BY run_id ORDER BY timestamp, message) AS rf,
         row_number() OVER (PARTITION BY run_id ORDER BY timestamp DESC, message DESC) AS rl,
         count(*) OVER (PARTITION BY run_id) AS n
  FROM logs WHERE level = 'ERROR')
SELECT r.run_id, r.name, r.start_time, r.end_time, COALESCE(f.n, 0) AS n_errors,
       f.timestamp AS first_error_time, f.message AS first_error,
       l.timestamp AS last_error_time, l.message AS last_error
FROM runs r
LEFT JOIN ranked f ON f.run_id = r.run_id AND f.rf = 1
LEFT JOIN ranked l ON l.run_id = r.run_id AND l.rl = 1
WHERE r.state = 'Failed' AND r.name ILIKE 'cbs_v3%'
ORDER BY r.start_time DESC
""")
def failed_runs_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs, logs = _runs_and_logs(spark, sf_dir)
    return failed_runs(runs, logs, "cbs_v3%")


@register("failed_run_count", _RUNS_SQL + """
SELECT count(*) AS n_failed FROM runs WHERE state = 'Failed' AND name ILIKE 'cbs_v3%'
""")
def failed_run_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs, _ = _runs_and_logs(spark, sf_dir)
    return count_failed(runs, "cbs_v3%")


@register("failed_first_last", """
WITH err AS (
  SELECT user_id, ts, event_id, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rf,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rl,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM events WHERE event_type = 'error')
SELECT f.user_id, f.n AS n_errors, f.ts AS first_ts, f.value AS first_value,
       l.ts AS last_ts, l.value AS last_value
FROM err f JOIN err l ON l.user_id = f.user_id AND l.rl = 1
WHERE f.rf = 1
""")
def failed_first_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")["events"].where(F.col("event_type") == "error")
    fl = first_last_by(e, ["user_id"], ["ts", "event_id"], ["ts", "value"])
    return fl.select("user_id", "n_errors", F.col("first_ts"), F.col("first_value"),
                     F.col("last_ts"), F.col("last_value"))


# --- nested rows ------------------------------------------------------------------------

@register("nest_unnest", """
SELECT l_orderkey,
       CAST(floor((row_number() OVER (PARTITION BY l_orderkey
                                      ORDER BY l_linenumber, l_partkey, l_quantity) - 1) / 1000)
            AS BIGINT) AS part,
       l_linenumber, l_partkey, l_quantity
FROM lineitem
""")
def nest_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")["lineitem"]
    nested = nest(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_quantity"])
    return unnest(nested, keep=["l_orderkey", "part"])


@register("nest_unnest_hot", """
SELECT parent, CAST(floor((row_number() OVER (PARTITION BY parent
                                              ORDER BY l_quantity, l_orderkey, l_linenumber, l_partkey) - 1) / 1000)
                    AS BIGINT) AS part,
       l_quantity, l_orderkey, l_linenumber, l_partkey
FROM (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN -1 ELSE l_suppkey END AS parent FROM lineitem)
""")
def nest_unnest_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One parent holds a third of all rows, with many equal order values."""
    li = load(spark, sf_dir, "lineitem")["lineitem"]
    li = li.withColumn("parent", F.when(F.col("l_orderkey") % 3 == 0, F.lit(-1).cast("bigint")).otherwise(F.col("l_suppkey")))
    nested = nest(li, ["parent"], ["l_orderkey", "l_linenumber", "l_partkey"], order_cols=["l_quantity"])
    return unnest(nested, keep=["parent", "part"])


@register("array_transform", """
SELECT l_orderkey, part,
       string_agg(CAST(CAST(round(l_quantity) AS BIGINT) AS VARCHAR), ','
                  ORDER BY l_linenumber, l_partkey, l_quantity) AS quantities
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
             CAST(floor((row_number() OVER (PARTITION BY l_orderkey
                                            ORDER BY l_linenumber, l_partkey, l_quantity) - 1) / 1000)
                  AS BIGINT) AS part
      FROM lineitem)
GROUP BY l_orderkey, part
""")
def array_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")["lineitem"]
    nested = nest(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_quantity"])
    mapped = map_items(nested, lambda x: F.round(x["l_quantity"]).cast("bigint").cast("string"))
    return mapped.select("l_orderkey", "part", F.array_join("mapped", ",").alias("quantities"))


# --- sinks and table management ----------------------------------------------------------

ORDER_YEARS = RangeBuckets("jaar", 1996, 2000, 1)
ORDER_YEARS_STEP3 = RangeBuckets("jaar", 1995, 2002, 3)


def _orders_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")["orders"]
    return o.select("o_orderkey", "o_custkey", "o_totalprice",
                    F.year("o_orderdate").cast("bigint").alias("jaar"))


@register("range_partition", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS BIGINT) AS jaar
FROM orders WHERE year(o_orderdate) BETWEEN 1997 AND 1998
""")
def range_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders_by_year")
    df = _orders_by_year(spark, sf_dir)
    write_range_partitioned(df, path, ORDER_YEARS)          # create
    write_range_partitioned(df, path, ORDER_YEARS)          # replace: same rows, once
    # The bucket column is layout only; rows outside the range sit in the
    # null bucket and are read back all the same.
    return read_range(spark, path, ORDER_YEARS, lo=1997, hi=1998).drop(ORDER_YEARS.partition_column)


@register("range_partition_step3", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS BIGINT) AS jaar
FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 2001
""")
def range_partition_step3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders_by_year3")
    write_range_partitioned(_orders_by_year(spark, sf_dir), path, ORDER_YEARS_STEP3)
    return read_range(spark, path, ORDER_YEARS_STEP3, lo=1996, hi=2001) \
        .drop(ORDER_YEARS_STEP3.partition_column)


@register("refresh_dataset", """
SELECT 'orders_snapshot' AS table_name, count(*) AS n_rows FROM orders
UNION ALL
SELECT 'events_snapshot' AS table_name, count(*) AS n_rows FROM events
""")
def refresh_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load(spark, sf_dir, "orders", "events")
    root = scratch_path(spark, "dataset")
    files = [f"{root}/files/orders_snapshot.parquet", f"{root}/files/events_snapshot.json",
             f"{root}/files/missing_table.parquet"]
    replace_table(t["orders"], files[0])
    write_ndjson(t["events"], files[1])
    name = root.rsplit("-", 1)[-1]
    for _ in range(2):   # create, then a full refresh of the same dataset
        tables = replace_dataset(spark, "test", f"snapshot_{name}", files,
                                 description="orders and events snapshot",
                                 location=f"{root}/db")
    counts = [spark.table(tb).agg(F.count(F.lit(1)).alias("n_rows"))
                   .select(F.lit(tb.split(".")[-1]).alias("table_name"), "n_rows")
              for tb in tables]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    drop_dataset(spark, dataset_name("test", f"snapshot_{name}"))  # the plan already points at the files
    return out


@register("folder_to_dataset", """
SELECT 'orders_kwb' AS table_name, count(*) AS n_rows FROM orders
UNION ALL
SELECT 'events_kwb' AS table_name, count(*) AS n_rows FROM events
""")
def folder_to_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table file below a prefix becomes a table of a dataset with a bare name."""
    t = load(spark, sf_dir, "orders", "events", "region")
    root = scratch_path(spark, "folder")
    replace_table(t["orders"], f"{root}/files/cbs/kwb/2020/orders_kwb.parquet")
    write_ndjson(t["events"], f"{root}/files/cbs/kwb2/events_kwb.json")
    replace_table(t["region"], f"{root}/files/cbs/other/region.parquet")
    name = "kwb_" + root.rsplit("-", 1)[-1]
    tables = replace_dataset_from_folder(spark, f"{root}/files", "cbs/kwb", name, location=f"{root}/db")
    out = None
    for tb in tables:
        n = spark.table(tb).agg(F.count(F.lit(1)).alias("n_rows")) \
                 .select(F.lit(tb.split(".")[-1]).alias("table_name"), "n_rows")
        out = n if out is None else out.unionByName(n)
    drop_dataset(spark, name)
    return out


def _write_lineitem_dataset(spark: SparkSession, sf_dir: str, root: str) -> None:
    t = load(spark, sf_dir, "lineitem", "part", "supplier")
    fact = t["lineitem"].select(
        F.concat(F.year("l_shipdate").cast("string"), F.lit("JJ00")).alias("Perioden"),
        F.col("l_partkey").cast("string").alias("Part"),
        F.col("l_suppkey").cast("string").alias("Supplier"),
        F.col("l_quantity").alias("Quantity_1"),
        F.col("l_extendedprice").alias("ExtendedPrice_2"))
    replace_table(fact, f"{root}/LI01_TypedDataSet.parquet")
    replace_table(t["part"].select(F.col("p_partkey").cast("string").alias("Key"),
                                   F.col("p_name").alias("Title")), f"{root}/LI01_Part.parquet")
    replace_table(t["supplier"].select(F.col("s_suppkey").cast("string").alias("Key"),
                                       F.col("s_name").alias("Title")),
                  f"{root}/LI01_Supplier.parquet")
    props = spark.createDataFrame(
        [("Perioden", "Perioden", "TimeDimension"), ("Part", "Part", "Dimension"),
         ("Supplier", "Supplier", "Dimension"), ("Quantity_1", "Quantity", "Topic"),
         ("ExtendedPrice_2", "Extended price", "Topic")], "Key string, Title string, Type string")
    replace_table(props, f"{root}/LI01_DataProperties.parquet")


@register("dataset_group", """
SELECT p.Key AS part_code, p.Title AS part, s.Key AS supplier_code, s.Title AS supplier,
       fct.l_quantity AS quantity, fct.l_extendedprice AS extended_price
FROM lineitem AS fct
JOIN (SELECT CAST(p_partkey AS VARCHAR) AS Key, p_name AS Title FROM part) AS p
  ON p.Key = CAST(fct.l_partkey AS VARCHAR)
JOIN (SELECT CAST(s_suppkey AS VARCHAR) AS Key, s_name AS Title FROM supplier) AS s
  ON s.Key = CAST(fct.l_suppkey AS VARCHAR)
""")
def dataset_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "cbs")
    _write_lineitem_dataset(spark, sf_dir, root)
    return flatten_dataset(spark, root, "LI01")


@register("file_listing", """
SELECT 'grp=' || l_returnflag || '_' || l_linestatus || '_v1' AS folder,
       '.parquet' AS suffix, 'snappy' AS table_id, count(*) AS n_rows
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")["lineitem"]
    root = scratch_path(spark, "tree")
    grp = F.concat("l_returnflag", F.lit("-"), "l_linestatus", F.lit(".v1"))
    # The codec is part of the file names the listing reports: fix it.
    li.select("l_orderkey", "l_linenumber", grp.alias("grp")) \
      .write.mode("overwrite").option("compression", "snappy").partitionBy("grp").parquet(root)
    files = with_path_parts(list_prefix(spark, root, "grp="))
    rows = (spark.read.parquet(root).select(F.col("_metadata.file_path").alias("path"))
                 .groupBy("path").agg(F.count(F.lit(1)).alias("n")))
    joined = files.join(rows, "path", "left")
    folder = clean_name_col(paths.last_segment(F.col("parent")))
    return (joined.groupBy(folder.alias("folder"), "suffix", "table_id")
                  .agg(F.sum("n").alias("n_rows")))


# --- scans: files staged from the tables, read back by the loaders ----------------------

_CUSTOMER_TYPES = {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"}


@register("roundtrip_csv_latin1", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, replace(c_mktsegment, 'E', 'É') AS c_mktsegment
FROM customer
""")
def roundtrip_csv_latin1(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")["customer"]
    root = scratch_path(spark, "latin1")
    (c.withColumn("c_mktsegment", F.regexp_replace("c_mktsegment", "E", "É"))
      .write.option("sep", ";").option("encoding", "ISO-8859-1").option("header", True)
      .csv(f"{root}/customer_csv"))
    text = read_delimited(spark, f"{root}/customer_csv", sep=";", encoding="8859")
    replace_table(cast_columns(text, _CUSTOMER_TYPES), f"{root}/customer.parquet")
    return spark.read.parquet(f"{root}/customer.parquet")


@register("roundtrip_ndjson", "SELECT * FROM events")
def roundtrip_ndjson(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")["events"]
    root = scratch_path(spark, "ndjson")
    write_ndjson(e.where(F.col("event_type") == "error"), f"{root}/errors")
    write_ndjson(e.where(F.col("event_type") != "error"), f"{root}/other")
    files = input_files(spark, [f"{root}/errors", f"{root}/other"])
    schema = e.schema
    return load_ndjson_files(spark, files, f"{root}/events_table", schema=schema)


_REGISTER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"]


def _register_layout(staged: DataFrame, extra: int = 0, date_cols: list[str] | None = None) -> Layout:
    """Fixed-width layout of the staged order register: as wide as its longest values."""
    widest = staged.agg(*[F.max(F.length(F.col(c).cast("string"))).alias(c) for c in _REGISTER_COLUMNS]).first()
    least = [len(c) if extra else 1 for c in _REGISTER_COLUMNS]
    return Layout(_REGISTER_COLUMNS, [max(widest[c] or 1, n) + extra for c, n in zip(_REGISTER_COLUMNS, least)],
                  date_cols=date_cols or [])


@register("roundtrip_fwf", """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderstatus = 'P' OR (o_orderpriority = '5-LOW' AND o_orderstatus = 'O')
            THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS o_orderdate,
       o_orderpriority, o_orderstatus
FROM orders
""")
def roundtrip_fwf(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")["orders"]
    root = scratch_path(spark, "fwf")
    # Dates as a number would store them: leading zero lost; plus impossible dates.
    date_text = (F.when(F.col("o_orderstatus") == "P", F.lit("00000000"))
                  .when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "O"),
                        F.lit("31022020"))
                  .otherwise(F.regexp_replace(F.date_format("o_orderdate", "ddMMyyyy"), "^0+", "")))
    staged = o.select("o_orderkey", "o_custkey", date_text.alias("o_orderdate"),
                      "o_orderpriority", "o_orderstatus")
    layout = _register_layout(staged, date_cols=["o_orderdate"])
    write_fixed_width(staged, root, layout, header=False,
                      right_align=["o_orderkey", "o_custkey", "o_orderdate"])
    df = read_fixed_width(spark, root, layout)
    return cast_columns(df, {"o_orderkey": "bigint", "o_custkey": "bigint"})


@register("fwf_infer", """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%d%m%Y') AS o_orderdate,
       o_orderpriority, o_orderstatus
FROM orders
""")
def fwf_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")["orders"]
    root = scratch_path(spark, "fwf_header")
    staged = o.select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "ddMMyyyy").alias("o_orderdate"),
                      "o_orderpriority", "o_orderstatus")
    write_fixed_width(staged, root, _register_layout(staged, extra=2), header=True)
    df = read_fixed_width_inferred(spark, root, header=True)
    return cast_columns(df, {"o_orderkey": "bigint", "o_custkey": "bigint"})


# Filler lines under the header of a statistical sheet export.
SHEET_FILLER = ["eenheid;;aantal;euro;", ""]


@register("sheet_skiprows", """
SELECT c_custkey, c_name,
       CASE WHEN c_nationkey IN (3, 7) THEN NULL ELSE c_acctbal END AS c_acctbal,
       c_mktsegment,
       CAST(c_nationkey AS DOUBLE) AS c_nationkey
FROM customer
""")
def sheet_skiprows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")["customer"]
    root = scratch_path(spark, "sheets")
    na = (F.when(F.col("c_nationkey") == 3, F.lit(SHEET_NA_TOKENS[0]))
           .when(F.col("c_nationkey") == 7, F.lit(SHEET_NA_TOKENS[1]))
           .otherwise(F.col("c_acctbal").cast("string")))
    # A column that mixes plain numbers with decimal-comma text ("5,0").
    mixed = F.when(F.col("c_acctbal") < 0, F.concat(F.col("c_nationkey").cast("string"), F.lit(",0"))) \
             .otherwise(F.col("c_nationkey").cast("string"))
    staged = c.select("c_custkey", "c_name", na.alias("c_acctbal"), "c_mktsegment",
                      mixed.alias("c_nationkey"))
    # Two years of sheets with other columns first and other filler lines; the folder
    # carries the year of the first, its files a plus sign.
    odd = F.col("c_custkey") % 2 == 1
    files = stage_sheet_exports(staged.where(odd), f"{root}/export 2015", SHEET_FILLER, sep=";",
                                name="a+b 2015")
    files += stage_sheet_exports(staged.where(~odd).select(*reversed(staged.columns)), f"{root}/export 2015",
                                 SHEET_FILLER[:1], sep=";", name="c 2016")
    df = read_sheet_export(spark, files, sep=";", skip_rows={"2015": [1, 2], "2016": [1]},
                           types={"c_custkey": "bigint", "c_acctbal": "double"})
    return df.select(*staged.columns).withColumn("c_nationkey", parse_decimal_comma("c_nationkey"))


@register("yearly_files", """
SELECT o_orderkey, o_custkey, o_totalprice,
       CASE WHEN year(o_orderdate) = 1998 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       CAST(year(o_orderdate) AS INTEGER) AS jaar
FROM orders
""")
def yearly_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")["orders"]
    root = scratch_path(spark, "yearly")
    staged = o.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
                      F.year("o_orderdate").alias("year"))
    stage_yearly_files(staged, root, "year", {1998: ["o_orderpriority"]})
    df = read_yearly(spark, root, sep=";")
    df = cast_columns(df, {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"})
    return df.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "jaar")


@register("xml_records", """
SELECT id, c_name AS naam, c_acctbal AS saldo, c_nationkey AS land, c_mktsegment AS segment,
       CAST(to_json({'@id': id, 'adres': {'land': CAST(c_nationkey AS VARCHAR), 'segment': c_mktsegment},
                     'naam': c_name, 'saldo': CAST(c_acctbal AS VARCHAR)}) AS VARCHAR) AS json
FROM (SELECT *, """ + _padded("CAST(c_custkey AS VARCHAR)", 16) + """ AS id FROM customer)
""")
def xml_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")["customer"]
    root = scratch_path(spark, "xml")
    # Register ids are 16 digits that begin with zeros.
    staged = c.select(pad_code(F.col("c_custkey").cast("string"), 16).alias("id"),
                      F.col("c_name").alias("naam"), F.col("c_acctbal").alias("saldo"),
                      F.col("c_nationkey").alias("land"), F.col("c_mktsegment").alias("segment"),
                      (F.col("c_nationkey") == 0).alias("own_ns"))
    stage_xml(staged, root, "Nummeraanduiding", "id", ["naam", "saldo"], "adres",
              ["land", "segment"], "own_ns")
    rec = read_xml_records(spark, root, "Nummeraanduiding")
    return rec.select(F.col("`@id`").alias("id"), "naam", F.col("saldo").cast("double").alias("saldo"),
                      F.col("adres.land").cast("int").alias("land"), F.col("adres.segment").alias("segment"),
                      record_json(F.col("`@id`"), "adres", "naam", "saldo").alias("json"))


_CUSTOMER_ELEMENT = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@register("json_envelope", "SELECT * FROM customer")
def json_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")["customer"]
    root = scratch_path(spark, "envelope")
    envelope_pages(c, F.floor(F.col("c_custkey") / 100)).write.text(root)
    rows = read_envelope(spark, root, "value", StructType.fromDDL(_CUSTOMER_ELEMENT), multi_line=True)
    return rows.select(*[get_key(F.struct("*"), n).alias(n) for n in c.columns])


@register("portal_resources", """
SELECT 'ds-' || CAST(page_id AS VARCHAR) AS name, url FROM pages
WHERE url LIKE 'https%' AND url LIKE '%.zip%'
UNION ALL
SELECT 'ds-' || CAST(page_id AS VARCHAR) AS name, regexp_replace(url, '[?#].*$', '') || '.zip' AS url
FROM pages WHERE url LIKE 'https%'
""")
def portal_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "pages")["pages"]
    root = scratch_path(spark, "portal")
    ds = p.select(F.concat(F.lit("ds-"), F.col("page_id").cast("string")).alias("name"),
                  F.when(F.col("url").startswith("https"), F.lit("dataset"))
                   .otherwise(F.lit("harvest")).alias("type"),
                  F.array(F.struct(F.col("url").alias("url")),
                          F.struct(F.concat(F.regexp_replace("url", "[?#].*$", ""), F.lit(".zip"))
                                   .alias("url"))).alias("resources"),
                  F.floor(F.col("page_id") / 50).alias("__page"))
    responses = (ds.groupBy("__page")
                   .agg(F.collect_list(F.struct("name", "type", "resources")).alias("results"))
                   .select(F.to_json(F.struct(F.lit(True).alias("success"),
                                              F.struct("results").alias("result"))).alias("value")))
    responses.write.text(root)
    found = portal_datasets(spark.read.json(root), strict=True)
    return resource_urls(found, ".zip")


@register("zip_expand", """
SELECT 'csv' AS kind, c_custkey, c_name, c_mktsegment FROM customer
UNION ALL
SELECT 'txt' AS kind, c_custkey, c_name, c_mktsegment FROM customer
""")
def zip_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")["customer"]
    root = scratch_path(spark, "zips")
    layout = Layout(["c_custkey", "c_name", "c_mktsegment"], [12, 22, 14])
    stage_zips(c.select(*layout.names), f"{root}/in", layout)
    members = expand_archives(spark, f"{root}/in", f"{root}/out")
    out = convert_members(spark, members, f"{root}/converted")
    rows = None
    for kind, fmt in (("csv", "parquet"), ("txt", "json")):
        part = spark.read.format(fmt).load([p for _, p, f in out if f == fmt]) \
            .select(F.lit(kind).alias("kind"), "c_custkey", "c_name", "c_mktsegment")
        rows = part if rows is None else rows.unionByName(part)
    return cast_columns(rows, {"c_custkey": "bigint"})


ROWS_PER_ARCHIVE = 5000


@register("zip_to_dataset", """
SELECT c_custkey, c_name, c_mktsegment FROM customer
UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer
""")
def zip_to_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives to a dataset with one table per member; the rows of all its tables are read back."""
    c = load(spark, sf_dir, "customer")["customer"]
    root = scratch_path(spark, "zipset")
    layout = Layout(["c_custkey", "c_name", "c_mktsegment"], [12, 22, 14])
    archives = -(-c.count() // ROWS_PER_ARCHIVE)
    stage_zips(c.select(*layout.names).repartition(max(1, archives)), f"{root}/in", layout)
    members = expand_archives(spark, f"{root}/in", f"{root}/out")
    found = list_members(spark, f"{root}/in")
    if found.count() != members.count():
        raise RuntimeError("listed and expanded members differ")
    out = convert_members(spark, members, f"{root}/converted")
    name = root.rsplit("-", 1)[-1]
    tables = replace_dataset(spark, "zip", name, out, location=f"{root}/db")
    rows = None
    for _, table in read_tables(spark, tables):
        part = table.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", "c_mktsegment")
        rows = part if rows is None else rows.unionByName(part)
    drop_dataset(spark, dataset_name("zip", name))
    return rows


@register("zip_empty_members", """
WITH batch AS (SELECT 2 * (c_custkey // 5000) + c_custkey % 2 AS batch, count(*) AS n, sum(c_custkey) AS keys FROM customer GROUP BY 1)
SELECT batch, member, columns, CASE WHEN filled THEN n ELSE 0 END AS n_rows,
       CASE WHEN filled THEN CAST(keys AS BIGINT) ELSE 0 END AS key_sum
FROM batch CROSS JOIN (VALUES ('rows', 'c_custkey,c_name,c_mktsegment', true), ('head', 'c_custkey,c_name,c_mktsegment', false),
                              ('none', '_c0', false), ('lines', 'c_custkey,c_name,c_mktsegment', true),
                              ('names', 'c_custkey,c_name,c_mktsegment', false)) AS m(member, columns, filled)
""")
def zip_empty_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every member becomes a table: those of a header alone and empty ones have no rows."""
    c = load(spark, sf_dir, "customer")["customer"]
    root = scratch_path(spark, "zipempty")
    layout = Layout(["c_custkey", "c_name", "c_mktsegment"], [12, 22, 14])
    staged = c.select(*layout.names, F.expr("2 * (c_custkey div 5000) + c_custkey % 2").alias("batch"))
    stage_member_zips(staged, f"{root}/in", "batch", layout)
    members = expand_archives(spark, f"{root}/in", f"{root}/out")
    name = root.rsplit("-", 1)[-1]
    tables = replace_dataset(spark, "zip", name, convert_members(spark, members, f"{root}/converted"), location=f"{root}/db")
    listed, rows = [], None
    for names, table in read_tables(spark, tables, "name"):
        columns = [c for c in table.columns if c != "name"]
        listed += [(t, ",".join(columns)) for t in names]
        key = F.col("c_custkey").cast("bigint") if "c_custkey" in columns else F.lit(None).cast("bigint")
        part = table.select("name", key.alias("key"))
        rows = part if rows is None else rows.unionByName(part)
    drop_dataset(spark, dataset_name("zip", name))
    counted = rows.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sum("key").alias("key_sum"))
    pattern = r"batch_(\d+)_set_(\w+)$"
    return spark.createDataFrame(listed, "name string, columns string").join(counted, "name", "left").select(
        F.regexp_extract("name", pattern, 1).cast("bigint").alias("batch"), F.regexp_extract("name", pattern, 2).alias("member"),
        "columns", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce("key_sum", F.lit(0)).cast("bigint").alias("key_sum"))


@register("assign_names", """
SELECT c_custkey AS code, c_name AS naam FROM customer
UNION ALL SELECT o_orderkey AS code, o_orderpriority AS naam FROM orders
""")
def assign_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unnamed columns of registers without a header get a fixed list of names."""
    t = load(spark, sf_dir, "customer", "orders")
    root = scratch_path(spark, "unnamed")
    t["customer"].select("c_custkey", "c_name").write.csv(f"{root}/customer")
    t["orders"].select("o_orderkey", "o_orderpriority").write.csv(f"{root}/orders")
    raw = read_delimited(spark, [f"{root}/customer", f"{root}/orders"], header=False)
    return cast_columns(assign_columns(raw, ["code", "naam"]), {"code": "bigint"})


# --- incremental loads ------------------------------------------------------------------------

@register("incremental_load", "SELECT * FROM events")
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")["events"]
    root = scratch_path(spark, "incremental")
    src, target, ckpt = f"{root}/landing", f"{root}/events_table", f"{root}/_checkpoint"
    write_ndjson(e.where(F.col("event_type") == "error"), f"{src}/arrival_1")
    first = load_new_files(spark, src, target, ckpt, e.schema)
    write_ndjson(e.where(F.col("event_type") != "error"), f"{src}/arrival_2")
    second = load_new_files(spark, src, target, ckpt, e.schema)
    again = load_new_files(spark, src, target, ckpt, e.schema)   # nothing new: nothing loaded
    if again != 0 or first == 0 or second == 0:
        raise RuntimeError(f"incremental load appended {first}, {second}, {again} rows")
    return spark.read.parquet(target)


@register("mart_partitioned_read", _LEFT_STAR_SQL.rstrip() + """
  AND CAST(substr(CAST(fct.l_shipdate AS VARCHAR), 1, 4) AS BIGINT) >= 1999
""")
def mart_partitioned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The left-star mart written as a range-partitioned table, read back for
    the years from 1999 (partition pruning on the bucket column)."""
    path = scratch_path(spark, "mart_partitioned")
    write_mart(LEFT_STAR, mart_left_star(spark, sf_dir), path)
    spec = LEFT_STAR.partition
    return read_range(spark, path, spec, lo=1999).drop(spec.partition_column)


# --- the statistical marts themselves, on datasets derived from the tables ------------------

def _codes_from_fact(spark: SparkSession, root: str, fact: DataFrame,
                     names: list[str]) -> dict[str, DataFrame]:
    """The distinct codes of several dimension columns of a stored fact, in one
    pass (one aggregation over (dimension, code) pairs), stored once; each
    dimension is then a filter on that small table."""
    pairs = fact.select(F.explode(F.array(*[F.struct(F.lit(n).alias("dim"), F.col(n).alias("Key"))
                                            for n in names])).alias("p")).select("p.*").distinct()
    codes = _stored(spark, root, "dimension_codes", pairs)
    return {n: codes.where(F.col("dim") == n).select("Key") for n in names}


def _stored(spark: SparkSession, root: str, name: str, df: DataFrame) -> DataFrame:
    """Write a derived fact table to the shared folder and read it back: it
    is then stored, as a loaded statistical dataset is, and the dimension
    tables derived from it do not recompute its lineage."""
    path = f"{root}/{name}.parquet"
    replace_table(df, path)
    return spark.read.parquet(path)


def _population_dataset(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """A population-shaped dataset (83502NED) derived from lineitem: counts per
    period, "postcode" (supplier), "sex" (return flag) and "age" (line
    status), with the subtotal rows a statistical table carries (cube), and
    dimension tables including the total codes the mart drops."""
    t = load(spark, sf_dir, "lineitem", "supplier")
    li = t["lineitem"].select(F.concat(F.year("l_shipdate").cast("string"), F.lit("JJ00")).alias("Perioden"),
                              F.col("l_suppkey").cast("string").alias("Postcode"),
                              F.col("l_returnflag").alias("Geslacht"),
                              F.col("l_linestatus").alias("Leeftijd"), "l_quantity")
    root = scratch_path(spark, "83502NED")
    area = ["Postcode", "Geslacht", "Leeftijd"]
    fact = _stored(spark, root, "83502NED_TypedDataSet", (
        # rows are added up first; the subtotals are the eight grouping sets that keep the period
        li.groupBy("Perioden", *area).agg(F.sum("l_quantity").alias("l_quantity"))
          .groupingSets([["Perioden", *s] for k in range(4) for s in combinations(area, k)], "Perioden", *area)
          .agg(F.sum("l_quantity").alias("Bevolking_1"))
          .select("Perioden",
                  F.coalesce("Postcode", F.lit("NL01")).alias("Postcode"),
                  F.coalesce("Geslacht", F.lit("T001038")).alias("Geslacht"),
                  F.coalesce("Leeftijd", F.lit("10000")).alias("Leeftijd"),
                  "Bevolking_1")))
    postcode = t["supplier"].select(F.col("s_suppkey").cast("string").alias("Key"),
                                    F.col("s_name").alias("Title")) \
        .unionByName(spark.createDataFrame([("NL01", "Nederland")], "Key string, Title string"))
    # Codes of the other dimensions as the stored fact has them (totals included).
    codes = _codes_from_fact(spark, root, fact, ["Geslacht", "Leeftijd"])
    sex = codes["Geslacht"].select(
        "Key", F.when(F.col("Key") == "T001038", F.lit("Totaal"))
                .otherwise(F.concat(F.lit("flag "), "Key")).alias("Title"))
    age = codes["Leeftijd"].select(
        "Key", F.when(F.col("Key") == "10000", F.lit("Totaal"))
                .otherwise(F.concat(F.lit("status "), "Key")).alias("Title"))
    return {"83502NED_TypedDataSet": fact, "83502NED_Postcode": postcode,
            "83502NED_Geslacht": sex, "83502NED_Leeftijd": age}


@register("cbs_population_mart", """
WITH li AS (
  SELECT CAST(year(l_shipdate) AS VARCHAR) || 'JJ00' AS Perioden, CAST(l_suppkey AS VARCHAR) AS Postcode,
         l_returnflag AS Geslacht, l_linestatus AS Leeftijd, l_quantity FROM lineitem),
fct AS (
  SELECT Perioden, COALESCE(Postcode, 'NL01') AS Postcode, COALESCE(Geslacht, 'T001038') AS Geslacht,
         COALESCE(Leeftijd, '10000') AS Leeftijd, sum(l_quantity) AS Bevolking_1
  FROM li GROUP BY CUBE (Perioden, Postcode, Geslacht, Leeftijd) HAVING Perioden IS NOT NULL),
pc AS (SELECT CAST(s_suppkey AS VARCHAR) AS Key, s_name AS Title FROM supplier
       UNION ALL SELECT 'NL01', 'Nederland'),
gsl AS (SELECT DISTINCT l_returnflag AS Key, 'flag ' || l_returnflag AS Title FROM lineitem
        UNION ALL SELECT 'T001038', 'Totaal'),
lft AS (SELECT DISTINCT l_linestatus AS Key, 'status ' || l_linestatus AS Title FROM lineitem
        UNION ALL SELECT '10000', 'Totaal')
SELECT CAST(substr(fct.Perioden, 1, 4) AS BIGINT) AS jaar, pc.Title AS pc4, gsl.Title AS geslacht,
       lft.Title AS leeftijd, CAST(round(fct.Bevolking_1) AS BIGINT) AS bevolking
FROM fct
LEFT JOIN pc ON pc.Key = fct.Postcode
LEFT JOIN gsl ON gsl.Key = fct.Geslacht
LEFT JOIN lft ON lft.Key = fct.Leeftijd
WHERE pc.Key != 'NL01' AND gsl.Key != 'T001038' AND lft.Key != '10000'
""")
def cbs_population_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statmart.plans.marts import REFERENCE_MARTS
    return build_mart(REFERENCE_MARTS["bevolking_p4_leeftijd_geslacht"],
                      _population_dataset(spark, sf_dir))


def _district_dataset(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """A district key-figure dataset (84286NED) derived from customer: padded
    area codes (districts 'WK…' and neighbourhoods 'BU…'), municipality per
    nation, and one numeric topic per mart column."""
    from statmart.plans.marts import DISTRICT_TOPICS
    c = load(spark, sf_dir, "customer")["customer"]
    kind = F.when(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"), F.lit("WK")).otherwise(F.lit("BU"))
    code = pad_right(F.concat(kind, pad_code(F.col("c_custkey").cast("string"), 6)), 10)
    dim = c.select(code.alias("Key"), F.concat(F.lit(" "), "c_name").alias("Title"),
                   F.concat(F.lit("GM"), pad_code(F.col("c_nationkey").cast("string"), 4))
                    .alias("Municipality"))
    fact = c.select(code.alias("Codering_3"),
                    *[(F.col("c_acctbal") + j).alias(src) for j, (_, src) in enumerate(DISTRICT_TOPICS)])
    return {"84286NED_TypedDataSet": fact, "84286NED_WijkenEnBuurten": dim}


_DISTRICT_CODE_SQL = _padded("(CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'WK' ELSE 'BU' END || "
                             + _padded("CAST(c_custkey AS VARCHAR)", 6) + ")", 10, " ", "r")


def _district_sql() -> str:
    from statmart.plans.marts import DISTRICT_TOPICS
    topics = ",\n       ".join(f"fct.{src} AS {out}" for out, src in DISTRICT_TOPICS)
    derived = ",\n         ".join(f"c_acctbal + {j} AS {src}" for j, (_, src) in enumerate(DISTRICT_TOPICS))
    return f"""
WITH codes AS (
  SELECT *, {_DISTRICT_CODE_SQL} AS code FROM customer),
wkbu AS (SELECT code AS Key, ' ' || c_name AS Title,
                'GM' || {_padded("CAST(c_nationkey AS VARCHAR)", 4)} AS Municipality FROM codes),
fct AS (SELECT code AS Codering_3,
         {derived}
        FROM codes)
SELECT 2018 AS jaar, wkbu.Municipality AS gemeente_code, TRIM(fct.Codering_3) AS wijk_code,
       {topics}
FROM fct JOIN wkbu ON wkbu.Key = fct.Codering_3
WHERE fct.Codering_3 LIKE 'WK%'
ORDER BY gemeente_code, wijk_code
"""


@register("cbs_district_mart", _district_sql())
def cbs_district_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statmart.plans.marts import REFERENCE_MARTS
    return build_mart(REFERENCE_MARTS["kerncijfers_wijken_en_buurten"], _district_dataset(spark, sf_dir))


@register("cbs_district_dimension", f"""
SELECT TRIM(Key) AS wijk_code, TRIM(Title) AS wijk_naam
FROM (SELECT {_DISTRICT_CODE_SQL} AS Key, ' ' || c_name AS Title FROM customer)
WHERE Key LIKE 'WK%'
ORDER BY Key
""")
def cbs_district_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statmart.plans.marts import REFERENCE_MARTS
    return build_mart(REFERENCE_MARTS["dim_wijken_2018"], _district_dataset(spark, sf_dir))


def _care_codes():
    """Code columns of a care-use dataset (40060NED) derived from lineitem;
    some values are the subtotal codes the mart drops."""
    return {
        "Perioden": F.concat(F.year("l_shipdate").cast("string"),
                             F.when(F.col("l_linestatus") == "O", F.lit("KW01")).otherwise(F.lit("JJ00"))),
        "Geslacht": F.when(F.col("l_returnflag") == "R", F.lit("T001038")).otherwise(F.col("l_returnflag")),
        "Leeftijd": F.when(F.col("l_linenumber") == 1, F.lit("20300"))
                     .when(F.col("l_linenumber") == 2, F.lit("90120"))
                     .otherwise(F.concat(F.lit("5202"), F.col("l_linenumber").cast("string"))),
        "Huishouden": F.when(F.col("l_tax") == 0, F.lit("T001139"))
                       .otherwise(F.concat(F.lit("H"), F.round(F.col("l_tax") * 100).cast("int").cast("string"))),
        "TypeMaatwerkvoorziening": F.when(F.col("l_discount") == 0, F.lit("T001024"))
                                    .otherwise(F.concat(F.lit("D"), F.round(F.col("l_discount") * 100)
                                                        .cast("int").cast("string"))),
        "LeveringsvormZorg": F.when(F.month("l_shipdate") == 12, F.lit("T001306"))
                              .otherwise(F.concat(F.lit("L"), F.month("l_shipdate").cast("string"))),
        "RegioS": F.concat(F.when(F.col("l_quantity") > 45, F.lit("PV")).otherwise(F.lit("GM")),
                           pad_code(F.col("l_suppkey").cast("string"), 4)),
    }


def _care_dataset(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    li = load(spark, sf_dir, "lineitem")["lineitem"]
    codes = _care_codes()
    coded = li.select(*[c.alias(n) for n, c in codes.items()], "l_quantity")
    root = scratch_path(spark, "40060NED")
    fact = _stored(spark, root, "40060NED_TypedDataSet", coded.groupBy(*codes).agg(
        F.count(F.lit(1)).cast("double").alias("PersonenMetGebruikInJaar_1"),
        F.sum("l_quantity").alias("PersonenMetGebruikInJaar_2")))
    out = {"40060NED_TypedDataSet": fact}
    for name, keys in _codes_from_fact(spark, root, fact, list(codes)).items():
        out[f"40060NED_{name}"] = keys.select("Key", F.concat(F.lit(f"{name} "), "Key").alias("Title"))
    # Some regions have no dimension row, one form of delivery has two.
    out["40060NED_RegioS"] = out["40060NED_RegioS"].where(~F.col("Key").endswith("7"))
    forms = out["40060NED_LeveringsvormZorg"]
    out["40060NED_LeveringsvormZorg"] = forms.unionByName(
        forms.where("Key = 'L1'").withColumn("Title", F.lit("LeveringsvormZorg L1 (oud)")))
    return out


_CARE_SQL_CODES = f"""
  SELECT CAST(year(l_shipdate) AS VARCHAR) || CASE WHEN l_linestatus = 'O' THEN 'KW01' ELSE 'JJ00' END AS Perioden,
         CASE WHEN l_returnflag = 'R' THEN 'T001038' ELSE l_returnflag END AS Geslacht,
         CASE WHEN l_linenumber = 1 THEN '20300' WHEN l_linenumber = 2 THEN '90120'
              ELSE '5202' || CAST(l_linenumber AS VARCHAR) END AS Leeftijd,
         CASE WHEN l_tax = 0 THEN 'T001139'
              ELSE 'H' || CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) END AS Huishouden,
         CASE WHEN l_discount = 0 THEN 'T001024'
              ELSE 'D' || CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) END AS TypeMaatwerkvoorziening,
         CASE WHEN month(l_shipdate) = 12 THEN 'T001306'
              ELSE 'L' || CAST(month(l_shipdate) AS VARCHAR) END AS LeveringsvormZorg,
         CASE WHEN l_quantity > 45 THEN 'PV' ELSE 'GM' END || {_padded("CAST(l_suppkey AS VARCHAR)", 4)} AS RegioS,
         l_quantity
  FROM lineitem"""


def _care_dimensions_sql() -> str:
    names = ["Perioden", "Geslacht", "Leeftijd", "Huishouden", "TypeMaatwerkvoorziening", "LeveringsvormZorg", "RegioS"]
    extra = {"LeveringsvormZorg": " UNION ALL SELECT 'L1', 'LeveringsvormZorg L1 (oud)'",
             "RegioS": " WHERE NOT ends_with(RegioS, '7')"}
    return ",\n".join(f"d{i} AS (SELECT DISTINCT {n} AS Key, '{n} ' || {n} AS Title FROM fct{extra.get(n, '')})"
                      for i, n in enumerate(names))


@register("cbs_care_use_mart", f"""
WITH coded AS ({_CARE_SQL_CODES}),
fct AS (
  SELECT Perioden, Geslacht, Leeftijd, Huishouden, TypeMaatwerkvoorziening, LeveringsvormZorg, RegioS,
         CAST(count(*) AS DOUBLE) AS PersonenMetGebruikInJaar_1, sum(l_quantity) AS PersonenMetGebruikInJaar_2
  FROM coded GROUP BY ALL),
{_care_dimensions_sql()}
SELECT CAST(substr(fct.Perioden, 1, 4) AS BIGINT) AS jaar,
       d6.Key AS gemeente_code, d6.Title AS gemeente_naam, d1.Title AS geslacht, d2.Title AS leefijd,
       d3.Key AS huishouden_code, d3.Title AS huishouden_omschrijving, d4.Title AS voorziening,
       d5.Title AS leveringsvorm,
       fct.PersonenMetGebruikInJaar_1 AS gebruik_aantal_personen,
       fct.PersonenMetGebruikInJaar_2 AS gebruik_percentage
FROM fct JOIN d0 ON d0.Key = fct.Perioden JOIN d1 ON d1.Key = fct.Geslacht JOIN d2 ON d2.Key = fct.Leeftijd
JOIN d3 ON d3.Key = fct.Huishouden JOIN d4 ON d4.Key = fct.TypeMaatwerkvoorziening
JOIN d5 ON d5.Key = fct.LeveringsvormZorg JOIN d6 ON d6.Key = fct.RegioS
WHERE fct.Perioden LIKE '%JJ%' AND fct.RegioS LIKE 'GM%' AND fct.Geslacht != 'T001038'
  AND fct.Leeftijd NOT IN ('20300', '90120', '90200') AND fct.Huishouden != 'T001139'
  AND fct.TypeMaatwerkvoorziening != 'T001024' AND fct.LeveringsvormZorg != 'T001306'
""")
def cbs_care_use_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statmart.plans.marts import REFERENCE_MARTS
    return build_mart(REFERENCE_MARTS["gebruik_wmo_pgb_gemeente"], _care_dataset(spark, sf_dir))


_INCOME_TOPICS = (["ParticuliereHuishoudens_1", "ParticuliereHuishoudensRelatief_2",
                   "GemiddeldGestandaardiseerdInkomen_3", "MediaanGestandaardiseerdInkomen_4",
                   "GemiddeldBesteedbaarInkomen_5", "MediaanBesteedbaarInkomen_6"]
                  + [f"GestandaardiseerdInkomen{i}e10Groep_{i + 6}" for i in range(1, 11)])


def _income_dataset(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """An income dataset (84639NED) derived from orders ⋈ customer: region per
    nation (municipalities 'GM…', provinces 'PV…'), population by order status,
    household type by priority (one subtotal code, one total without 'Type:')."""
    t = load(spark, sf_dir, "orders", "customer")
    oc = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
    kvh = (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("1050015"))
            .when(F.col("o_orderpriority") == "2-HIGH", F.lit("1050055"))
            .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("1050020"))
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("1050025"))
            .otherwise(F.lit("1010000")))
    coded = oc.select(
        F.concat(F.year("o_orderdate").cast("string"), F.lit("JJ00")).alias("Perioden"),
        F.concat(F.when(F.col("c_acctbal") < 0, F.lit("PV")).otherwise(F.lit("GM")),
                 pad_code(F.col("c_nationkey").cast("string"), 4)).alias("Regio"),
        F.when(F.col("o_orderstatus") == "F", F.lit("1050010")).otherwise(F.lit("1050011")).alias("Populatie"),
        kvh.alias("KenmerkenVanHuishoudens"), "o_orderpriority", "o_totalprice")
    n = F.count(F.lit(1))
    root = scratch_path(spark, "84639NED")
    # Household types keep the priority text for their titles ("Type: …").
    fact = _stored(spark, root, "84639NED_TypedDataSet", coded.groupBy(
        "Perioden", "Regio", "Populatie", "KenmerkenVanHuishoudens", "o_orderpriority").agg(
        n.cast("double").alias(_INCOME_TOPICS[0]),
        F.sum(F.round("o_totalprice")).alias(_INCOME_TOPICS[1]),
        *[(n * k).cast("double").alias(name) for k, name in enumerate(_INCOME_TOPICS[2:], start=3)]))
    titled = F.when(F.col("KenmerkenVanHuishoudens") == "1010000", F.lit("Totaal")) \
              .otherwise(F.concat(F.lit("Type: "), substr_from("o_orderpriority", 3)))
    dims = {
        "84639NED_Regio": fact.select(F.col("Regio").alias("Key")).distinct()
                              .select("Key", F.concat(F.lit("Regio "), "Key").alias("Title")),
        "84639NED_Populatie": fact.select(F.col("Populatie").alias("Key")).distinct()
                                  .select("Key", F.concat(F.lit("Populatie "), "Key").alias("Title")),
        "84639NED_KenmerkenVanHuishoudens": fact.select(F.col("KenmerkenVanHuishoudens").alias("Key"),
                                                        titled.alias("Title")).distinct(),
    }
    return {"84639NED_TypedDataSet": fact.drop("o_orderpriority"), **dims}


def _income_sql() -> str:
    topics = ",\n         ".join(
        ["CAST(count(*) AS DOUBLE) AS " + _INCOME_TOPICS[0],
         f"sum(round(o_totalprice)) AS {_INCOME_TOPICS[1]}"]
        + [f"CAST(count(*) * {k} AS DOUBLE) AS {name}" for k, name in enumerate(_INCOME_TOPICS[2:], start=3)])
    select = """CAST(substr(fct.Perioden, 1, 4) AS BIGINT) AS jaar, regio.Key AS gemeente_code,
       regio.Title AS gemeente_naam, kvh.Key AS huishouden_code,
       substr(kvh.Title, 7) AS huishouden_omschrijving,
       fct.ParticuliereHuishoudens_1 AS particuliere_huishoudens_aantal,
       fct.ParticuliereHuishoudensRelatief_2 AS particuliere_huishoudens_relatief,
       fct.GemiddeldGestandaardiseerdInkomen_3 AS inkomen_gestandaardiseerd_gemiddeld,
       fct.MediaanGestandaardiseerdInkomen_4 AS inkomen_gestandaardiseerd_mediaan,
       fct.GemiddeldBesteedbaarInkomen_5 AS inkomen_besteedbaar_gemiddeld,
       fct.MediaanBesteedbaarInkomen_6 AS inkomen_besteedbaar_mediaan,
       """ + ",\n       ".join(f"fct.GestandaardiseerdInkomen{i}e10Groep_{i + 6} AS inkomensgroep_deciel_{i}"
                                for i in range(1, 11))
    return f"""
WITH coded AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) || 'JJ00' AS Perioden,
         CASE WHEN c_acctbal < 0 THEN 'PV' ELSE 'GM' END || {_padded("CAST(c_nationkey AS VARCHAR)", 4)} AS Regio,
         CASE WHEN o_orderstatus = 'F' THEN '1050010' ELSE '1050011' END AS Populatie,
         CASE o_orderpriority WHEN '1-URGENT' THEN '1050015' WHEN '2-HIGH' THEN '1050055'
              WHEN '3-MEDIUM' THEN '1050020' WHEN '4-NOT SPECIFIED' THEN '1050025'
              ELSE '1010000' END AS KenmerkenVanHuishoudens,
         o_orderpriority, o_totalprice
  FROM orders JOIN customer ON o_custkey = c_custkey),
fct AS (
  SELECT Perioden, Regio, Populatie, KenmerkenVanHuishoudens,
         {topics}
  FROM coded GROUP BY Perioden, Regio, Populatie, KenmerkenVanHuishoudens),
regio AS (SELECT DISTINCT Regio AS Key, 'Regio ' || Regio AS Title FROM coded),
pop AS (SELECT DISTINCT Populatie AS Key, 'Populatie ' || Populatie AS Title FROM coded),
kvh AS (SELECT DISTINCT KenmerkenVanHuishoudens AS Key,
               CASE WHEN KenmerkenVanHuishoudens = '1010000' THEN 'Totaal'
                    ELSE 'Type: ' || substr(o_orderpriority, 3) END AS Title FROM coded)
SELECT {select}
FROM fct
JOIN regio ON regio.Key = fct.Regio
JOIN pop ON pop.Key = fct.Populatie
JOIN kvh ON kvh.Key = fct.KenmerkenVanHuishoudens
WHERE fct.Regio LIKE 'GM%' AND fct.Populatie = '1050010' AND kvh.Title LIKE 'Type:%'
  AND fct.KenmerkenVanHuishoudens != '1050055'
"""


@register("cbs_income_mart", _income_sql())
def cbs_income_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statmart.plans.marts import REFERENCE_MARTS
    return build_mart(REFERENCE_MARTS["inkomen_huishouden_gemeente"], _income_dataset(spark, sf_dir))


@register("cbs_population_sql", ORACLE["cbs_population_mart"])
def cbs_population_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the derived population dataset → a dataset database with one
    file-backed table each → the templated population mart SQL over it."""
    root = scratch_path(spark, "cbs_population")
    uris = []
    for name, df in _population_dataset(spark, sf_dir).items():
        uris.append(f"{root}/files/{name}.parquet")
        replace_table(df, uris[-1])
    tag = root.rsplit("-", 1)[-1]
    replace_dataset(spark, "cbs", tag, uris, "population dataset", location=f"{root}/db")
    out = population_pc4(spark, project="", schema=dataset_name("cbs", tag))
    drop_dataset(spark, dataset_name("cbs", tag))  # the plan already points at the files
    return out
