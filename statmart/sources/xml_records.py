"""XML record sets.

Every element with the record tag becomes one row (nested elements → structs,
attributes → ``@name`` columns), namespaces ignored, so the tag is matched by
its local name. Namespace declarations are not data: with namespaces ignored
Spark shows ``xmlns:b="…"`` as a column ``@b``, so the declared prefixes are
found in the text first and those columns dropped. A declared prefix that is
also the name of a real attribute cannot be told apart and raises.

Records are cut out by byte ranges (:mod:`statmart.sources.ranges`) and parsed from their
own text, and the text pass reads pieces that end at ``>``, so documents may be of one line
and of any size. The schema is found on the distinct shapes of the records, in which any
value is one letter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from statmart.functions.columns import record_json
from statmart.sources.files import as_list
from statmart.sources.ranges import sized_files, xml_texts

NS_DECL = r"xmlns:([A-Za-z_][\w.-]*)\s*="
PARSING = {"ignoreNamespace": "true", "inferSchema": "false", "attributePrefix": "@", "valueTag": "#text"}


def declared_prefixes(spark: SparkSession, paths: str | Sequence[str]) -> tuple[set[str], set[str]]:
    """(namespace prefixes declared, plain attribute names used) in the files;
    one text pass, distinct names only reach the driver."""
    text = spark.read.option("recursiveFileLookup", "true").text(as_list(paths), lineSep=">")
    ns = text.select(F.explode(F.regexp_extract_all("value", F.lit(NS_DECL), 1)).alias("p"))
    attrs = text.select(F.explode(F.regexp_extract_all(
        F.regexp_replace("value", r"xmlns(:[\w.-]+)?\s*=\s*(\"[^\"]*\"|'[^']*')", ""),
        F.lit(r"\s([A-Za-z_][\w.:-]*)\s*=\s*[\"']"), 1)).alias("p")) \
        .where("NOT p RLIKE '^xmlns(:|$)'")  # a declaration whose value holds the end of its piece
    names = (ns.select(F.lit("ns").alias("kind"), "p")
               .unionByName(attrs.select(F.lit("attr").alias("kind"), "p"))
               .distinct().collect())
    prefixes = {r["p"] for r in names if r["kind"] == "ns"}
    plain = {r["p"].split(":")[-1] for r in names if r["kind"] == "attr"}
    return prefixes, plain


def record_schema(texts: DataFrame) -> StructType:
    """The schema of XML records (``value``): one pass, after which each shape is one row."""
    shape = F.regexp_replace("value", r"(?s)<!--.*?-->", "")
    shape = F.regexp_replace(shape, r"(?s)<!\[CDATA\[.*?\]\]>", "x")
    shape = F.regexp_replace(shape, r"=\s*(\"[^\"]*\"|'[^']*')", '="x"')
    shape = F.regexp_replace(shape, r">[^<]*[^<\s][^<]*<", ">x<")
    shapes = texts.select(shape.alias("shape")).distinct()
    # Spark infers from files or an RDD of texts
    return texts.sparkSession.read.options(**PARSING).xml(shapes.rdd.map(lambda r: r["shape"]), rowTag="record").schema


def read_xml_records(spark: SparkSession, paths: str | Sequence[str], row_tag: str,
                     schema=None, prefixes: set[str] | None = None, whole: bool = False) -> DataFrame:
    """Rows of every ``row_tag`` element, namespace declarations removed.

    ``prefixes`` (the declared namespace prefixes, when known) skips the text
    pass that finds them and checks them against attribute names; ``schema`` skips the
    pass that finds the columns. ``whole`` reads each file in one task, for records that
    hold others of their own tag. Without a record there are no columns.
    """
    if prefixes is None:
        prefixes, plain = declared_prefixes(spark, paths)
        clash = sorted(prefixes & plain)
        if clash:
            raise ValueError(f"namespace prefix equals an attribute name: {clash}")
    texts = xml_texts(spark, sized_files(spark, paths), row_tag.split(":")[-1], whole)
    # every value stays text: codes keep their leading zeros; cast explicitly afterwards
    schema = record_schema(texts) if schema is None else \
        schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if not schema.fields:
        return spark.createDataFrame([], schema)
    df = texts.select(F.from_xml("value", schema, PARSING).alias("r")).select("r.*")
    drop = [c for c in df.columns
            if c == "@xmlns" or c.startswith("@xmlns") or c[1:] in prefixes]
    return df.drop(*drop)


def records_as_json(df: DataFrame) -> DataFrame:
    """One JSON text per record (F12), ready for an NDJSON write (K2)."""
    return df.select(record_json(*[F.col(f"`{c}`") for c in df.columns]).alias("json"))
