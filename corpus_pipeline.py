"""Corpus cleaning pipeline over ``documents`` (doc_id, text, lang, source, n_chars).

Five stages, each on all that the one before kept; every stage's result is written as
Parquet below the shared folder and read again. All but the last return the columns of
``documents``; ``n_chars`` follows the text. Every decision is about a row, told apart by
doc_id and text, so rows that share a doc_id, or have none, do not touch each other. Texts
are taken whole at any length, and empty tables pass every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.llm.bpe import RANKS, bpe_digests
from statmart.llm.common import BATCH, TEXT_ROWS, stored, table
from statmart.llm.decontaminate import contamination
from statmart.llm.langid import fit_language_model, held_out, rows_told
from statmart.llm.linededup import dedup_lines
from statmart.llm.ngram_join import document_classes, row_key
from statmart.session import scratch_path, ship_package

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
BROADCAST_KEYS = 2_000_000  # of one long each; more are joined by a shuffle


def _with_key(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS).withColumn("row", row_key())


def _marked(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``docs`` (with ``row``) semi- or anti-joined with the row keys ``keys``."""
    keys = stored(keys.select("row").distinct(), "rowkeys")
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return docs.join(keys, "row", how)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that the labelled ones teach; if none is labelled, all.

    Every row is judged by its own text; null and empty texts go.
    """
    ship_package(spark)
    spark.conf.set(BATCH, TEXT_ROWS)
    docs = docs.select(*COLUMNS)
    return rows_told(docs, fit_language_model(docs.where(~held_out())))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines of any length and near-equal ones removed; a document that loses all it had goes."""
    ship_package(spark)
    done = dedup_lines(docs.select(*COLUMNS), least=1)
    left = (F.col("n_removed") == 0) | (F.trim(F.regexp_replace("text", "\\s+", " ")) != "")
    return done.where(left).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest doc_id.

    Groups are of rows, so another text under the doc_id of a copy stays. Among rows of the
    smallest doc_id the least row key stays, null ids come last, and of rows equal in doc_id
    and text one. Rows without a word stay.
    """
    ship_package(spark)
    classes = stored(document_classes(docs).where("root IS NOT NULL").select("root", "row", "doc_id"), "classes")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    first = classes.groupBy("root").agg(F.min(rank).alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = classes.select("row").distinct().count()
    grouped = classes.join(first.select("root", F.col("f.row").alias("keep")), "root")
    kept = _marked(_with_key(docs), grouped.where("row <> keep"), "left_anti")
    if members == classes.count():
        return kept.select(*COLUMNS)
    twice = stored(classes.groupBy("row").count().where("count > 1").select("row"), "repeated")
    return _marked(kept, twice, "left_anti").union(
        _marked(kept, twice, "left_semi").dropDuplicates(["row"])).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without any passage of the benchmark; another text under the doc_id of one that goes stays."""
    ship_package(spark)
    docs = _with_key(docs)
    found = contamination(docs.select(F.col("row").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"), scaled=True)
    return _marked(docs, found.select(F.col("doc_id").alias("row")), "left_anti").select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    ship_package(spark)
    spark.conf.set(BATCH, TEXT_ROWS)
    return bpe_digests(docs, public_tokenizers.path(RANKS), frugal=True)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

ORACLE_SQL = None  # most stages have no SQL form; tests compare each with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
