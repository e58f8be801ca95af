"""A statistical dataset as a group of tables.

A dataset ``{id}`` is stored as tables ``{id}_TypedDataSet`` (the fact),
``{id}_DataProperties`` (column metadata) and one ``{id}_{Dimension}`` per
dimension, each a parquet (or NDJSON) table folder/file under one root. The
loader lists the root once, keeps the table names of the dataset, and returns
lazily read DataFrames; only table names reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.operators.star import flatten
from statmart.sources.listing import list_files

# Table-name suffixes of a statistical dataset.
FACT = "TypedDataSet"
PROPERTIES = "DataProperties"


def read_table(spark: SparkSession, uri: str) -> DataFrame:
    """Parquet or NDJSON by suffix (S13/S14); a folder without suffix is parquet."""
    last = uri.rstrip("/").split("/")[-1]
    if last.endswith(".json"):
        return spark.read.json(uri)
    return spark.read.parquet(uri)


def dataset_tables(spark: SparkSession, root: str, dataset_id: str) -> dict[str, str]:
    """``{table name: uri}`` of the dataset's tables below ``root``."""
    # Only this dataset's entries are listed (a glob), not the whole root.
    listing = list_files(spark, f"{root.rstrip('/')}/{dataset_id}_*", base=root)
    first = F.split(F.col("relative"), "/").getItem(0)
    names = (listing.select(first.alias("entry")).distinct()
                    .where(F.col("entry").startswith(dataset_id + "_"))
                    .collect())
    out = {}
    for r in names:
        entry = r["entry"]
        table = entry.rsplit(".", 1)[0] if entry.endswith((".parquet", ".json")) else entry
        out[table] = f"{root.rstrip('/')}/{entry}"
    return out


def load_dataset(spark: SparkSession, root: str, dataset_id: str) -> dict[str, DataFrame]:
    """All tables of dataset ``dataset_id`` as DataFrames, keyed by table name."""
    return {name: read_table(spark, uri)
            for name, uri in dataset_tables(spark, root, dataset_id).items()}


def flatten_dataset(spark: SparkSession, root: str, dataset_id: str, how: str = "inner",
                    **kw) -> DataFrame:
    """Load a dataset and flatten its fact with its dimensions (S15 + J3)."""
    t = load_dataset(spark, root, dataset_id)
    fact = t[f"{dataset_id}_{FACT}"]
    props = t[f"{dataset_id}_{PROPERTIES}"]
    prefix = dataset_id + "_"
    dims = {name[len(prefix):]: df for name, df in t.items()
            if name not in (f"{dataset_id}_{FACT}", f"{dataset_id}_{PROPERTIES}")}
    return flatten(fact, dims, props, how=how, **kw)


def mart_table_name(title: str) -> str:
    """Table name of a flattened mart from its title: lower case, spaces → ``_``."""
    return title.lower().replace(" ", "_")


def write_flat_mart(df: DataFrame, root: str, title: str, fmt: str = "parquet") -> str:
    """Replace the flattened mart table named after ``title`` below ``root`` (K6)."""
    path = f"{root.rstrip('/')}/{mart_table_name(title)}"
    df.write.mode("overwrite").format(fmt).save(path)
    return path
