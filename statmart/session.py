"""Session settings and the shared scratch folder.

Every job in the package takes a ``SparkSession`` from the caller. ``build_session``
is only a convenience for scripts and tests: adaptive execution on (runtime
coalescing, skew-join splitting, broadcast conversion from real sizes), UTC
session time zone, Arrow transfer for the few pandas steps.

Files a job writes for itself (staged conversions, lineage cuts) go below the
shared folder the cluster names in ``spark.checkpoint.dir``. Only when that
setting is missing and the master is local (unit tests, a laptop) do we pick a
folder of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "statmart",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    Functions that run in tasks are pickled by name, so a Python worker must be able
    to import them wherever it was started.
    """
    sc = spark.sparkContext
    package = os.path.dirname(os.path.abspath(__file__))
    if sc.applicationId in _SHIPPED or not os.path.isdir(package):
        return  # already sent, or imported from an archive that was sent itself
    top = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="statmart-"), "statmart_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, top))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


_OWN_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Shared folder for job-owned files: ``spark.checkpoint.dir`` when set.

    Only when the cluster names none (unit tests, a laptop) is a folder of our
    own chosen, once per application, and given to the context as its
    checkpoint directory. ``spark.checkpoint.dir`` is a core setting that a
    running session cannot change, so it is never set here.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = _OWN_ROOTS.get(sc.applicationId)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="statmart-")
        _OWN_ROOTS[sc.applicationId] = root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused folder below the shared root."""
    return f"{shared_root(spark)}/statmart/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme for Python-side file access in tasks."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return uri

