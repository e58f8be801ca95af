import os

import pytest

from statmart import session


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    applicationId = "app-test-1"

    def __init__(self, conf, master):
        self._conf = _Conf(conf)
        self.master = master
        self.checkpoint = None

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, d):
        self.checkpoint = d


class _Session:
    def __init__(self, conf, master="local[2]"):
        self.conf = _Conf(conf)
        self.sparkContext = _Context(conf, master)


def test_shared_root_reads_the_cluster_setting():
    s = _Session({"spark.checkpoint.dir": "hdfs://nn/shared/ckpt/"})
    assert session.shared_root(s) == "hdfs://nn/shared/ckpt"
    assert s.sparkContext.checkpoint == "hdfs://nn/shared/ckpt/"
    assert session.scratch_path(s, "x").startswith("hdfs://nn/shared/ckpt/statmart/x-")


def test_shared_root_when_unset_picks_one_folder_per_application():
    s = _Session({})
    first = session.shared_root(s)
    assert first and session.shared_root(s) == first
    assert s.sparkContext.checkpoint == first
    assert s.conf.get("spark.checkpoint.dir") is None          # never written


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_no_folder_of_our_own_on_a_cluster(master):
    s = _Session({}, master)
    s.sparkContext.applicationId = f"app-{master}"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_root(s)


def test_real_session_uses_configured_dir(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        assert session.shared_root(spark) == configured.rstrip("/")


def test_tasks_find_the_package_from_any_folder(tmp_path):
    """A task-side query in a session that was started elsewhere and knows no path of ours."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as E
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false") \\
    .config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("ROWS", E.queries()["zip_expand"](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS " in out.stdout, out.stderr[-2000:]


def test_entry_without_optional_packages(tmp_path):
    """The other queries stay when a package that only the training-data operators use is missing."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for missing in ("duckdb", "regex", "zstandard", "public_tokenizers", "xxhash"):
        code = f"""
import sys
sys.modules[{missing!r}] = None
sys.path.insert(0, {root!r})
import __spark_entry__ as E
from statmart.plans import suite
assert set(suite.QUERIES) <= set(E.queries()) and set(suite.ORACLE) <= set(E.oracle_sql())
print("QUERIES", len(E.queries()))
"""
        out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
        assert "QUERIES " in out.stdout, out.stderr[-2000:]
