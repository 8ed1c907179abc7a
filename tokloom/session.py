"""Session construction and the reliable-checkpoint folder.

Iterative operators (BPE training) and stages with several readers are written as
tables under ``spark.checkpoint.dir``. On a cluster that folder is shared
storage named by the cluster configuration; we only read it. A private folder
is created solely for local-mode sessions (tests, the bench) that left it unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # AQE aims at total shuffle size / parallelism; a 64 KB floor (instead of
    # 1 MB) keeps small-but-CPU-heavy text stages (regex, BPE) on every core.
    # Large shuffles are still sized by the 64 MB advisory partition size.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tokloom", extra: dict | None = None) -> SparkSession:
    """Builder with AQE on and the UI off; ``master`` only for local runs."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, creating one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative operators need a shared "
            "checkpoint folder on a cluster")
    path = tempfile.mkdtemp(prefix="tokloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tokloom`` importable in local-mode Python workers (``addPyFile``).

    Needed by the Arrow/pandas operators; done once per application. On a
    cluster the package is deployed the standard way (``--py-files`` or
    installed on executors), so nothing is written to a machine-local folder.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or not spark.sparkContext.master.startswith("local"):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tokloom-pkg-"), "tokloom.zip")
    with zipfile.ZipFile(out, "w") as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    spark.sparkContext.addPyFile(out)
    _SHIPPED.add(app)


def stored(df: DataFrame, name: str = "stage") -> tuple[DataFrame, str]:
    """Write ``df`` as a table under the checkpoint folder; ``(the table, its path)``.

    Like a reliable checkpoint, but with a true size for the planner: a join
    broadcasts the table only under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_stored(spark: SparkSession, path: str) -> None:
    """Delete a table written by ``stored`` that no plan reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
