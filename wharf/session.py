"""Session helpers: a local session for tests and the bench, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


# Settings for a large cluster, which the job entries apply where the submit command says nothing else.
# AQE re-plans at runtime: coalesces small shuffle partitions, splits skewed join partitions, and
# turns joins into broadcasts only after measuring the small side.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.ui.enabled": "false",
}


def job_session(name: str) -> SparkSession:
    """The session of a job entry: the settings of ``CLUSTER_CONF`` hold where neither the submit command nor
    the defaults file says otherwise. A session that is there already keeps its own."""
    there = SparkSession.getActiveSession()
    if there is not None:
        return there
    spark = SparkSession.builder.appName(name).config("spark.ui.enabled", "false").getOrCreate()
    named = spark.sparkContext.getConf()
    for key, value in CLUSTER_CONF.items():
        if key.startswith("spark.sql.") and not named.contains(key):
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "wharf") -> SparkSession:
    """A local session configured like the cluster jobs expect (AQE on, UI off, UTC session zone).

    The session zone is pinned to UTC only so that printed timestamps are stable; no operator depends
    on it, every date function takes its zone as an argument.
    """
    # Python processes started by the JVM (stateful stream runners) inherit this environment.
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *paths])
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return ``spark.checkpoint.dir``; set a scratch one only when the session has none (tests)."""
    cur = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if cur:
        return cur
    path = tempfile.mkdtemp(prefix="wharf-ckpt-", dir=os.environ.get("WHARF_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for lineage cuts and job state; fails if none is set."""
    cur = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not cur:
        raise RuntimeError("spark.checkpoint.dir is not set; jobs keep state in that shared folder")
    return cur


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``wharf`` importable in Python workers (needed only by the stateful stream step): zip the
    package once and add it with ``addPyFile``, which distributes it to every executor."""
    import shutil

    key = spark.sparkContext.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="wharf-pkg-", dir=os.environ.get("WHARF_SCRATCH", "/tmp"))
    base = shutil.make_archive(os.path.join(out, "wharf"), "zip", root_dir=os.path.dirname(pkg), base_dir="wharf")
    spark.sparkContext.addPyFile(base)
    _SHIPPED.add(key)
