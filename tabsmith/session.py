"""Session helpers: one place for the engine settings every job relies on.

Nothing here changes query semantics; it sizes shuffles, turns on adaptive
execution and resolves the shared folder used to cut lineage.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that make the plans in this package behave well at any scale:
#  * AQE re-plans joins from runtime sizes (a small side found at runtime is
#    broadcast; a large one is never broadcast on a guess) and splits skewed
#    sort-merge join partitions.
#  * UTC keeps date/timestamp casts identical to the DuckDB oracle.
#  * ANSI mode stays on (Spark 4 default): bad casts and division by zero
#    raise instead of silently producing nulls.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when the split costs an extra
    # shuffle downstream (a join followed by an aggregate or window on the
    # same key would otherwise never be split). Only acts on detected skew.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


LOCAL_SHUFFLE_PARTITIONS = 8


def build_session(master: str | None = "local[*]", shuffle_partitions: int | None = None, app: str = "tabsmith",
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster the master, the memory and the number of shuffle partitions
    come from spark-submit: pass ``master=None`` there. The partition count is
    written only where the caller gives one, or on a local master without one
    (``LOCAL_SHUFFLE_PARTITIONS``).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if shuffle_partitions is None and master.startswith("local["):
            shuffle_partitions = LOCAL_SHUFFLE_PARTITIONS
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for stages and checkpoints, shared by every executor.

    Read from ``spark.checkpoint.dir`` as the cluster names it. Where it is
    unset, a single-process master (``local`` or ``local[n]``) gets a fresh
    folder; on any other master that would be a folder only one machine sees,
    so it is an error there.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
        path = tempfile.mkdtemp(prefix="tabsmith-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    """Unique path below the shared folder for one written stage."""
    return f"{shared_dir(spark)}/stages/{name}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    """(file system, path) in the JVM, for any store that Spark reads."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove_stage(spark: SparkSession, path: str) -> None:
    """Delete one written stage once nothing reads it any more."""
    store, target = _file_system(spark, path)
    store.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    store, target = _file_system(spark, path)
    return store.exists(target)


def create_mark(spark: SparkSession, path: str) -> None:
    """An empty file; its parents are made as needed."""
    store, target = _file_system(spark, path)
    store.create(target, True).close()
