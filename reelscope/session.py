"""Session construction and the shared scratch location.

On a cluster the scratch location is the shared folder named by
``spark.checkpoint.dir``; it is read from the session. Only when it is
unset (local runs, tests) is a folder chosen here.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session zone (epoch → timestamp is
# zone-free), ANSI on (bad casts go through try_* explicitly), AQE on so
# joins pick broadcast / shuffle at runtime from measured sizes and split
# skewed partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files are removed once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "reelscope",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, total_cores: int,
               target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Settings for a cluster run sized from the input volume.

    Shuffle partitions start at ~input / 256 MB (at least 3 × cores) so a
    partition of the largest shuffle fits an executor's memory with room for
    spills; AQE then coalesces small ones toward the advisory size and
    splits skewed ones. Scans read 256 MB splits. Example: 100 TB on 8000
    cores → about 400,000 initial shuffle partitions.
    """
    parts = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        # runtime broadcast only for sides measured under 64 MB
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    }


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``; sets a local one only
    when the session has none (local mode, tests).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception:  # a session without a local SparkContext (Spark Connect)
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="reelscope-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(local)
        return sc.getCheckpointDir().rstrip("/")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


@contextmanager
def shuffles_swept(spark: SparkSession):
    """Within, a query's shuffle files go as soon as it has ended, not when the
    driver happens to collect its garbage: for jobs of several queries whose
    shuffles need not be on disk together."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared folder for one run, until
    ``drop_scratch``."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Deletes the scratch paths that this process has handed out, and the
    tables whose files are there. To be called when no result that reads
    them is needed any more; returns their number."""
    for t in spark.catalog.listTables():
        if not t.isTemporary and any(table_location(spark, t.name).endswith(p.split("://")[-1]) for p in _scratch):
            spark.sql(f"DROP TABLE IF EXISTS {t.name}")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in _scratch:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    n = len(_scratch)
    _scratch.clear()
    return n


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else ""
