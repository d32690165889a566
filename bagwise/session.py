"""Session construction and lineage cutting.

The library never invents storage locations on a cluster: `materialize` writes
to the shared folder the cluster names in `spark.checkpoint.dir`. Only a
local-mode session without that setting gets a scratch folder (tests, bench).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the package expects. AQE re-plans at runtime:
# coalesces small shuffle partitions, converts joins whose measured side is
# small to broadcast, and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def scale_conf(input_bytes: int, total_cores: int,
               target_partition_bytes: int = 128 << 20) -> dict:
    """Settings for a large cluster, sized from the input volume.

    Shuffles start with enough partitions for ~`target_partition_bytes` of
    input each (at least 3 per core) and AQE coalesces them to the advisory
    size after measuring, so aggregated (small) shuffles do not run as
    hundreds of thousands of tiny tasks while raw-row shuffles never build
    partitions that overflow executor memory. Scan splits stay at the
    target size: a text row can be ~100 KB, so a 128 MB split is about a
    thousand documents of regex work per task.
    """
    initial = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def build_session(master: str | None = None, app: str = "bagwise",
                  shuffle_partitions: int | None = None,
                  driver_memory: str | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    Read from the SparkContext or `spark.checkpoint.dir`. When neither is
    set and the session runs in local mode, a scratch folder is created and
    registered (the tests' case). A cluster must name a shared folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="bagwise-ckpt-"))
    return sc.getCheckpointDir()


_WRITTEN: list[str] = []
_READERS: list[dict] = []


def forget_on_release(memo: dict) -> dict:
    """A dict of objects that read materialized tables; `release` empties it."""
    _READERS.append(memo)
    return memo


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the checkpoint folder, deleted by `release`."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/bagwise-{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


ARROW_RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str = "table", records: int | None = None) -> DataFrame:
    """Compute `df` once and cut its lineage for repeated use.

    `df` is written to the checkpoint folder (the shared folder of the
    cluster) as a parquet table and read back: one job, compressed, and later
    reads prune columns and push filters into the scan (an RDD checkpoint of
    an unpersisted DataFrame computes it twice and cannot prune). A lost
    executor costs nothing: the table is on shared storage.

    `records`: rows of a batch for Python in this job, where rows are large.
    The shuffle files behind the table go as soon as it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    wanted = {SHUFFLE_CLEANUP: "true"} | ({ARROW_RECORDS: str(records)} if records else {})
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        df.write.mode("error").parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(table: DataFrame) -> None:
    """Delete a table that `materialize` returned and that nothing reads any more."""
    path = table._written_to
    jvm, conf = table.sparkSession.sparkContext._jvm, table.sparkSession.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(conf).delete(place, True)
    _WRITTEN.remove(path)


def release(spark: SparkSession) -> int:
    """Delete the tables `materialize` wrote (through the Hadoop file system
    of the checkpoint folder), and forget fitted models and tables that read
    them. Call it when no DataFrame reading them is in use any more; returns
    the number of tables removed."""
    for memo in _READERS:
        memo.clear()
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _WRITTEN:
        p = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        if p.getFileSystem(conf).delete(p, True):
            n += 1
    return n


#: Session setting: scans with fewer partitions are spread to so many (unset: scans stay as they are).
SCAN_PARTITIONS = "spark.bagwise.scanPartitions"


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition a narrow scan by `key`, if the session asks for it.

    Parquet splits by row group: a table stored as one row group is read by
    one task, which then runs all the regex tokenizing. Off by default, so the
    plan that runs is the reader's; the bench, whose tables are one row group
    each, sets `spark.bagwise.scanPartitions`.
    """
    wanted = df.sparkSession.conf.get(SCAN_PARTITIONS, None)
    if wanted is None or df.rdd.getNumPartitions() >= int(wanted):
        return df
    return df.repartition(int(wanted), key)
