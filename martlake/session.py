"""Spark session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale. AQE re-plans joins at run time (broadcast when the
# measured side is small, skew splitting, partition coalescing); nothing here pins a
# physical strategy.
_SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.ui.enabled": "false",
    # checkpoints written by ranks and folds are removed once their data is out of scope
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # streaming state (ledgers, de-duplication keys, pickup state machine) in RocksDB:
    # kept on local disk per partition and checkpointed, not held on the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.showConsoleProgress": "false",
}


#: scratch folders of local sessions, by application
_scratch: dict[str, str] = {}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "martlake", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster the submitter's session is used as is."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _SCALE_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("MARTLAKE_DRIVER_MEMORY", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: measured bytes of a join's side up to which it goes through the driver, whatever the session
#: allows: the driver holds it as rows, as a hash table and as blocks, and a query of many joins
#: builds several at once
_BROADCAST_BYTES = 2 * 1024 * 1024


def measure_joins(spark: SparkSession) -> None:
    """From now on a join's side is broadcast by the size measured when it has run (AQE), up to
    the threshold the session came with, ``_BROADCAST_BYTES`` at most, or where it is marked as
    bounded. A Parquet file says little about its rows: sorted keys take a hundredth of their size
    in memory, and tables of ten million such rows would pass the threshold and go through the
    driver whole."""
    static, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    if spark.conf.get(static) != "-1":
        if spark.conf.get(measured, None) is None:
            spark.conf.set(measured, spark.conf.get(static))
        spark.conf.set(static, "-1")
    allowed = spark.conf.get(measured, None)
    if allowed is not None and not allowed.startswith("-") and _bytes(allowed) > _BROADCAST_BYTES:
        spark.conf.set(measured, str(_BROADCAST_BYTES))


#: bytes that a task reads of files or of a shuffle, at most (about: a file's row group and a
#: shuffle's partition aren't cut)
_TASK_BYTES = 16 * 1024 * 1024
_BOUNDS = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", size.strip().lower()).groups()
    return int(number) * 1024 ** "_kmgt".index(unit or "_")


def bound_tasks(spark: SparkSession) -> None:
    """From now on a task gets at most ``_TASK_BYTES``, or less where the session came with less.
    Rows of a few compressed bytes take ten times as much when they are sorted or hashed; with
    Spark's own 64 and 128 MB one task of a join of order lines took a gigabyte."""
    for name in _BOUNDS:
        if _bytes(spark.conf.get(name)) > _TASK_BYTES:
            spark.conf.set(name, str(_TASK_BYTES))


def release_shuffles(spark: SparkSession) -> None:
    """From now on the files of a statement's shuffles are removed when the statement ends, on all
    executors. Else they stay until the driver collects garbage, which a driver with little to do
    hardly ever does, and a job of many steps keeps the shuffles of all of them. Should a plan that
    has run be run once more, Spark runs the stages again whose files are gone."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: a step that several later
    ones read. It is compressed and read by columns, where a checkpoint holds whole rows as they
    lie in memory."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/step-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def drop(*steps: DataFrame) -> None:
    """Removes the files of ``stored`` steps that nothing reads any more."""
    for step in steps:
        path = step.sparkSession._jvm.org.apache.hadoop.fs.Path(step.stored_at)
        path.getFileSystem(step.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Executors must see it, so a cluster has to name one: without the setting this raises.
    Only a local session (one process, as in tests) gets a scratch folder of its own, which is
    removed when the process ends.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or _scratch.get(spark.sparkContext.applicationId)
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir isn't set: name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="martlake-ckpt-")
        _scratch[spark.sparkContext.applicationId] = d
        atexit.register(shutil.rmtree, d, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(d)
    return d
