"""Session settings (inventory S4) and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings: they can be applied to a session that already exists.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # splits the partitions that one hot key makes too large
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a join on (customer, x) may reuse a partitioning on customer alone
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # hash instead of sort-merge where the measured partitions are small enough
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # whole texts travel to Python in these batches, on both sides outside the heap
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.session.timeZone": "UTC",
}


LOCAL_DIR_KEY = "trolley.local.shared.dir"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "trolley",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for wide joins with skewed keys.

    ``shuffle_partitions`` should be a few times the number of cores of the
    cluster; adaptive execution coalesces what turns out to be too small.
    """
    builder = SparkSession.builder.appName(app_name).config(
        "spark.serializer", "org.apache.spark.serializer.KryoSerializer"
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local-mode session may run without that setting; it then gets a
    folder of its own, remembered in the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(LOCAL_DIR_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="trolley-")
    spark.conf.set(LOCAL_DIR_KEY, folder)
    return folder


def use_checkpoints(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


#: Folders given out by ``scratch``, by application, until ``release`` deletes them.
_WRITTEN: dict[str, list[str]] = {}


def release(spark: SparkSession) -> None:
    """Delete the folders that ``scratch`` gave out and ``stage`` wrote for this application; call it when the results of a job are stored."""
    jvm = spark.sparkContext._jvm
    for path in _WRITTEN.pop(spark.sparkContext.applicationId, []):
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared folder, which ``release`` deletes."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage of a frame that several later steps read. The copy lives
    outside the executors, so losing one costs no recomputation, and the
    planner sees the real file size when it decides on a broadcast.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
