"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache
from pathlib import Path

from pyspark.sql import SparkSession

#: Runtime settings every job relies on.  They hold at any size: AQE picks partition
#: counts, splits skewed join partitions and re-plans joins from measured sizes.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # rows go to Python in batches bounded by bytes, as ten thousand long texts fill a worker
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    # shuffle files go when their job ends, not when the driver next collects its garbage; a frame that is run
    # again computes them again
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

#: In local mode only.  There, tables are small files of one row group, so a scan is one task, and a
#: join broadcast into it would keep the whole stage on one core.  A cluster has a higher limit (see ``tune``):
#: there a broadcast spares the large side its shuffle.
LOCAL_CONF = {"spark.sql.autoBroadcastJoinThreshold": "256k"}


def _runtime_conf(spark: SparkSession) -> dict[str, str]:
    return {**RUNTIME_CONF, **(LOCAL_CONF if spark.sparkContext.master.startswith("local[") else {})}


def build_session(app: str = "treadle", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session for tests, benches and stand-alone runs."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in _runtime_conf(spark).items():
        if key not in conf:
            spark.conf.set(key, value)
    return _with_code(spark)


def _with_code(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import the package, wherever the driver was started.

    On a cluster the package is installed on the executors, or sent along by ``--py-files``.
    """
    home = str(Path(__file__).resolve().parent.parent)
    own = spark.sparkContext.environment
    paths = own.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        own["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])
    return spark


def tune(spark: SparkSession, folder: str | None = None) -> SparkSession:
    """Apply the runtime settings to a session somebody else built; ``folder`` has the tables that jobs will read."""
    for key, value in _runtime_conf(spark).items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    _bound_broadcasts(spark)
    _spread(spark, folder)
    return _with_code(spark)


BROADCAST, BROADCAST_BYTES = "spark.sql.autoBroadcastJoinThreshold", 2 << 20
#: The same for sizes that were measured in a shuffle, and the limit of sizes that are guessed from files: a file of a
#: few values is a hundred times its size in memory, and more once versions are laid out over the years.
MEASURED, GUESSED_BYTES = "spark.sql.adaptive.autoBroadcastJoinThreshold", 256 << 10
#: Stored input per shuffle partition, and the most a task reads of a shuffle.
SPREAD_BYTES, ADVISORY_BYTES = 4 << 20, 8 << 20
INITIAL, ADVISORY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_BEFORE = "treadle.advisory.before"


def _limit(spark: SparkSession, key: str, most: int) -> str:
    """Lower a size to ``most`` bytes; one that is off or lower stays.  Sizes are of compressed columns and
    shuffles, which take a multiple in memory: a broadcast on the driver, a shuffle's part in its task."""
    own = spark.conf.get(key)
    if not own.startswith("-") and spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(own) > most:
        spark.conf.set(key, str(most))
    return own


def _bound_broadcasts(spark: SparkSession) -> None:
    """What the driver builds for a join stays small, whatever the files of a table look like."""
    _limit(spark, BROADCAST, BROADCAST_BYTES)
    guessed = spark.conf.get(BROADCAST)
    _limit(spark, BROADCAST, GUESSED_BYTES)
    if spark.conf.get(MEASURED, None) is not None:
        _limit(spark, MEASURED, BROADCAST_BYTES)
    elif spark.conf.get(BROADCAST) != guessed:
        spark.conf.set(MEASURED, guessed)


def _spread(spark: SparkSession, folder: str | None) -> None:
    """Shuffles start with partitions by the size of the tables, so a task's share stays as it is while they grow.

    With a fixed number of partitions a task's hash table or sort would grow with the input.  AQE merges
    partitions that come out small.
    """
    if spark.conf.get(_BEFORE, None):  # of an earlier job on other tables
        spark.conf.unset(INITIAL)
        spark.conf.set(ADVISORY, spark.conf.get(_BEFORE))
        spark.conf.unset(_BEFORE)
    if folder is None:
        return
    size = stored_bytes(spark, folder)
    if size // SPREAD_BYTES > int(spark.conf.get("spark.sql.shuffle.partitions")) and spark.conf.get(INITIAL, None) is None:
        spark.conf.set(INITIAL, str(size // SPREAD_BYTES))
        spark.conf.set(_BEFORE, _limit(spark, ADVISORY, ADVISORY_BYTES))


def stored_bytes(spark: SparkSession, folder: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may do without it (tests); on a cluster a machine-local
    folder would lose rows with its machine, so the job stops instead.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder(context.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="treadle-")


def run_folder(spark: SparkSession, label: str) -> str:
    """A new, empty folder of this run below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
