"""Session construction and the shared folder for written state."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    # Trip times are wall-clock values kept as TIMESTAMP_NTZ; pinning the zone
    # keeps anything a user casts to TIMESTAMP on the same clock.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A pickup zone, customer or order may own a third of the rows: let the
    # runtime split such partitions in every shuffled join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split them even where a later grouping would have reused the partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.default": "parquet",
    # Streaming state lives on disk, not in the executor heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming"
    ".state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


_MIB = 1024 * 1024

#: The temporary folder of each local application, removed with the process.
_LOCAL_FOLDERS: dict[str, str] = {}


def sizing(input_bytes: int, cores: int) -> dict[str, str]:
    """Partition options for a job over ``input_bytes`` of files on ``cores``.

    Scan tasks read 128 MiB, or up to 1 GiB once that would mean more than a
    hundred tasks per core. Shuffle partitions hold 256 MiB of input, or up to
    2 GiB once that would mean more than five per core: more partitions would
    cost the driver more in block bookkeeping than a sort that spills costs
    an executor. Spark's own 200 would mean 500 GB each for 100 TB. Adaptive
    execution merges partitions that turn out small.
    """
    scan = max(128 * _MIB, min(1024 * _MIB, input_bytes // (100 * cores)))
    fine, coarse = (-(-input_bytes // (size * _MIB)) for size in (256, 2048))
    shuffle = max(2 * cores, coarse, min(fine, 5 * cores))
    return {
        "spark.sql.files.maxPartitionBytes": str(scan),
        "spark.sql.shuffle.partitions": str(shuffle),
    }


def build_session(
    app: str = "tripflow",
    master: str | None = None,
    input_bytes: int | None = None,
    cores: int = 8,
    **conf: str,
) -> SparkSession:
    """A session with the engine's defaults; ``conf`` overrides any of them.

    ``input_bytes`` and ``cores`` size the partitions, see ``sizing``. Dots in
    option names are given as double underscores
    (``spark__sql__shuffle__partitions="8"``).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    options = dict(_DEFAULTS)
    if input_bytes is not None:
        options.update(sizing(input_bytes, cores))
    options.update({key.replace("__", "."): str(val) for key, val in conf.items()})
    for key, val in options.items():
        builder = builder.config(key, val)
    return builder.getOrCreate()


def listed_bytes(spark: SparkSession, paths: Iterable[str]) -> int:
    """Bytes of the files at ``paths``, globs included, from their listing."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    total = 0
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        system = path.getFileSystem(conf)
        for status in system.globStatus(path) or ():
            total += system.getContentSummary(status.getPath()).getLength()
    return total


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder; a cluster
    without the setting is refused, because a driver-local path would be
    invisible to the executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    application = spark.sparkContext.applicationId
    if application in _LOCAL_FOLDERS:
        return _LOCAL_FOLDERS[application]
    folder = tempfile.TemporaryDirectory(prefix="tripflow-", ignore_cleanup_errors=True)
    _LOCAL_FOLDERS[application] = folder.name
    atexit.register(folder.cleanup)
    return folder.name


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for one run's state under the shared folder.

    It is removed when the application ends: the frames read from it live no
    longer than that.
    """
    name = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    return name


def remove_folder(spark: SparkSession, name: str) -> None:
    """Removes a folder of this engine's own making."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def path_exists(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def child_folders(spark: SparkSession, name: str) -> list[str]:
    """Names of the folders in a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return [status.getPath().getName() for status in found if status.isDirectory()]


def written_once(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    For a frame that several branches of one query consume: it is computed
    once, its lineage ends at files every executor can read, and a lost
    executor costs a re-read instead of a re-computation.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
