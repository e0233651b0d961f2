"""Session helpers for tests, the bench and local runs."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "adcube") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(app)
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, folder: str | None = None) -> str:
    """The session's shared folder for intermediate data.

    The one named in ``spark.checkpoint.dir``, else ``folder``, else one below
    the warehouse; only a one-process local session with neither (tests) gets a
    temporary folder.
    """
    sc = spark.sparkContext
    found = sc.getCheckpointDir()
    if found:
        return found
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or folder
    if not found:
        one_process = sc.master.startswith("local") and not sc.master.startswith("local-cluster")
        found = (tempfile.mkdtemp(prefix="adcube-") if one_process
                 else f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate")
    sc.setCheckpointDir(found)
    return sc.getCheckpointDir()


_block = threading.local()  # the innermost intermediates() of this thread


@contextmanager
def intermediates(spark: SparkSession):
    """Delete, at the end of the block, what :func:`written` writes inside it.

    For runs whose result is written before the block ends; a DataFrame that is returned
    from it still needs its intermediate results.
    """
    outer, _block.folders = getattr(_block, "folders", None), []
    try:
        yield
    finally:
        folders, _block.folders = _block.folders, outer
        for folder in folders:
            delete_folder(spark, folder)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, for small results joined to large ones.

    The plan then starts from a table whose size in bytes the planner knows.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    if getattr(_block, "folders", None) is not None:
        _block.folders.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tune_for_scale(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Size scan splits and shuffle partitions for ``input_bytes`` of source data.

    Scan splits and post-shuffle partitions target ``target_partition_bytes``
    (fits comfortably in an executor task's memory; larger aggregations spill).
    The shuffle partition count is an upper bound: AQE coalesces small
    partitions at run time and splits skewed ones in joins.
    """
    parts = max(1, -(-input_bytes // target_partition_bytes))
    conf = {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        # Semi-joins of a batch's ids with a history: a Bloom filter of the ids (8 MB at most) goes
        # into the scan of any history larger than a few partitions.
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(4 * target_partition_bytes),
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": str(4 * target_partition_bytes),
        "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(64 << 20),
        "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": str(8 << 20),
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
