"""Session for tests and benchmarks, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHUFFLES_DELETED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_scratch: dict[str, str] = {}


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A single-JVM session. On a cluster, bring your own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("kindred")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # The test tables are a few megabytes: let them be cut into as many tasks as there are cores.
        .config("spark.sql.files.openCostInBytes", "64k")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        # Call sites in error messages cost a few calls into the JVM for every expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables that must outlive an executor.

    It is the shared folder the cluster names in ``spark.checkpoint.dir``. Only a local master,
    where every task sees the same disk, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if shared:
        return f"{shared.rstrip('/')}/kindred-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="kindred-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; whatever reads them must be done."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files behind, which otherwise stay on the disks of the executors as long as the application knows the plan."""
    before = spark.conf.get(SHUFFLES_DELETED, None)
    spark.conf.set(SHUFFLES_DELETED, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_DELETED) if before is None else spark.conf.set(SHUFFLES_DELETED, before)


def staged(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), **options: str) -> DataFrame:
    """Write ``df`` as a table in the scratch folder and return the table.

    Cuts the lineage: what follows survives the loss of executors without redoing what came before.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_deleted(df.sparkSession):
        df.write.options(**options).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
