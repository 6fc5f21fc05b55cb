"""JSON report sink and its reader. A report is a one-row DataFrame, possibly nested."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_report(report: DataFrame, path: str | None) -> None:
    """Write ``report`` as one pretty-printed JSON file at ``path``; do nothing without a path.

    The row is written to a folder next to it, by the protocol that commits the output of a job only if all of its tasks have succeeded. Then the
    file in it takes the place of ``path`` in one step. A job that fails leaves an earlier report as it was, and no other file.
    """
    if path is None:
        return
    spark = report.sparkSession
    hadoop = spark._jvm.org.apache.hadoop
    target = hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    target = files.makeQualified(target)
    parent = target.getParent()
    folder = hadoop.fs.Path(parent, f".{target.getName()}-{uuid.uuid4().hex}")
    text = F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"})
    try:
        report.select(text.alias("value")).coalesce(1).write.text(folder.toString())
        parts = [s.getPath() for s in files.globStatus(hadoop.fs.Path(folder, "part-*"))]
        if len(parts) != 1:
            raise ValueError(f"a report is one row, not {len(parts)} files")
        replace = spark.sparkContext._gateway.new_array(hadoop.fs.Options.Rename, 1)
        replace[0] = hadoop.fs.Options.Rename.OVERWRITE
        hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(parts[0], target, replace)
    finally:
        files.delete(folder, True)


def read_report(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)
