"""Report sink."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from logstats import schemas
from logstats.scratch import remove_path


def write_report(report: DataFrame, path: str, stamp: str = "", files: int | None = 1) -> str:
    """Write the report as CSV without a header to ``path + stamp + '.csv'``.

    The report has one row per machine and goes to one file by default. That is
    done with a shuffle of the finished rows, so the work before it keeps its
    parallelism. ``files=None`` writes one file per partition instead.
    """
    target = f"{path}{stamp}.csv"
    rows = report if files is None else report.repartition(files)
    rows.write.csv(target, header=False)
    return target


def publish_report(report: DataFrame, path: str, stamp: str, files: int | None = 1) -> str:
    """``write_report`` that can be repeated: one report for a stamp, or none.

    The rows are written aside first and then moved to their place, so a run that fails
    leaves what was there before, and a run with the same stamp takes its place. Moving a
    folder is one step on HDFS and local disks; on object stores it is a copy.
    """
    spark = report.sparkSession
    target = f"{path}{stamp}.csv"
    aside = f"{path}{stamp}.{uuid.uuid4().hex}"
    try:
        written = write_report(report, aside, "", files)
        jvm = spark.sparkContext._jvm
        source, place = (jvm.org.apache.hadoop.fs.Path(name) for name in (written, target))
        files_of = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if files_of.exists(place):
            files_of.delete(place, True)
        if not files_of.rename(source, place):
            raise OSError(f"{written} cannot be moved to {target}")
    finally:
        remove_path(spark, f"{aside}.csv")
    return target


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MACHINE_REPORT).csv(path, header=False)
