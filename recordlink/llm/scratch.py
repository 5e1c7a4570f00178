"""Tables between the jobs of one operator, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordlink.session import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to the shared folder and read them back: cuts the lineage, survives lost executors.

    The shuffle files of the job that wrote them are not needed again and are removed at its end.
    """
    spark: SparkSession = df.sparkSession
    before = spark.conf.get(CLEANUP, "false")
    path = scratch_path(spark, label)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._scratch_path = path
    return kept


def discard(*tables: DataFrame) -> None:
    """Delete tables made by `keep` that no later step reads: what was made of them has been kept itself."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
