"""Session defaults, scratch storage and sizing rules shared by the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "12g",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app: str = "recordlink", **conf: str) -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**DEFAULT_CONF, "spark.sql.shuffle.partitions": "8", **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that outlives an executor: `spark.checkpoint.dir`. Only a local session may do without and gets a temp folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared folder (survives executor loss)."""
    return store(df, "table")


def store(df: DataFrame, label: str) -> DataFrame:
    """Rows written to the shared folder as Parquet (packed) and read back.

    The shuffle files of the job that wrote them are not needed again and are removed at its end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


SPREAD_BYTES = 256 << 20


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a small input whose file has a single row group and would run on one core.

    Only for inputs of at most SPREAD_BYTES by Spark's own estimate; larger ones pass through unchanged.
    """
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > SPREAD_BYTES:
        return df
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)
