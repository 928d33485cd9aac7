"""Session settings and the shared folder for tables between stages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
WAREHOUSE_CONF = "spark.sql.warehouse.dir"


def get_spark(app: str = "pagesift", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. A local session that has
    none uses its warehouse folder; a cluster session without one is an error,
    since a machine-local folder would lose data with its machine.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    return spark.conf.get(WAREHOUSE_CONF).rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path; all of a session's lie in one folder, named by its
    application id, which ``clear_stages`` removes."""
    return f"{_own_dir(spark)}/{uuid.uuid4().hex}/{name}"


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/pagesift/{spark.sparkContext.applicationId}"


def file_system(spark: SparkSession, path: str):
    """The file system that a path is on, and the class of its paths."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is, if it is there."""
    fs, at = file_system(spark, path)
    fs.delete(at(path), True)


def clear_stages(spark: SparkSession) -> None:
    """Remove the session's staged tables, once no result reads them any more."""
    remove(spark, _own_dir(spark))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the optimizer a true
    size for the table.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
