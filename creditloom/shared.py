"""The folder that driver and executors share, and what is kept in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``, or one
    below the warehouse. A warehouse on the driver's own disk is shared only
    where the executors run in its process; on a cluster this raises."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    master = spark.sparkContext.master
    one_process = master.startswith("local") and not master.startswith("local-cluster")
    if not one_process and (":/" not in warehouse or warehouse.startswith("file:")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/_shared"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder on whatever file system it is."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame) -> DataFrame:
    """Store a frame once and cut its lineage, so that re-run tasks see the
    same rows. Uses the checkpoint folder of the session, else the shared one."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/_checkpoints")
    return df.checkpoint()
