"""Tables that a job writes for itself, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    Where it is unset, a session on one machine gets a temporary folder; on a
    cluster no folder of one machine would do, so that is an error.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-ckpt-")
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, below one folder for each application."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write as Parquet and read back: cuts the lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of any file system that Spark reads."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.sc().hadoopConfiguration()).delete(found, True)


def forget(df: DataFrame) -> None:
    """Remove the table behind a frame from ``materialise`` that nothing will read again."""
    delete(df.sparkSession, df._scratch_path)
