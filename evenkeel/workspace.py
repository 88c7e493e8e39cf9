"""The shared folder for tables written between two steps of a run."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one the session names in ``spark.checkpoint.dir``.

    Written tables there outlive any executor, so a lost one costs no recomputation of
    earlier steps.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{root.rstrip('/')}/evenkeel-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` as a table and go on from the table: the lineage ends here."""
    path = f"{folder}/{name}"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder made by ``shared_folder``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
