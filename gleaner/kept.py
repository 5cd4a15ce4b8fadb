"""Tables kept in the folder that driver and executors share, to cut lineage and to compute once what is read twice."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or else what ``setCheckpointDir`` was given.

    Where neither is set, one JVM that is both driver and executor (tests, benches) gets a temporary folder; a cluster
    must name its own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        given = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = given.get() if given.isDefined() else None
    if not found:
        if not spark.sparkContext._jsc.sc().isLocal():
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="gleaner-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/gleaner/{name}-{uuid.uuid4().hex}"


def keep(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage and computes ``df`` once; survives lost executors, unlike a local checkpoint.
    The owner of ``spark.checkpoint.dir`` clears that folder, as for Spark's own checkpoints.
    """
    path = fresh_path(spark, name)
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.kept_path = path
    return kept


def drop_kept(spark: SparkSession, kept: DataFrame) -> None:
    """Delete the table that ``keep`` gave, once nothing reads it any more."""
    drop_path(spark, kept.kept_path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a kept table once nothing reads it any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
