"""Results by key with a version, to which later runs only add.

The table is bucketed by its key, so what is there already is neither moved nor rewritten: a run deals its own rows into the same
buckets and appends them, and readers take each key's last version, which needs no shuffle. A run that is repeated
appends equal rows of the same version, which changes nothing for readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..kept import fresh_path


def add_version(spark: SparkSession, name: str, rows: DataFrame, key: str, version: int, buckets: int = 32, path: str | None = None) -> None:
    """Append ``rows``, one for each key, to the table ``name`` under a version; the first call makes the table.

    ``path``: its folder, in the shared folder if not given. Later calls must give the same buckets.
    """
    made = spark.catalog.tableExists(name)
    out = rows.withColumn("version", F.lit(version).cast("bigint")).repartition(buckets, key).write.mode("append").format("parquet").bucketBy(buckets, key).sortBy(key)
    (out if made else out.option("path", path or fresh_path(spark, "versions"))).saveAsTable(name)


def latest(spark: SparkSession, name: str, key: str) -> DataFrame:
    """Each key's row of the last version."""
    table = spark.table(name)
    rest = [c for c in table.columns if c != key]
    return table.groupBy(key).agg(F.max_by(F.struct(*rest), "version").alias("_row")).select(key, *[F.col("_row")[c].alias(c) for c in rest])


def unfinished(spark: SparkSession, name: str, ids: DataFrame, key: str) -> DataFrame:
    """Ids without a row in any version. Only the ids are dealt; the table stays where it is."""
    return ids.join(spark.table(name).select(key), key, "left_anti")
