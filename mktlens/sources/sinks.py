"""Sinks: the three ways the reference hands a result over.

* ``view_sink``  - ``create or replace view``: a temporary view, re-planned on
  every read (nothing is materialised).
* ``ctas_sink``  - ``create table ... as``: written once into the caller's path,
  whole or not at all, failing when it exists.  Parquet, partitioned when asked.
* returning the DataFrame - a top-level ``select``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def view_sink(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def ctas_sink(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """``create table path as df``: the rows are written to a folder beside
    ``path``, which then takes the name ``path`` in one step.  Readers see the
    whole table or none; it fails if ``path`` exists (also if it comes to exist
    meanwhile) or if the write fails, and leaves nothing behind then."""
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    fs = target.getFileSystem(conf)
    if fs.exists(target):
        raise FileExistsError(f"{path} exists")
    target = fs.makeQualified(target)
    staging = hadoop.Path(target.getParent(), f"_{target.getName()}-{uuid.uuid4().hex}")
    try:
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(staging.toString())
        never_replace = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
        never_replace[0] = getattr(getattr(hadoop, "Options$Rename"), "NONE")
        hadoop.FileContext.getFileContext(target.toUri(), conf).rename(staging, target, never_replace)
    except BaseException:
        fs.delete(staging, True)
        raise
    return spark.read.schema(df.schema).parquet(path)
