"""Plain table access: Parquet tables by name, catalog tables, append sinks."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table_path(root: str, name: str) -> str:
    return os.path.join(root, f"{name}.parquet")


def read_table(spark: SparkSession, root: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Parquet table ``<root>/<name>.parquet``; ``columns`` prunes at the scan."""
    df = spark.read.parquet(table_path(root, name))
    return df.select(*columns) if columns else df


def read_catalog_table(spark: SparkSession, name: str,
                       columns: list[str] | None = None) -> DataFrame:
    """A metastore / session-catalog table."""
    df = spark.table(name)
    return df.select(*columns) if columns else df


def append_parquet(df: DataFrame, path: str) -> None:
    """A12 sink: append rows to a Parquet table location.

    Spark's file commit protocol makes task retries safe; a re-run of the whole
    job appends again, exactly as an append to a relational table would.
    """
    df.write.mode("append").parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A12 source: relational read.  Give a partition column and bounds for a
    parallel read; without them JDBC reads through a single task."""
    props = dict(properties or {})
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                               upperBound=upper, numPartitions=num_partitions,
                               properties=props)
    return spark.read.jdbc(url, table, properties=props)


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None) -> None:
    """A12 sink: ``write.mode('append').jdbc``."""
    df.write.mode("append").jdbc(url, table, properties=dict(properties or {}))
