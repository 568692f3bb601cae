"""Cell view of wide tables (A11, A14, A15): melt, sorted bulk output, pivot back, point get."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelforge.operators.ordering import range_sorted

_MANIFEST = "_manifest"
CELL_COLUMNS = ("rowkey", "family", "qualifier", "value")


def melt_cells(df: DataFrame, key: str, family: str, columns: list[str] | None = None,
               include_key: bool = False, version: int | None = None) -> DataFrame:
    """One ``(rowkey, family, qualifier, value)`` row per non-null cell.

    Columns go out in lexicographic order; with ``include_key`` the key column is
    stored as a cell too.  ``version`` (e.g. the load's epoch milliseconds) adds a
    ``version`` column, the cell timestamp of the cell view.
    """
    cols = sorted(columns or [c for c in df.columns if c != key or include_key])
    if include_key and key not in cols:
        cols = sorted(cols + [key])
    melted = df.select(F.col(key).cast("string").alias("rowkey"),
                       *[F.col(c).cast("string").alias(c) for c in cols]) \
        .unpivot(["rowkey"], cols, "qualifier", "value")
    out = melted.where(F.col("value").isNotNull()) \
        .select("rowkey", F.lit(family).alias("family"), "qualifier", "value")
    return out.withColumn("version", F.lit(version).cast("long")) if version is not None else out


def cell_scan(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(number of distinct rows as a one-row frame, the cells themselves)."""
    return cells.agg(F.countDistinct("rowkey").alias("rows")), cells


def write_sorted_cells(cells: DataFrame, path: str, num_partitions: int | None = None,
                       cut_rows: bool = False) -> str:
    """A11 bulk output: cells globally sorted by (rowkey, qualifier) across files,
    output location replaced.  Range partitioning on the row key keeps every file a
    contiguous key range holding whole rows; with ``cut_rows`` a row of very many cells may
    go on in the next file.  Each file carries a Bloom filter of its row keys, and a manifest
    beside the files their key ranges, for ``get_row``."""
    range_sorted(cells, ["rowkey", "qualifier"], num_partitions,
                 partition_keys=["rowkey", "qualifier"] if cut_rows else ["rowkey"]) \
        .write.mode("overwrite").option("parquet.bloom.filter.enabled#rowkey", "true").parquet(path)
    spark = cells.sparkSession
    spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file")) \
        .agg(F.min("rowkey").alias("low"), F.max("rowkey").alias("high")) \
        .sort("low").write.parquet(f"{path}/{_MANIFEST}")
    return path


def pivot_cells(cells: DataFrame, qualifiers: list[str]) -> DataFrame:
    """Cells back to a wide STRING row per key."""
    return cells.groupBy("rowkey").pivot("qualifier", qualifiers).agg(F.max("value"))


def get_row(spark: SparkSession, path: str, rowkey: str, family: str | None = None) -> DataFrame:
    """Cells of one row key.  The manifest names the files whose key range holds it (one, or
    those a cut row goes on in); in these, row groups are skipped by their key range and Bloom
    filter.  Sorted files without a manifest are all asked."""
    try:
        ranges = spark.read.parquet(f"{path}/{_MANIFEST}")
    except AnalysisException:
        df = spark.read.parquet(path)
    else:
        files = ranges.where((F.col("low") <= rowkey) & (F.col("high") >= rowkey)).collect()
        schema = spark.read.parquet(path).schema
        df = spark.read.schema(schema).parquet(*[f"{path}/{r['file']}" for r in files]) if files \
            else spark.createDataFrame([], schema)
    df = df.where(F.col("rowkey") == rowkey)
    return df.where(F.col("family") == family) if family else df
