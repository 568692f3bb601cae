"""Small literal frames (rule sets, catalogs) built inside the JVM.

``spark.createDataFrame(list)`` scans a Python-side RDD, so every job touching the
frame starts Python workers.  An ``inline`` of literal structs over a one-row
range is a pure JVM plan (constant-folded, whole-stage codegen) and its row
count is known on the driver, which proves the bound for a broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(schema) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    from pyspark.sql.types import _parse_datatype_string
    return _parse_datatype_string(schema)


def literal_frame(spark: SparkSession, rows, schema) -> DataFrame:
    """Rows (tuples) with a StructType or DDL schema -> DataFrame, one partition."""
    st = _schema(schema)
    base = spark.range(0, 1, 1, 1)
    if not rows:
        return base.where(F.lit(False)).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in st.fields])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, st.fields)])
               for r in rows]
    return base.select(F.inline(F.array(*structs)))
