"""Top-N per group (E1 DSL form, E2 SQL form)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, keys, order: list[tuple[str, bool]], n: int = 1,
                    rank_col: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group by ``order`` ([(column, descending)...]).

    Nulls come last in a descending and first in an ascending order, NaN counts as larger
    than any number, as in the SQL form.  The order must be total (end with a unique
    column) for a repeatable answer.  Spark keeps at most ``n`` rows of a group per map
    task before the shuffle, so a hot group costs no more than any other."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() if d
                                            else F.col(c).asc_nulls_first() for c, d in order])
    rank = rank_col or "_rn"
    ranked = df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)
    return ranked if rank_col else ranked.drop(rank)


def top_n_per_group_sql(spark: SparkSession, df: DataFrame, view: str, keys: list[str],
                        order_sql: str, columns: list[str], n: int = 1) -> DataFrame:
    """The same through a CTE with ``ROW_NUMBER()`` over the temp view ``view``,
    which is dropped once the statement is analysed."""
    df.createOrReplaceTempView(view)
    try:
        return spark.sql(f"""
            WITH ranked AS (
                SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order_sql}) AS rnk
                FROM {view})
            SELECT {', '.join(columns)} FROM ranked WHERE rnk <= {int(n)}""")
    finally:
        spark.catalog.dropTempView(view)
