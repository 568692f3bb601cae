"""Aggregations: distribution (D1), count (D4), correlation matrix (D5), summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tag_distribution(tagged: DataFrame, tag: str, out: str = "cnt") -> DataFrame:
    """Rows per tag value."""
    return tagged.groupBy(tag).agg(F.count(F.lit(1)).alias(out))


def count_rows(df: DataFrame, out: str = "total") -> DataFrame:
    """D4 as a one-row frame (the action stays with the caller)."""
    return df.agg(F.count(F.lit(1)).alias(out))


def pair_counts(df: DataFrame, key: str, category: str, key_alias: str | None = None) -> DataFrame:
    """D3: rows per (key, category)."""
    k = F.col(key).alias(key_alias) if key_alias else F.col(key)
    return df.groupBy(k, F.col(category)).agg(F.count(F.lit(1)).alias("count"))


def corr_matrix(df: DataFrame, columns: dict, nulls: str = "drop", digits: int | None = 6,
                pairs: str = "all") -> DataFrame:
    """Pearson correlation of every pair of columns.

    ``columns`` maps output names to column names or Columns.  ``nulls='drop'``
    drops a row from a pair when either value is null (pairwise, what ``corr``
    does); ``'zero'`` treats nulls as 0.0 like the reference's primitive
    unboxing.  ``pairs='all'`` gives the full n x n matrix, ``'upper'`` only a < b in
    the given order.  Fewer than two rows, or a constant column: null; a NaN: NaN.

    One pass: each Arrow batch gives its pairs' numbers, means and co-moments by matrix products,
    batches and then tasks are merged pairwise (the co-moment of two parts is theirs and that of
    their means), so a large offset on a column costs no digits and nothing is read twice.
    """
    names = list(columns)
    cols = [(F.col(v) if isinstance(v, str) else v).cast("double") for v in columns.values()]
    if nulls == "zero":
        cols = [F.coalesce(v, F.lit(0.0)) for v in cols]
    elif nulls != "drop":
        raise ValueError("nulls must be 'drop' or 'zero'")
    slots = [f"_v{i}" for i in range(len(names))]
    projected = df.select(*[c.alias(s) for c, s in zip(cols, slots)])
    state = "i int, j int, " + ", ".join(f"{c} double" for c in _STATE)
    parts = projected.mapInArrow(_pair_states(len(names)), f"{state}, part int")
    # tasks meet in two steps: no merge gathers the states of all tasks of a large input
    some = parts.groupBy("i", "j", "part").applyInArrow(_merge_states, state)
    merged = some.groupBy("i", "j").applyInArrow(_merge_states, state)
    n, _, _, cxx, cyy, cxy, bad = (F.col(c) for c in _STATE)
    # what rounding leaves of a constant column is no variance
    flat = (cxx <= 1e-28 * n * F.col("mx") * F.col("mx")) | (cyy <= 1e-28 * n * F.col("my") * F.col("my"))
    r = F.when(bad > 0, F.lit(float("nan"))).when((n >= 2) & ~flat, cxy / F.sqrt(cxx) / F.sqrt(cyy))
    sums = merged
    label = lambda k: F.element_at(F.array(*map(F.lit, names)), F.col(k) + 1)
    out = sums.select("i", "j", label("i").alias("a"), label("j").alias("b"),
                      (F.round(r, digits) if digits is not None else r).alias("r"))
    if pairs == "upper":
        return out.where("i < j").select("a", "b", "r")
    return out.select("a", "b", "r").unionByName(
        out.where("i < j").select(F.col("b").alias("a"), F.col("a").alias("b"), "r"))


# Of the rows that have both values of a pair: number, means, co-moments; and the NaNs.
_STATE = ("n", "mx", "my", "cxx", "cyy", "cxy", "bad")
_PARTS = 64


def _merge(a, b):
    """Two states (arrays of ``_STATE`` first) as one."""
    import numpy as np
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    dx, dy, w = b[1] - a[1], b[2] - a[2], a[0] * share
    return np.stack([n, a[1] + dx * share, a[2] + dy * share, a[3] + b[3] + w * dx * dx, a[4] + b[4] + w * dy * dy,
                     a[5] + b[5] + w * dx * dy, a[6] + b[6]])


def _pair_states(k: int):
    """Per task the states of all pairs i <= j of its ``k`` columns."""
    def states(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        total = np.zeros((len(_STATE), k, k))
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in range(k)])
            there = np.column_stack([batch.column(c).is_valid().to_numpy(zero_copy_only=False)
                                     for c in range(k)])
            nan = there & np.isnan(x)
            odd = nan.astype(float).T @ there
            m = there & ~nan
            size = np.maximum(m.sum(axis=0), 1)
            centre = np.where(m, x, 0.0).sum(axis=0) / size
            x, m = np.where(m, x - centre, 0.0), m.astype(float)
            n = m.T @ m
            each = np.maximum(n, 1)
            sx = x.T @ m  # of column i over the rows that have j as well
            mx, my = sx / each, sx.T / each
            sxx = (x * x).T @ m
            own = np.stack([n, mx + centre[:, None], my + centre[None, :], sxx - n * mx * mx, sxx.T - n * my * my,
                            x.T @ x - n * mx * my, odd + odd.T])
            total = _merge(total, own)
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(i.astype(np.int32)), "j": pa.array(j.astype(np.int32)),
            **{c: pa.array(total[p][i, j]) for p, c in enumerate(_STATE)},
            "part": pa.array(np.full(len(i), TaskContext.get().partitionId() % _PARTS, np.int32))})
    return states


def _merge_states(table):
    """The states of one pair as one."""
    import numpy as np
    import pyarrow as pa
    rows = np.stack([table.column(c).to_numpy() for c in _STATE], axis=1)
    rows = rows[np.lexsort(rows.T)]  # one order of the parts, one result
    total = rows[0]
    for row in rows[1:]:
        total = _merge(total, row)
    return pa.table({"i": table.column("i").slice(0, 1), "j": table.column("j").slice(0, 1),
                     **{c: pa.array([v]) for c, v in zip(_STATE, total.tolist())}})


def numeric_summary(df: DataFrame, columns: list[str], digits: int | None = 6) -> DataFrame:
    """Count, mean, stddev, min, max per numeric column in one pass, long form."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    r = (lambda v: F.round(v, digits)) if digits is not None else (lambda v: v)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"{c}__count").alias("count"),
                     r(F.col(f"{c}__mean")).alias("mean"), r(F.col(f"{c}__stddev")).alias("stddev"),
                     F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"))
            for c in columns]
    return wide.select(F.inline(F.array(*rows)))
