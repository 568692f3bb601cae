"""Wide business table scan (A2, A3, A4) and rule-driven source dispatch.

A wide table exposes every selected column as nullable STRING.  Here it is a
Parquet (or other) table; only the selected and filter columns are read
(column pruning at the scan) and conditions become Column predicates that
Catalyst pushes to the scan.
"""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelforge.sources.conditions import (condition_column, parse_conditions,
                                           relative_window)
from labelforge.sources.tables import read_jdbc


def text_of(df: DataFrame, name: str, date_format: str = "yyyy-MM-dd") -> Column:
    """String view of a stored column, as the wide table shows it."""
    if name not in df.columns:
        return F.lit(None).cast("string")
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, T.StringType):
        return c
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, date_format)
    return c.cast("string")


def filter_conditions(df: DataFrame, conditions: str | None, missing: str = "drop",
                      date_format: str = "yyyy-MM-dd") -> DataFrame:
    """A3: apply ``f[OP]v,...`` (AND-ed).  A condition on a column the table does
    not have compares a null cell: it passes only with ``missing='keep'``."""
    preds = []
    for cond in parse_conditions(conditions):
        if cond.field in df.columns:
            raw = F.col(cond.field)
            raw_type = df.schema[cond.field].dataType
        else:
            raw, raw_type = F.lit(None).cast("string"), T.StringType()
        preds.append(condition_column(cond, raw, raw_type, text_of(df, cond.field, date_format),
                                      date_format, missing))
    return df.where(reduce(lambda a, b: a & b, preds)) if preds else df


def read_wide(source: DataFrame, fields: list[str] | str, conditions: str | None = None,
              missing: str = "drop", date_format: str = "yyyy-MM-dd") -> DataFrame:
    """A2 + A3: select ``fields`` as STRING columns after the condition filter.

    ``source`` is an unread DataFrame (e.g. ``spark.read.parquet(path)``); the
    projection and the predicates both reach its scan.  Filter columns are read but
    not returned; a field the table lacks comes back as null.
    """
    if isinstance(fields, str):
        fields = [f.strip() for f in fields.split(",") if f.strip()]
    df = filter_conditions(source, conditions, missing, date_format)
    return df.select([text_of(df, f, date_format).alias(f) for f in fields])


def read_wide_window(source: DataFrame, fields, where: str, as_of: str,
                     missing: str = "drop") -> DataFrame:
    """A4: relative window ``field#unit#n`` ending yesterday (relative to ``as_of``)."""
    return read_wide(source, fields, relative_window(where, as_of), missing)


# ---------------------------------------------------------------- A6 dispatch
# inType, selectFieldNames and whereCondition are keys of the rule format,
# those of a relational source beside url and table are its own.
JDBC_RANGE_KEYS = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def _need(meta: dict, key: str) -> str:
    if not meta.get(key):
        raise ValueError(f"rule for inType={meta.get('inType')!r} lacks {key!r}")
    return meta[key]


def folder_parts(spark: SparkSession, kind: str, path: str, merge: bool = True) -> list[DataFrame]:
    """A folder of Parquet or ORC files whose columns may differ, as frames that together hold
    every cell.

    Spark merges the schemas of the footers in one job; a column a file lacks is null there.
    Files that store a column with types that cannot be merged are read per schema instead:
    as text, which is how the wide table shows them, they do meet.  ``merge=False`` trusts one
    footer, for folders known to be uniform."""
    reader = spark.read.option("mergeSchema", merge)
    try:
        return [reader.format(kind).load(path)]
    except (PySparkException, Py4JJavaError) as e:
        if not merge or "merge" not in str(e).lower():
            raise
    one = spark.read.option("mergeSchema", False).option("basePath", path).format(kind)
    by_schema: dict[str, list[str]] = {}
    for name in one.load(path).inputFiles():
        by_schema.setdefault(one.load(name).schema.json(), []).append(name)
    return [one.load(files) for _, files in sorted(by_schema.items())]


def _parts(spark: SparkSession, meta: dict) -> list[DataFrame]:
    """The business table as one frame, or as several whose cells belong together."""
    kind = meta.get("inType", "").strip().lower()
    if kind in ("parquet", "orc"):
        _need(meta, "path")
        return folder_parts(spark, kind, meta["path"], meta.get("mergeSchema", "true").strip().lower() == "true")
    return [_reader(spark, meta)]


def _reader(spark: SparkSession, meta: dict) -> DataFrame:
    kind = meta.get("inType", "").strip().lower()
    if kind in ("csv", "tsv"):
        _need(meta, "path")
    elif kind in ("table", "jdbc"):
        _need(meta, "table")
    if kind == "table":
        return spark.table(meta["table"])
    if kind in ("csv", "tsv"):
        sep = meta.get("sep", "\t" if kind == "tsv" else ",")
        reader = spark.read.option("sep", sep).option("header", meta.get("header", "true"))
        # files whose header differs from the first one's are an error, not shifted cells
        return reader.option("inferSchema", "false").option("enforceSchema", "false").csv(meta["path"])
    if kind == "jdbc":
        # a relational table is read by ranges of one column, or it would be one task's work
        column, low, high, parts = (_need(meta, k) for k in JDBC_RANGE_KEYS)
        return read_jdbc(spark, _need(meta, "url"), meta["table"],
                         {k[5:]: v for k, v in meta.items() if k.startswith("jdbc.")},
                         column, int(low), int(high), int(parts))
    raise ValueError(f"unsupported inType {meta.get('inType')!r}")


def business_data(spark: SparkSession, meta: dict, as_of: str | None = None,
                  missing: str = "drop") -> DataFrame:
    """Read the business data a level-4 rule points at.

    ``meta`` is the parsed rule (see ``rule_map``): ``inType`` picks the reader,
    ``selectFieldNames`` the columns, ``whereCondition`` (``field#unit#n``, needs
    ``as_of``) and/or ``filterConditions`` (``f[OP]v,...``) the rows.  A folder's files may
    have different columns and types (``folder_parts``).
    """
    parts = _parts(spark, meta)
    _need(meta, "selectFieldNames")
    conds = [c for c in [meta.get("filterConditions")] if c]
    if meta.get("whereCondition"):
        if as_of is None:
            raise ValueError("whereCondition needs as_of")
        conds.append(relative_window(meta["whereCondition"], as_of))
    return reduce(lambda a, b: a.unionByName(b),
                  [read_wide(p, meta["selectFieldNames"], ",".join(conds) or None, missing) for p in parts])


def rule_map(rule_text: str) -> dict:
    """Driver-side parse of ONE level-4 rule string (the only value that reaches
    the driver): ``key=value`` lines, trimmed of white space and control signs, split on the
    first ``=``, last key wins."""
    out, blank = {}, "".join(map(chr, range(33)))
    for line in rule_text.split("\n"):
        if not line.strip(blank):
            continue
        if "=" not in line:
            raise ValueError(f"rule line without '=': {line!r}")
        k, v = line.split("=", 1)
        out[k.strip(blank)] = v.strip(blank)
    return out
