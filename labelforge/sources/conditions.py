"""Scan filter conditions (A3) and the relative date window (A4).

Condition text: ``field[OP]value`` items joined by ``,``; OP is one of
eq ne gt lt ge le in any case.  The comparison is on the cell's *text*
(byte order), exactly like a string-typed wide table.  When the stored column is
typed (date/timestamp shown as ``yyyy-MM-dd``, or an integer), an equivalent
typed predicate is produced where that is provably identical, so the filter is
pushed to the Parquet scan; otherwise the text comparison is kept.
"""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelforge.functions.dates import UNIT_DAYS

# The six comparison operator names of the condition language.
OPERATORS = ("eq", "ne", "gt", "lt", "ge", "le")

_DATE_RE = re.compile(r"^\d{4}-\d{2}-\d{2}$")
_INT_RE = re.compile(r"^(0|-?[1-9][0-9]*)$")  # exactly the text Spark prints for an integer


@dataclass(frozen=True)
class Condition:
    field: str
    op: str
    value: str


def parse_condition(text: str) -> Condition:
    field, opened, rest = text.strip().partition("[")
    op, closed, value = rest.partition("]")
    if not opened or not closed:
        raise ValueError(f"malformed condition {text!r}; expected field[OP]value")
    field, op, given = field.strip(), op.strip().lower(), op
    if op not in OPERATORS:
        raise ValueError(f"unknown operator {given!r} in condition {text!r}")
    if not field:
        raise ValueError(f"missing field in condition {text!r}")
    return Condition(field, op, value)


def parse_conditions(text: str | None) -> list[Condition]:
    """Parse ``a[GE]x,b[NE]y``.  A value cannot contain ``,`` (list separator)."""
    if text is None or not text.strip():
        return []
    return [parse_condition(part) for part in text.split(",") if part.strip()]


def _compare(left: Column, op: str, right) -> Column:
    return {
        "eq": lambda: left == right, "ne": lambda: left != right,
        "gt": lambda: left > right, "lt": lambda: left < right,
        "ge": lambda: left >= right, "le": lambda: left <= right,
    }[op]()


def _valid_date(value: str) -> _dt.date | None:
    if not _DATE_RE.match(value):
        return None
    try:
        return _dt.date.fromisoformat(value)
    except ValueError:
        return None


def condition_column(cond: Condition, raw: Column, raw_type: T.DataType,
                     text: Column, date_format: str = "yyyy-MM-dd",
                     missing: str = "drop") -> Column:
    """Predicate for one condition.

    ``raw`` is the stored column, ``text`` its string form as the wide table shows
    it.  ``missing='keep'`` lets rows without the cell (null) pass, as a server-side
    column filter without ``filterIfMissing`` does.
    """
    pred = None
    if isinstance(raw_type, (T.DateType, T.TimestampType, T.TimestampNTZType)) \
            and date_format == "yyyy-MM-dd":
        d = _valid_date(cond.value)
        if d is not None:
            # text(raw) OP 'YYYY-MM-DD'  <=>  typed comparison on day boundaries
            lo = F.lit(d.isoformat()).cast(raw_type)
            hi = F.lit((d + _dt.timedelta(days=1)).isoformat()).cast(raw_type)
            pred = {
                "ge": lambda: raw >= lo, "gt": lambda: raw >= hi,
                "lt": lambda: raw < lo, "le": lambda: raw < hi,
                "eq": lambda: (raw >= lo) & (raw < hi),
                "ne": lambda: (raw < lo) | (raw >= hi),
            }[cond.op]()
    elif isinstance(raw_type, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)) \
            and cond.op in ("eq", "ne") and _INT_RE.match(cond.value):
        # canonical integer text equals the cast text exactly when the numbers are equal
        pred = _compare(raw, cond.op, F.lit(int(cond.value)).cast(raw_type))
    elif isinstance(raw_type, T.StringType):
        pred = _compare(raw, cond.op, F.lit(cond.value))
    if pred is None:
        pred = _compare(text, cond.op, F.lit(cond.value))
    if missing == "keep":
        pred = pred | raw.isNull()
    elif missing != "drop":
        raise ValueError("missing must be 'keep' or 'drop'")
    return pred


def relative_window(where: str, as_of: str) -> str:
    """A4: ``field#unit#n`` -> ``field[GE]ago,field[LE]yesterday``.

    yesterday = as_of - 1 day; ago = yesterday - n * days(unit); dates are
    ``yyyy-MM-dd`` text.  ``as_of`` replaces the wall clock for repeatability.
    """
    parts = where.split("#")
    if len(parts) != 3:
        raise ValueError(f"malformed relative window {where!r}; expected field#unit#n")
    field, unit, amount = parts
    if unit not in UNIT_DAYS:
        raise ValueError(f"unknown unit {unit!r} in {where!r}")
    yesterday = _dt.date.fromisoformat(as_of) - _dt.timedelta(days=1)
    ago = yesterday - _dt.timedelta(days=int(amount) * UNIT_DAYS[unit])
    return f"{field}[GE]{ago.isoformat()},{field}[LE]{yesterday.isoformat()}"
