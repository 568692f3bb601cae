"""Rule text parsing (H1-H3), as Column expressions (no Python UDF)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# Characters trimmed off keys, values and bounds: all ASCII white space and control signs.
_BLANK = "[\\x00-\\x20]"


def trim(c: Column) -> Column:
    return F.regexp_replace(c, f"^{_BLANK}+|{_BLANK}+$", "")


def kv_entries(text, line_sep: str = "\n", kv_sep: str = "=", strict: bool = True) -> Column:
    """``key=value`` lines -> array<struct<key,value>> in line order.

    Keys and values are trimmed; the value keeps any later separator
    (``a=b=c`` gives ``a -> b=c``).  Blank lines are skipped.  With ``strict`` a
    non-blank line without the separator raises, like the reference's pattern
    match failure; otherwise such lines are dropped.
    """
    lines = F.filter(F.split(_c(text), re.escape(line_sep), -1), lambda l: trim(l) != "")
    if strict:
        lines = F.transform(lines, lambda l: F.when(
            l.contains(kv_sep), l).otherwise(
            F.raise_error(F.concat(F.lit("rule line without '" + kv_sep + "': "), l)).cast("string")))
    else:
        lines = F.filter(lines, lambda l: l.contains(kv_sep))
    return F.transform(lines, lambda l: F.struct(
        trim(F.substring_index(l, kv_sep, 1)).alias("key"),
        trim(l.substr(F.instr(l, kv_sep) + len(kv_sep), F.length(l))).alias("value")))


def parse_kv_rule(text, line_sep: str = "\n", kv_sep: str = "=", strict: bool = True) -> Column:
    """H1: rule text -> map<string,string>; a repeated key keeps its LAST value.

    The entries are folded left to right into a map, each entry first removing an
    earlier value of its key, so the result does not depend on
    ``spark.sql.mapKeyDedupPolicy`` and the entry array is built once per row.
    """
    entries = kv_entries(text, line_sep, kv_sep, strict)
    empty = F.create_map().cast("map<string,string>")
    return F.aggregate(entries, empty, lambda acc, x: F.map_concat(
        F.map_filter(acc, lambda k, v: k != x["key"]), F.create_map(x["key"], x["value"])))


BAD_RULE_POLICIES = ("error", "drop")


def parse_range(text, sep: str = "-", kind: str = "int", on_bad_rule: str = "error") -> Column:
    """H2/H3: ``start<sep>end`` -> struct<start,end> of ``kind`` (int, long, double).

    A bound may have a minus sign of its own (``-10-5``, ``-10--5``).  Text that is not
    two numbers fails the job; with ``on_bad_rule='drop'`` it gives null bounds, so the
    rule matches nothing.  Null text gives null bounds.
    """
    if on_bad_rule not in BAD_RULE_POLICIES:
        raise ValueError(f"on_bad_rule must be one of {BAD_RULE_POLICIES}")
    raw = _c(text)
    clean = trim(raw)
    # the separator is the first one behind a digit or point: one ahead is a sign
    shape = f"^([+-]?[0-9.]+(?:[eE][+-]?[0-9]+)?){_BLANK}*{re.escape(sep)}{_BLANK}*" \
            "([+-]?[0-9.]+(?:[eE][+-]?[0-9]+)?)$"
    start, end = (F.regexp_extract(clean, shape, k).try_cast(kind) for k in (1, 2))
    if on_bad_rule == "error":
        bad = raw.isNotNull() & (start.isNull() | end.isNull())
        failed = F.raise_error(F.concat(F.lit("malformed range rule: "), raw)).cast(kind)
        start = F.when(bad, failed).otherwise(start)
    else:
        both = start.isNotNull() & end.isNotNull()
        start, end = F.when(both, start), F.when(both, end)
    return F.struct(start.alias("start"), end.alias("end"))
