"""Lookup tables and score helpers."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical results).
# Rating letters in order, and the three letter -> score scales (before x10).
RATING_LETTERS = ("AAA", "AA", "A", "BBB", "BB", "B", "CCC", "CC", "C", "D")
SCALE_ANALYSIS = (1.0, 1.0, 0.8, 0.7, 0.6, 0.5, 0.2, 0.2, 0.2, 0.2)
SCALE_REGRESSION = (1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.4, 0.4, 0.4)
SCALE_TREE = (1.0, 0.8, 0.8, 0.7, 0.5, 0.5, 0.3, 0.3, 0.3, 0.1)
SCORE_FACTOR = 10.0
# Score -> letter: a score within 0.1 of k gives the letter, for k = 10 down to 4.
SCORE_LETTERS = ((10, "AAA"), (9, "AA"), (8, "A"), (7, "BBB"), (6, "BB"), (5, "B"), (4, "CCC"))
SCORE_TOLERANCE = 0.1
# Payment codes and their display names.
PAYMENT_CODES = ("alipay", "wxpay", "chinapay", "cod")
PAYMENT_NAMES = {"alipay": "支付宝", "wxpay": "微信支付", "chinapay": "银联支付", "cod": "货到付款"}
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def scale(values) -> dict:
    """Letter -> score map for one of the SCALE_* tuples."""
    return dict(zip(RATING_LETTERS, values))


def lookup(col, mapping: dict) -> Column:
    """Value -> mapped value through a literal map; unknown -> null."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(m, _c(col))


def letter_to_score(col, mapping: dict, factor: float = SCORE_FACTOR) -> Column:
    """Letter -> score * factor; unknown letter -> null."""
    return (lookup(col, {k: float(v) for k, v in mapping.items()}) * F.lit(factor)).cast("double")


def score_to_letter(col, letters=SCORE_LETTERS, tol: float = SCORE_TOLERANCE) -> Column:
    """Nearest letter within ``tol``; otherwise the empty string."""
    x = _c(col)
    expr = None
    for k, letter in letters:
        cond = F.abs(x - F.lit(float(k))) < F.lit(tol)
        expr = F.when(cond, F.lit(letter)) if expr is None else expr.when(cond, F.lit(letter))
    return expr.otherwise(F.lit(""))


def tolerance_flag(prediction, score, tol: float = 1.0) -> Column:
    """0.0 when |prediction - score| <= tol, else 1.0."""
    return F.when(F.abs(_c(prediction) - _c(score)) <= F.lit(tol), F.lit(0.0)).otherwise(F.lit(1.0))
