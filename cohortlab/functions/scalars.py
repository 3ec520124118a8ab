"""Scalar column functions, inventory IDs F1-F10. All are built-in
expressions (whole-stage codegen), none is a Python UDF."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_month(c, strict: bool = False) -> Column:
    """F1 / F2: ``%m/%Y`` text to a timestamp. ``strict=False``: bad text -> null;
    ``strict=True``: bad text raises (ANSI ``to_timestamp``)."""
    if strict:
        return F.to_timestamp(_c(c), "M/yyyy")
    return F.try_to_timestamp(_c(c), F.lit("M/yyyy"))


def parse_day(c) -> Column:
    """``%Y-%m-%d`` text to a timestamp, bad text -> null."""
    return F.try_to_timestamp(_c(c), F.lit("yyyy-M-d"))


# Date patterns tried in order by free-format parsing.
FREE_DATE_PATTERNS = ["yyyy-M-d", "yyyy-M-d H:m:s", "M/d/yyyy", "M/yyyy", "yyyy/M/d", "d-MMM-yyyy", "yyyyMMdd"]


def parse_free_date(c, patterns: Sequence[str] = FREE_DATE_PATTERNS) -> Column:
    """first pattern that parses wins, else null."""
    return F.coalesce(*[F.try_to_timestamp(_c(c), F.lit(p)) for p in patterns])


def bin_fixed(c, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """left-closed fixed-edge binning ``[e_i, e_{i+1})``; outside -> null."""
    x = _c(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x >= lo) & (x < hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def bin_fixed_ordinal(c, edges: Sequence[float]) -> Column:
    """F5 ordinal: 0-based bin index (for ordering, O2)."""
    x = _c(c)
    expr = None
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        cond = (x >= lo) & (x < hi)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def equal_width_bin(c, lo, hi, n: int) -> Column:
    """1-based equal-width bin between ``lo`` and ``hi``, left-closed.

    The maximum itself lands in ``n + 1`` (outside, as pandas ``right=False``
    does); F10 turns that into the label ``'nan'``.
    """
    x = _c(c)
    lo_c, hi_c = (lo if isinstance(lo, Column) else F.lit(lo)), (hi if isinstance(hi, Column) else F.lit(hi))
    width = (hi_c - lo_c) / n
    b = F.floor((x - lo_c) / width).cast("long") + 1
    return F.when(x.isNull() | (x < lo_c), F.lit(None)).when(x >= hi_c, F.lit(n + 1)).otherwise(b)


def bin_label(bin_no: Column, n: int, prefix: str = "Bin ") -> Column:
    """bin number to text; outside bins become ``'nan'`` (pandas ``astype(str)``)."""
    return F.when((bin_no >= 1) & (bin_no <= n), F.concat(F.lit(prefix), bin_no.cast("string"))).otherwise(F.lit("nan"))


def split_to_doubles(c, sep: str = ",") -> Column:
    """``'1.5, 2,3'`` -> ``[1.5, 2.0, 3.0]``; bad items -> null."""
    return F.transform(F.split(_c(c), sep), lambda s: F.trim(s).try_cast("double"))


def trunc_int(c) -> Column:
    """F8: ``int(x)``: truncation toward zero."""
    return _c(c).cast("long")


# Model-type map, tested in this order on the upper-cased name.
MODEL_TYPE_RULES = [
    (("XGB", "BOOST"), "xgboost"),
    (("RF", "FOREST"), "random_forest"),
    (("LR", "LOGISTIC"), "logistic_regression"),
    (("SVM",), "svm"),
]


def model_type(name_col) -> Column:
    """substring map of a model name to its type; unmatched -> null
    (callers raise on null, like the reference)."""
    up = F.upper(_c(name_col))
    expr = None
    for needles, typ in MODEL_TYPE_RULES:
        cond = None
        for n in needles:
            cond = up.contains(n) if cond is None else (cond | up.contains(n))
        expr = F.when(cond, F.lit(typ)) if expr is None else expr.when(cond, F.lit(typ))
    return expr
