"""Spreadsheet criteria aggregates.

A criteria spec is a mapping column -> condition.  A condition is a plain
value (equality), a string with a comparison prefix (``">=100"``, ``"<>East"``),
or a ``(low, high)`` tuple for an inclusive range.  All conditions are ANDed.

Many cells over the same data are computed in *one* aggregation pass
(:func:`criteria_cells`), never one scan per cell.
"""

from __future__ import annotations

import re
from typing import Any, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OP = re.compile(r"^(>=|<=|<>|>|<|=)(.*)$")


def _typed(raw: str):
    try:
        return int(raw)
    except ValueError:
        try:
            return float(raw)
        except ValueError:
            return raw


def _equal(col: Column, value: Any, ignore_case: bool) -> Column:
    if ignore_case and isinstance(value, str):
        return F.lower(col) == F.lower(F.lit(value))
    return col == F.lit(value)


def condition(col: Column, cond: Any, ignore_case: bool = False) -> Column:
    """One spreadsheet condition on a column (value, comparison string or inclusive range).

    As in a spreadsheet, ``<>x`` holds for a blank (NULL) cell, and no other
    comparison does.
    """
    if isinstance(cond, tuple) and len(cond) == 2:
        lo, hi = cond
        return col.between(F.lit(lo), F.lit(hi))
    if isinstance(cond, str):
        m = _OP.match(cond)
        if m:
            op, value = m.group(1), _typed(m.group(2))
            if op == "=":
                return _equal(col, value, ignore_case)
            if op == "<>":
                return ~F.coalesce(_equal(col, value, ignore_case), F.lit(False))
            v = F.lit(value)
            return {">=": col >= v, "<=": col <= v, ">": col > v, "<": col < v}[op]
    return _equal(col, cond, ignore_case)


def criteria(spec: Mapping[str, Any], ignore_case: bool = False) -> Column:
    """AND of all conditions (an empty spec matches everything)."""
    pred = F.lit(True)
    for name, cond in spec.items():
        pred = pred & condition(F.col(name), cond, ignore_case)
    return pred


def sumifs_expr(value: str, spec: Mapping[str, Any], **kw) -> Column:
    """SUMIFS; no match -> 0."""
    return F.coalesce(F.sum(F.when(criteria(spec, **kw), F.col(value))), F.lit(0))


def countifs_expr(spec: Mapping[str, Any], **kw) -> Column:
    """COUNTIFS; no match -> 0."""
    return F.count_if(criteria(spec, **kw))


def averageifs_expr(value: str, spec: Mapping[str, Any], weight: str | None = None, digits: int | None = None, **kw) -> Column:
    """AVERAGEIFS; no match -> NULL (the spreadsheet shows #DIV/0!).

    With ``weight`` the rows are already reduced: ``value`` holds sums over
    ``weight`` rows each.  ``digits`` rounds the average of money or counts exactly.
    """
    hit = criteria(spec, **kw)
    if weight is None and digits is None:
        return F.avg(F.when(hit, F.col(value)))
    from ..plans.common import money_div
    n = F.sum(F.when(hit, F.col(weight))) if weight else F.count(F.when(hit, F.col(value)))
    total = F.sum(F.when(hit, F.col(value)))
    return money_div(total, n, digits) if digits is not None else F.try_divide(total, n)


def sumifs(df: DataFrame, value: str, spec, **kw) -> DataFrame:
    """D8 as a one-row DataFrame."""
    return df.agg(sumifs_expr(value, spec, **kw).alias("sumifs"))


def countifs(df: DataFrame, spec, **kw) -> DataFrame:
    """D9 as a one-row DataFrame."""
    return df.agg(countifs_expr(spec, **kw).alias("countifs"))


def averageifs(df: DataFrame, value: str, spec, **kw) -> DataFrame:
    """D10 as a one-row DataFrame."""
    return df.agg(averageifs_expr(value, spec, **kw).alias("averageifs"))


def criteria_cells(df: DataFrame, cells: Mapping[str, tuple], group_by=(), **kw) -> DataFrame:
    """Evaluate many criteria cells in one pass.

    ``cells`` maps an output name to ``("sum", value, spec)``,
    ``("count", spec)`` or ``("avg", value, spec[, weight, digits])``.  With ``group_by`` the
    same cells are computed per group (a whole dashboard column at once).
    """
    exprs = []
    for name, cell in cells.items():
        kind = cell[0]
        if kind == "sum":
            e = sumifs_expr(cell[1], cell[2], **kw)
        elif kind == "count":
            e = countifs_expr(cell[1], **kw)
        elif kind == "avg":
            e = averageifs_expr(*cell[1:], **kw)
        else:
            raise ValueError(f"unknown cell kind {kind!r}")
        exprs.append(e.alias(name))
    return df.groupBy(*group_by).agg(*exprs) if group_by else df.agg(*exprs)


def kpis(df: DataFrame, value: str, count_col: str, weight: str | None = None, digits: int = 2, *more: Column) -> DataFrame:
    """SUM / AVERAGE / COUNTA in one global aggregation (``weight``: rows a reduced
    row stands for); ``more`` aggregates are computed in the same pass."""
    counta = F.sum(F.when(F.col(count_col).isNotNull(), F.col(weight))) if weight else F.count(count_col)
    return df.agg(F.sum(value).alias("total"), averageifs_expr(value, {}, weight, digits).alias("average"),
                  counta.alias("counta"), *more)


def split_sums(df: DataFrame, type_col: str, amount: str, positive: str = "Income",
               group_by=()) -> DataFrame:
    """Income and expense totals in one pass."""
    inc = F.coalesce(F.sum(F.when(F.col(type_col) == positive, F.col(amount))), F.lit(0))
    exp = F.coalesce(F.sum(F.when(F.col(type_col) != positive, F.col(amount))), F.lit(0))
    aggs = [inc.alias("income"), exp.alias("expense")]
    return df.groupBy(*group_by).agg(*aggs) if group_by else df.agg(*aggs)
