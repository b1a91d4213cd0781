"""Lookups and mappings.

Lookup tables are joined, never collected.  Equi-joins are left to AQE (a
broadcast only when the measured side is small); the bracket lookup is an
as-of join of one form for tables of any size.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import proper
from .windows import global_running


def first_match(table: DataFrame, key: str, pos: str) -> DataFrame:
    """Keep the first row per key (lowest ``pos``), like a top-down spreadsheet scan.

    An aggregate (partial per task) rather than a window, so a key repeated
    a billion times costs one row per task before the shuffle.
    """
    others = [c for c in table.columns if c != key]
    if not others:
        return table.distinct()
    s = F.struct(*[F.col(c) for c in others])
    return (table.groupBy(key).agg(F.min_by(s, F.col(pos)).alias("_row"))
                 .select(key, *[F.col(f"_row.{c}").alias(c) for c in others]))


def _lookup_table(table: DataFrame, key: str, cols: Sequence[str], pos: str) -> DataFrame:
    wanted = list(dict.fromkeys([*cols, pos]))
    t = table.select(F.col(key).alias("_lk"), *[F.col(c).alias(f"_v{i}") for i, c in enumerate(wanted)])
    return first_match(t.where(F.col("_lk").isNotNull()), "_lk", f"_v{wanted.index(pos)}")


def exact_lookup(df: DataFrame, value_col: str, table: DataFrame, key: str,
                 returns: Sequence[str], pos: str, prefix: str = "") -> DataFrame:
    """VLOOKUP(v, table, col, FALSE) / INDEX-MATCH: first match by ``pos``, missing -> NULL."""
    t = _lookup_table(table, key, returns, pos)
    t = t.select("_lk", *[F.col(f"_v{i}").alias(prefix + r) for i, r in enumerate(returns)])
    return df.join(t, df[value_col] == t["_lk"], "left").drop("_lk")


def xlookup(df: DataFrame, value_col: str, table: DataFrame, key: str, ret: str, out: str, pos: str,
            default="Not found") -> DataFrame:
    """XLOOKUP with a default for *no match* only (a matched NULL stays NULL)."""
    t = _lookup_table(table, key, [ret], pos).select("_lk", F.col("_v0").alias("_lv"), F.lit(True).alias("_hit"))
    j = df.join(t, df[value_col] == t["_lk"], "left")
    return j.withColumn(out, F.when(F.col("_hit"), F.col("_lv").cast("string"))
                             .otherwise(F.lit(default))).drop("_lk", "_lv", "_hit")


def bracket_lookup(df: DataFrame, value_col: str, brackets: DataFrame, lo: str, ret: str, out: str, pos: str) -> DataFrame:
    """VLOOKUP(v, brackets, 2, TRUE): the row with the largest ``lo`` <= v.

    Below the first bound the answer is NULL, as for a NULL value.  The answer
    depends on the value alone: the *distinct* values and the bounds, in the
    wider of their two types, are put in one global order (a bound before an
    equal value), a running maximum of the bounds gives each value its bracket,
    and an equi-join on the value brings it back to every row (a hot value is
    one row until then; AQE splits that join).
    """
    b = _lookup_table(brackets, lo, [ret], pos)
    kind = df.select(F.col(value_col).alias("_v")).union(b.select("_lk")).schema["_v"].dataType
    b = b.select(F.col("_lk").cast(kind).alias("_lk"), F.col("_v0").alias("_ans"))
    values = df.select(F.col(value_col).cast(kind).alias("_v")).where(F.col("_v").isNotNull()).distinct()
    merged = values.select("_v", F.lit(1).alias("_kind"), F.lit(None).cast(kind).alias("_bound")).unionByName(
        b.select(F.col("_lk").alias("_v"), F.lit(0).alias("_kind"), F.col("_lk").alias("_bound")))
    run = global_running(merged, [("_v", True), ("_kind", True)], {"_lk": ("max", "_bound")})
    found = run.where(F.col("_kind") == 1).select("_v", "_lk").join(b, "_lk").select(F.col("_v").alias("_lv"), "_ans")
    j = df.join(found, df[value_col].cast(kind) == found["_lv"], "left")
    return j.withColumn(out, F.col("_ans")).drop("_ans", "_lv")


def map_lookup(c: Column, mapping: Mapping[str, str]) -> Column:
    """Literal dictionary lookup (NULL when absent)."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, c)


def map_with_fallback(c: Column, mapping: Mapping[str, str], fallback: str = "title") -> Column:
    """C11: ``mapping.get(lower(trim(x)), title(trim(x)))``; NULL stays NULL."""
    key = F.lower(F.trim(c))
    alt = proper(F.trim(c)) if fallback == "title" else F.trim(c)
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(F.coalesce(map_lookup(key, mapping), alt))


def join_budget(df: DataFrame, budgets: DataFrame, key: str, budget_col: str = "budget") -> DataFrame:
    """Attach a budget per category; missing -> 0 (AQE broadcasts the
    budget table when it is measured small)."""
    b = budgets.select(F.col(key), F.col(budget_col))
    return df.join(b, key, "left").withColumn(budget_col, F.coalesce(F.col(budget_col), F.lit(0)))


def month_scaffold(keys: DataFrame, key_cols: Sequence[str], start, end, month_col: str = "month") -> DataFrame:
    """Every key × every month from start to end (first-of-month dates or columns).

    Generated per key row with ``explode(sequence(...))``; the key table is a
    dimension (categories, regions), not a fact table.
    """
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    months = F.explode(F.sequence(as_col(start), as_col(end), F.expr("INTERVAL 1 MONTH")))
    return keys.select(*key_cols).distinct().select(*key_cols, months.alias(month_col))


def fill_scaffold(scaffold: DataFrame, facts: DataFrame, on: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Left join the facts onto the scaffold, zeros where no data."""
    j = scaffold.join(facts, list(on), "left")
    for m in measures:
        j = j.withColumn(m, F.coalesce(F.col(m), F.lit(0)))
    return j
