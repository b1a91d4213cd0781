"""Declared data-quality rules (K1-K6).

Every check returns rows ``(rule, table, checked, violations)``.  ``row_rules``, ``unique_key`` and
``foreign_key`` are single checks; ``check_tables`` takes all rules of several tables at once, with one
scan a table and one shuffle for all their keys.  ``violating_rows`` returns the offending rows themselves on request.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_COLUMNS = ["rule", "table", "checked", "violations"]


def row_rules(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """K1/K4/K5/K6: ``rules`` maps a rule name to a *passing* condition.

    SQL CHECK semantics: a NULL outcome passes, so a violation is
    ``NOT coalesce(cond, TRUE)``.  All rules in one pass.
    """
    aggs = [F.count(F.lit(1)).alias("_checked")]
    names = list(rules)
    for i, name in enumerate(names):
        aggs.append(F.count_if(~F.coalesce(rules[name], F.lit(True))).alias(f"_r{i}"))
    wide = df.agg(*aggs)
    stack = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"_r{i}").alias("violations"))
                                for i, n in enumerate(names)]))
    return (wide.select(F.col("_checked").alias("checked"), stack.alias("_x"))
                .select(F.col("_x.rule").alias("rule"), F.lit(table).alias("table"), "checked",
                        F.col("_x.violations").alias("violations")))


def not_null_rules(cols: Sequence[str]) -> dict[str, Column]:
    """K1."""
    return {f"not_null({c})": F.col(c).isNotNull() for c in cols}


def _result(df: DataFrame, rule: str, table: str) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), F.lit(table).alias("table"), F.col("checked").cast("long").alias("checked"),
                     F.coalesce("violations", F.lit(0)).cast("long").alias("violations"))


def unique_key(df: DataFrame, table: str, cols: Sequence[str], rule: str | None = None) -> DataFrame:
    """K2: rows whose key value occurs more than once.  NULL keys never collide
    (SQL UNIQUE).  One grouping (partial aggregation first) gives both the rows
    checked and the violations."""
    rule = rule or f"unique({', '.join(cols)})"
    has_key = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"), F.max(has_key).alias("_k"))
    return _result(g.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("checked"),
                         F.sum(F.when(F.col("_k") & (F.col("_n") > 1), F.col("_n"))).alias("violations")), rule, table)


def foreign_key(child: DataFrame, table: str, fk: str, parent: DataFrame, pk: str,
                rule: str | None = None) -> DataFrame:
    """K3: child rows whose non-NULL key has no parent.  The child is reduced to
    (key, rows) by a partial aggregation first, so a hot key is one row in the
    join with the parent's distinct keys."""
    rule = rule or f"foreign_key({fk})"
    per_key = child.groupBy(F.col(fk).alias("_fk")).agg(F.count(F.lit(1)).alias("_n"))
    keys = parent.select(F.col(pk).alias("_pk")).distinct().withColumn("_hit", F.lit(True))
    j = per_key.join(keys, F.col("_fk") == F.col("_pk"), "left")
    return _result(j.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("checked"),
                         F.sum(F.when(F.col("_fk").isNotNull() & F.col("_hit").isNull(), F.col("_n"))).alias("violations")), rule, table)


@dataclass
class Declared:
    """A table with its declared rules: passing conditions, unique keys, and references
    (column, table referred to, its column)."""
    name: str
    df: DataFrame
    rules: dict[str, Column] = field(default_factory=dict)
    unique: Sequence[Sequence[str]] = ()
    foreign: Sequence[tuple[str, str, str]] = ()


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _key(cols: Sequence[str], whole: bool) -> list[Column]:
    """A key as (long, long, text), all NULL if any of its columns is: one or two whole numbers as they are,
    others as one text, each value with its length, so that no two keys fall together."""
    has = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    none, text = F.lit(None).cast("long"), F.lit(None).cast("string")
    if whole:
        a, b = (F.when(has, F.col(c).cast("long")) for c in (cols[0], cols[-1]))
        return [a, b, text]
    parts = [F.col(c).cast("string") for c in cols]
    return [none, none, F.concat(*(x for p in parts for x in (F.char_length(p).cast("string"), F.lit(":"), p)))]


def check_tables(tables: Sequence[Declared]) -> DataFrame:
    """All rules of all tables, in one scan a table and one shuffle.

    A key that is declared unique or referred to is a space of values.  Each row is expanded to an entry for each
    space that it has a value in, as owner or as reference, and one for each row rule that it breaks.  One grouping by
    (space, value), reduced in the tasks first, so that a hot value is one row a task, gives the owners and the references
    of each value: two owners break the unique rule, references without an owner the foreign one.  NULL keys break
    neither.  A second grouping leaves one row a space.
    """
    by_name = {t.name: t for t in tables}
    spaces: dict[tuple[str, tuple[str, ...]], int] = {}
    referrers: dict[int, int] = {}   # space -> references that it has so far
    for t in tables:
        for u in t.unique or ([t.df.columns[0]],):   # a table without a key still has its rows counted
            spaces.setdefault((t.name, tuple(u)), len(spaces))
    first = {t.name: next(no for (name, _), no in spaces.items() if name == t.name) for t in tables}
    refs = []   # (table, column, space, number of the reference there)
    for t in tables:
        for fk, parent, pk in t.foreign:
            space = spaces.setdefault((parent, (pk,)), len(spaces))
            referrers[space] = referrers.get(space, -1) + 1
            refs.append((t.name, fk, space, referrers[space]))
    kind = {(t.name, c): isinstance(t.df.schema[c].dataType, _WHOLE) for t in tables for c in t.df.columns}
    whole = {no: len(cols) <= 2 and all(kind[name, c] for c in cols) and all(kind[n, fk] for n, fk, space, _ in refs if space == no)
             for (name, cols), no in spaces.items()}
    rule_no = {(t.name, r): len(spaces) + i for i, (t, r) in enumerate((t, r) for t in tables for r in t.rules)}

    def entry(space, key, ref, keep):
        a, b, text = key
        e = F.struct(F.lit(space).alias("space"), a.alias("a"), b.alias("b"), text.alias("text"), F.lit(ref).alias("ref"))
        return e if keep is None else F.when(keep, e)

    def has(key):
        return key[0].isNotNull() | key[2].isNotNull()

    nothing = [F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(None).cast("string")]
    parts = []
    for t in by_name.values():
        found = []
        for (name, cols), no in spaces.items():
            if name == t.name:   # rows are counted in the first space, so it takes NULL keys as well
                key = _key(cols, whole[no])
                found.append(entry(no, key, -1, None if no == first[name] else has(key)))
        for name, fk, space, ref in refs:
            if name == t.name:
                key = _key([fk], whole[space])
                found.append(entry(space, key, ref, has(key)))
        found += [entry(rule_no[t.name, r], nothing, -1, ~F.coalesce(c, F.lit(True))) for r, c in t.rules.items()]
        parts.append(t.df.select(F.inline(F.filter(F.array(*found), lambda e: e.isNotNull()))))
    most = max(referrers.values(), default=-1) + 1
    values = reduce(lambda x, y: x.unionByName(y), parts).groupBy("space", "a", "b", "text").agg(
        F.count_if(F.col("ref") == -1).alias("own"), *(F.count_if(F.col("ref") == i).alias(f"ref{i}") for i in range(most)))
    keyed = F.col("a").isNotNull() | F.col("text").isNotNull()
    per_space = values.groupBy("space").agg(
        F.sum("own").alias("rows"), F.sum(F.when(keyed & (F.col("own") > 1), F.col("own")).otherwise(0)).alias("twice"),
        F.array(*(F.sum(F.when(F.col("own") == 0, F.col(f"ref{i}")).otherwise(0)) for i in range(most)), F.lit(0).cast("long")).alias("lost"))
    # one entry for each declared key and rule
    found = per_space.agg(F.map_from_entries(F.collect_list(F.struct("space", F.struct("rows", "twice", "lost")))).alias("found"))

    def line(t, rule, value):
        return F.struct(F.lit(rule).alias("rule"), F.lit(t.name).alias("table"), F.coalesce(F.col("found")[first[t.name]]["rows"], F.lit(0).cast("long")).alias("checked"),
                        F.coalesce(value, F.lit(0).cast("long")).alias("violations"))

    lines, ref_at = [], {(n, fk, i): (space, ref) for i, (n, fk, space, ref) in enumerate(refs)}
    numbers = iter(range(len(refs)))
    for t in tables:
        lines += [line(t, r, F.col("found")[rule_no[t.name, r]]["rows"]) for r in t.rules]
        lines += [line(t, f"unique({', '.join(u)})", F.col("found")[spaces[t.name, tuple(u)]]["twice"]) for u in t.unique]
        for fk, _, _ in t.foreign:
            space, ref = ref_at[t.name, fk, next(numbers)]
            lines.append(line(t, f"foreign_key({fk})", F.col("found")[space]["lost"][ref]))
    return found.select(F.inline(F.array(*lines))).select(*RESULT_COLUMNS)


def check_table(df: DataFrame, table: str, rules: dict[str, Column], unique: Sequence[Sequence[str]] = (),
                foreign: Sequence[tuple[str, DataFrame, str]] = ()) -> DataFrame:
    """All rules of one table; references are (column, parent, parent's key)."""
    parents = [Declared(f"parent {i}", parent.select(pk), unique=[[pk]]) for i, (_, parent, pk) in enumerate(foreign)]
    own = Declared(table, df, rules, unique, [(fk, p.name, pk) for (fk, _, pk), p in zip(foreign, parents)])
    return check_tables([own, *parents]).where(F.col("table") == table)


def length_rules(limits: dict[str, int]) -> dict[str, Column]:
    """K5: VARCHAR(n)."""
    return {f"length({c}) <= {n}": F.char_length(c) <= n for c, n in limits.items()}


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """K3 detail: the orphan rows (a NULL key is allowed, never an orphan)."""
    return child.where(F.col(fk).isNotNull()).join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def violating_rows(df: DataFrame, rule: Column) -> DataFrame:
    """Rows failing a row rule (NULL outcome passes)."""
    return df.where(~F.coalesce(rule, F.lit(True)))


def union_results(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack rule results into one (rule, table, checked, violations) table."""
    return reduce(lambda a, b: a.unionByName(b), parts).select(*RESULT_COLUMNS)
