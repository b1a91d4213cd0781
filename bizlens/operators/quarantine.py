"""K1-K6: the rows that break declared rules, with the rules they break.

One pass over a table marks each row with a bit for every rule that it breaks: NOT NULL, CHECK, format, length and generated
column directly, keys and references through one expansion.  Each row is expanded to an entry for
each of its keys (key number, key values), the parents' keys join the same
grouping, and one shuffle by (key number, values) says for all keys at once how often a
value occurs and whether its parent exists.  Only keys with a broken rule come back to the rows, so a table without
faults costs one grouping and no join of its rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.scratch import materialize


def _key_text(cols: Sequence[str], table_prefix: str = "") -> Column:
    """Values of a key as one text, NULL if any is: each with its length, so that no two keys fall together."""
    parts = [F.col(f"{table_prefix}`{c}`").cast("string") for c in cols]
    return F.concat(*(x for p in parts for x in (F.char_length(p).cast("string"), F.lit(":"), p)))


def broken_rules(df: DataFrame, rules: dict[str, Column], unique: Sequence[Sequence[str]] = (),
                 foreign: Sequence[tuple[str, DataFrame, str]] = ()) -> DataFrame:
    """``df`` with ``broken``, the sorted names of the rules that a row breaks (none: an empty array).

    ``rules`` are passing conditions (a NULL outcome passes).  A row breaks a unique rule if another row has the same
    key, a foreign one if its key isn't NULL and no parent has it; keys with a NULL are exempt, as in SQL.
    """
    names = list(rules) + [f"unique({', '.join(u)})" for u in unique] + [f"foreign_key({fk})" for fk, _, _ in foreign]
    own = F.filter(F.array(*(F.when(~F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in rules.items())) if rules else F.array().cast("array<string>"), lambda x: x.isNotNull())
    marked = df.withColumn("_own", own)
    numbered = [(len(rules) + i, list(u)) for i, u in enumerate(unique)] + [(len(rules) + len(unique) + i, [fk]) for i, (fk, _, _) in enumerate(foreign)]
    if not numbered:
        return marked.withColumn("broken", F.array_sort("_own")).drop("_own")
    keys = F.filter(F.array(*(F.struct(F.lit(no).alias("no"), _key_text(cols).alias("key")) for no, cols in numbered)), lambda k: k["key"].isNotNull())
    entries = df.select(F.explode(keys).alias("k")).groupBy("k.no", "k.key").agg(F.count(F.lit(1)).alias("n")).select("no", "key", "n", F.lit(0).alias("parents"))
    for i, (_, parent, pk) in enumerate(foreign):
        p = parent.select(F.lit(len(rules) + len(unique) + i).alias("no"), _key_text([pk]).alias("key"), F.lit(0).cast("long").alias("n"), F.lit(1).alias("parents"))
        entries = entries.unionByName(p)
    found = entries.groupBy("no", "key").agg(F.sum("n").alias("n"), F.max("parents").alias("parents"))
    last_unique = len(rules) + len(unique)
    bad = found.where(((F.col("no") < last_unique) & (F.col("n") > 1)) | ((F.col("no") >= last_unique) & (F.col("n") > 0) & (F.col("parents") == 0)))
    bad = bad.select(F.col("no").alias("_no"), F.col("key").alias("_key"))
    # the rows meet broken keys only; a row that breaks several keys is put together again by its number
    rows = materialize(marked.withColumn("_row", F.monotonically_increasing_id()).withColumn("_keys", keys), "marked")  # a row keeps its number
    hits = rows.select("_row", F.explode("_keys").alias("k")).join(bad, (F.col("k.no") == F.col("_no")) & (F.col("k.key") == F.col("_key")))
    per_row = hits.groupBy("_row").agg(F.collect_set(F.get(F.array(*map(F.lit, names)), F.col("_no"))).alias("_hits"))
    return rows.join(per_row, "_row", "left").withColumn("broken", F.array_sort(F.concat("_own", F.coalesce("_hits", F.array().cast("array<string>"))))).drop("_own", "_row", "_keys", "_hits")


def quarantine(df: DataFrame, rules: dict[str, Column], unique: Sequence[Sequence[str]] = (), foreign: Sequence[tuple[str, DataFrame, str]] = (),
               observe: str | None = None) -> tuple[DataFrame, DataFrame, Observation | None]:
    """(clean rows, rows that break a rule with ``broken``, metrics).

    With ``observe`` the first action on the marked rows also fills an ``Observation`` with the numbers of rows
    checked and broken, without a pass of its own.
    """
    marked = broken_rules(df, rules, unique, foreign)
    metrics = Observation(observe) if observe else None
    if metrics:
        marked = marked.observe(metrics, F.count(F.lit(1)).alias("checked"), F.count_if(F.size("broken") > 0).alias("broken_rows"))
    return marked.where(F.size("broken") == 0).drop("broken"), marked.where(F.size("broken") > 0), metrics
