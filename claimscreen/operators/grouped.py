"""Attach statistics of a group, or of the whole table, to every row.

Coarse groups (a provider, a procedure) may hold a third of all rows. They are
aggregated with map-side combine and joined back: the small side is broadcast
when its measured size allows, otherwise adaptive execution splits hot keys. A
window would gather a hot group in one task. Table-wide figures come from a
scalar subquery, so no row moves at all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_group_stats(df: DataFrame, keys: list[str], stats: dict[str, Column]) -> DataFrame:
    """df plus one column per entry of stats; NULL keys form a group of their own."""
    if not keys:
        row = df.agg(*[c.alias(n) for n, c in stats.items()]).select(F.struct(*stats).alias("s"))
        out = df.withColumn("__table", row.scalar())
        return out.select(*df.columns, *[F.col(f"__table.{n}").alias(n) for n in stats])
    side = df.groupBy(*[F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)]).agg(*[c.alias(n) for n, c in stats.items()])
    on = reduce(Column.__and__, [df[k].eqNullSafe(side[f"__key{i}"]) for i, k in enumerate(keys)])
    return df.join(side, on, "left").select(*[df[c] for c in df.columns], *[side[n] for n in stats])


def place() -> Column:
    """Names a provider's day. Rows dealt by it alone can be joined by it alone, nulls included, without being shuffled again."""
    return F.xxhash64("provider_id", "service_date")


def shared(rows: DataFrame, needed: list[str]) -> DataFrame:
    """rows, just dealt out, in a shuffle that all readers share.

    Each branch of a plan would prune other columns and so compute and shuffle
    the source for itself. The filter, which every row passes and which cannot be
    moved or simplified, asks for the needed columns in every branch: their
    shuffles are equal and Spark runs one of them.
    """
    return rows.filter(F.hash(*needed) + F.rand(0) > -(2.0**32))


def small_value(rows: DataFrame, longs: list[dict[str, int]], name: str) -> Column:
    """A number of `packed` rows, as bigint."""
    i, one = next((i, one) for i, one in enumerate(longs) if name in one)
    later = list(one)[list(one).index(name) + 1 :]
    small = F.shiftright(rows[f"__small{i}"], sum(one[x] for x in later)).bitwiseAND(F.lit((1 << one[name]) - 1).cast("bigint"))
    return F.when(rows["__wide"].isNull(), small).otherwise(rows["__wide"][name])


def packed(rows: DataFrame, longs: list[dict[str, int]], *keep: str) -> DataFrame:
    """rows with their whole numbers in longs, each number in so many bits, and the columns to keep.

    A row with a number that is missing or needs more bits has all of them as they are, in __wide.
    """
    longs = [{n: b for n, b in one.items() if n in rows.columns} for one in longs], longs
    within = [F.col(n).between(0, (1 << b) - 1) for one in longs[0] for n, b in one.items()]
    fits = F.coalesce(reduce(Column.__and__, within), F.lit(False))
    out = []
    for i, one in enumerate(longs[1]):
        bits = F.lit(0).cast("bigint")
        for n, b in one.items():
            bits = F.shiftleft(bits, b).bitwiseOR(F.col(n).cast("bigint") if n in longs[0][i] else F.lit(0).cast("bigint"))
        out.append(F.when(fits, bits).otherwise(0).alias(f"__small{i}"))
    wide = F.struct(*[F.col(n).cast("bigint").alias(n) for one in longs[0] for n in one])
    return rows.select(*out, F.when(~fits, wide).alias("__wide"), *keep)


def unpacked(rows: DataFrame, longs: list[dict[str, int]], names: list[str], *others: str | Column) -> DataFrame:
    """The named numbers of `packed` rows and other columns."""
    return rows.select(*[small_value(rows, longs, n).alias(n) for one in longs for n in one if n in names], *others)


def at_place(rows: DataFrame) -> DataFrame:
    return rows.withColumn("__at", place())


def where_placed(rows: DataFrame, side: DataFrame, keys: list[str], values: list[str], how: str = "left", also: Column | None = None) -> DataFrame:
    """rows, dealt by __at, joined with a side of few rows (keys, values) by their place and, nulls equal, the keys.

    The keys, provider_id and service_date among them, are compared in a form that
    is no join key to Spark: with further keys it would deal out the rows again.
    The side is dealt by an expression: its place is not carried.
    """
    own = {k: f"__own{i}" for i, k in enumerate(keys)}
    side = side.select(*[F.col(k).alias(o) for k, o in own.items()], *values)
    same = [F.coalesce(F.col(k) == F.col(o), F.col(k).isNull() & F.col(o).isNull()) for k, o in own.items()]
    at = F.col("__at") == F.xxhash64(own["provider_id"], own["service_date"])
    out = rows.join(side, reduce(Column.__and__, [at, *same, *([] if also is None else [also])]), how)
    return out.drop(*own.values())
