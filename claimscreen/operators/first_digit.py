"""First-digit distribution of amounts against its expected frequencies."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscreen.functions.scalar import flag, leading_digit
from claimscreen.operators.grouped import with_group_stats

#: Expected share of the leading digits 1 to 9, rounded to three places.
EXPECTED = {1: 0.301, 2: 0.176, 3: 0.125, 4: 0.097, 5: 0.079, 6: 0.067, 7: 0.058, 8: 0.051, 9: 0.046}


def expected_share(digit: Column) -> Column:
    """A map literal: the nine rows never become a join side."""
    return F.create_map(*[F.lit(x) for x in chain(*EXPECTED.items())])[digit]


def over_represented(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """One row with the array of digits that exceed their expected share by more than the threshold."""
    # Amounts without a digit are left out at the end: a filter before would be copied to where amounts are computed.
    counts = df.select(leading_digit(F.col(column)).alias("d")).groupBy("d").agg(F.count("*").alias("n"))
    total = F.aggregate("__all", F.lit(0).cast("bigint"), lambda acc, x: acc + x["n"])
    listed = counts.agg(F.collect_list(F.when(F.col("d").isNotNull(), F.struct("d", "n"))).alias("__all"))
    over = F.filter("__all", lambda x: x["n"] / total - expected_share(x["d"]) > threshold)
    return listed.select(F.transform(over, lambda x: x["d"]).alias("digits"))


def analyze(df: DataFrame, column: str = "charge_amount", group_by: str | None = None, threshold: float = 0.15) -> DataFrame:
    """benfords_anomaly: globally, rows with an over-represented digit; by group, all rows of a group whose
    largest absolute deviation over the digits that occur exceeds the threshold."""
    digit = leading_digit(F.col(column))
    if group_by is None:
        digits = over_represented(df, column, threshold).scalar()
        return df.withColumn("benfords_anomaly", flag(F.array_contains(digits, digit)))
    stats = {f"__n{d}": F.count_if(digit == d) for d in EXPECTED}
    out = with_group_stats(df, [group_by], stats)
    total = sum((F.col(n) for n in list(stats)[1:]), F.col("__n1"))
    gaps = [F.when(F.col(n) > 0, F.abs(F.col(n) / total - EXPECTED[d])) for d, n in enumerate(stats, 1)]
    return out.select(*df.columns, flag(F.greatest(*gaps) > threshold).alias("benfords_anomaly"))


def distribution_report(df: DataFrame, column: str = "charge_amount", group_by: str | None = None) -> DataFrame:
    """Observed and expected share of each digit that occurs; later figures use the rounded earlier ones."""
    keys = [group_by] if group_by else []
    rows = df.select(*keys, leading_digit(F.col(column)).alias("first_digit")).filter("first_digit is not null")
    counts = rows.groupBy(*keys, "first_digit").agg(F.count("*").alias("count"))
    totals = with_group_stats(counts, keys, {"total": F.sum("count")})
    out = totals.withColumn("observed_frequency", F.round(F.col("count") / F.col("total"), 4))
    out = out.withColumn("expected_frequency", expected_share(F.col("first_digit")))
    out = out.withColumn("deviation", F.round(F.col("observed_frequency") - F.col("expected_frequency"), 4))
    out = out.withColumn("deviation_percentage", F.round(F.col("deviation") / F.col("expected_frequency") * 100, 2))
    order = ["first_digit", *keys, "count", "total", "observed_frequency", "expected_frequency", "deviation", "deviation_percentage"]
    return out.select(*order).orderBy(*keys, "first_digit")
