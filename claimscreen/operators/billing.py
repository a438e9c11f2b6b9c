"""Billing rules: volume per day, weekend and round-amount habits, component billing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimscreen.config import ScreenConfig
from claimscreen.functions.scalar import flag
from claimscreen.operators.grouped import with_group_stats


def daily_procedure_limit(claims: DataFrame, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """Rows per provider and date, flagged when over the limit."""
    per_day = F.count("*").over(Window.partitionBy("provider_id", "service_date"))
    out = claims.withColumn("daily_procedure_count", per_day)
    return out.withColumn("daily_procedure_limit_exceeded", F.col("daily_procedure_count") > cfg.max_daily_procedures_per_provider)


def patient_frequency(claims: DataFrame, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """Rows per patient and date, flagged when over the limit."""
    per_day = F.count("*").over(Window.partitionBy("patient_id", "service_date"))
    out = claims.withColumn("patient_daily_claims", per_day)
    return out.withColumn("patient_frequency_exceeded", F.col("patient_daily_claims") > cfg.max_claims_per_patient_per_day)


def is_weekend() -> Column:
    return F.dayofweek("service_date").isin(1, 7)


def is_round(unit: int) -> Column:
    return (F.col("charge_amount") % unit == 0) & (F.col("charge_amount") > 0)


def habitual(claims: DataFrame, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """provider_id, service_date, weekend_habit, round_habit: the days of claims(__at, ...), dealt by __at, that hold
    a weekend or round-amount claim of a provider over the limit for such."""
    days = claims.filter(is_weekend() | is_round(100)).select("__at", "provider_id", "service_date").distinct().drop("__at")
    stats = claims.groupBy(F.col("provider_id").alias("__provider")).agg(F.avg(is_weekend().cast("double")).alias("w"), F.avg(is_round(100).cast("double")).alias("r"))
    habits = stats.select("__provider", flag(F.col("w") > cfg.weekend_ratio).alias("weekend_habit"), flag(F.col("r") > cfg.round_ratio).alias("round_habit"))
    return days.join(habits.filter("weekend_habit or round_habit"), F.col("provider_id").eqNullSafe(F.col("__provider"))).drop("__provider")


def provider_habits(claims: DataFrame, cfg: ScreenConfig = ScreenConfig(), *, weekend: bool = True, rounding: bool = True) -> DataFrame:
    """Weekend and round-amount flags from one aggregation per provider.

    A row without a date or charge counts in neither ratio's numerator nor its
    denominator, and is not flagged.
    """
    row_cols, stats, flags = {}, {}, {}
    if weekend:
        row_cols |= {"day_of_week": F.dayofweek("service_date"), "is_weekend": is_weekend()}
        stats["provider_weekend_ratio"] = F.avg(F.col("is_weekend").cast("double"))
        flags["weekend_billing_flag"] = flag(F.col("is_weekend") & (F.col("provider_weekend_ratio") > cfg.weekend_ratio))
    if rounding:
        row_cols |= {f"is_round_{name}": is_round(unit) for name, unit in (("hundred", 100), ("fifty", 50))}
        stats["provider_round_ratio"] = F.avg(F.col("is_round_hundred").cast("double"))
        flags["round_amount_flag"] = flag(F.col("is_round_hundred") & (F.col("provider_round_ratio") > cfg.round_ratio))
    return with_group_stats(claims.withColumns(row_cols), ["provider_id"], stats).withColumns(flags)


def weekend_billing(claims: DataFrame, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    return provider_habits(claims, cfg, rounding=False)


def round_amounts(claims: DataFrame, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    return provider_habits(claims, cfg, weekend=False)


def unbundling(claims: DataFrame, bundles: DataFrame, *, fan_out: bool = True) -> DataFrame:
    """Days on which a provider billed both components of a bundle for one patient.

    Hash joins throughout: distinct codes of a (patient, date, provider) group
    meet the bundle table on its first component, then the group's code set on
    the second. With fan_out a claim is repeated for each matching bundle;
    without it there is one row a claim and only the flag is added.
    """
    group = ["patient_id", "service_date", "provider_id"]
    codes = claims.groupBy(*group).agg(F.sort_array(F.collect_set("procedure_code")).alias("procedures_same_day"))
    first = codes.select("*", F.explode("procedures_same_day").alias("unbundled_code_1"))
    found = (
        first.join(bundles.select("bundled_code", "unbundled_code_1", "unbundled_code_2"), "unbundled_code_1")
        .filter(F.array_contains("procedures_same_day", F.col("unbundled_code_2")))
        .groupBy(*[F.col(k).alias(f"__{k}") for k in group])
        .agg(F.collect_list(F.struct("bundled_code", "unbundled_code_1", "unbundled_code_2")).alias("__found"))
    )
    codes = codes.select(*[F.col(k).alias(f"__{k}") for k in group], "procedures_same_day")
    sides = codes.join(found, [codes[f"__{k}"].eqNullSafe(found[f"__{k}"]) for k in group], "left").select(*[codes[c] for c in codes.columns], "__found")
    out = claims.join(sides, [claims[k].eqNullSafe(sides[f"__{k}"]) for k in group], "left")
    keep = [claims[c] for c in claims.columns]
    if not fan_out:
        return out.select(*keep, "procedures_same_day", F.col("__found").isNotNull().alias("unbundling_flag"))
    out = out.select(*keep, "procedures_same_day", F.explode_outer("__found").alias("__hit"))
    return out.select(*claims.columns, "procedures_same_day", "__hit.*", F.col("__hit").isNotNull().alias("unbundling_flag"))
