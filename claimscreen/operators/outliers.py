"""Statistical outliers: z-score, interquartile range, peers, spikes in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimscreen.config import ScreenConfig
from claimscreen.functions.scalar import flag
from claimscreen.operators.grouped import with_group_stats


def zscore_stats(column: str) -> dict[str, Column]:
    x = F.col(column).cast("double")
    return {"__mean": F.avg(x), "__stddev": F.stddev(x)}


def zscore_flag(column: str, threshold: float) -> Column:
    z = (F.col(column).cast("double") - F.col("__mean")) / F.col("__stddev")
    return flag(F.abs(F.when(F.col("__stddev") > 0, z).otherwise(0.0)) > threshold)


def iqr_stats(column: str, accuracy: int) -> dict[str, Column]:
    x = F.col(column).cast("double")
    return {"__q1": F.percentile_approx(x, 0.25, accuracy), "__q3": F.percentile_approx(x, 0.75, accuracy)}


def iqr_flag(column: str, k: float) -> Column:
    x, reach = F.col(column).cast("double"), k * (F.col("__q3") - F.col("__q1"))
    return flag((x < F.col("__q1") - reach) | (x > F.col("__q3") + reach))


def zscore_outliers(df: DataFrame, column: str, output: str, group_by: list[str] | None = None, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """|z| over the threshold, with the sample deviation of the group or table; groups of one row have none."""
    out = with_group_stats(df, group_by or [], zscore_stats(column))
    return out.select(*df.columns, zscore_flag(column, cfg.outlier_zscore_threshold).alias(output))


def iqr_outliers(df: DataFrame, column: str, output: str, group_by: list[str] | None = None, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """Strictly outside [Q1 - k IQR, Q3 + k IQR] of the group or table."""
    out = with_group_stats(df, group_by or [], iqr_stats(column, cfg.quantile_accuracy))
    return out.select(*df.columns, iqr_flag(column, cfg.outlier_iqr_multiplier).alias(output))


def procedure_outliers(df: DataFrame, charge: str = "charge_amount", procedure: str = "procedure_code", cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    return zscore_outliers(df, charge, "procedure_charge_outlier", [procedure], cfg)


def provider_outliers(df: DataFrame, charge: str = "charge_amount", provider: str = "provider_id", procedure: str = "procedure_code", cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """A provider's average for a procedure against the market's, which includes the provider.

    The market is summed up from the provider sums, so the table is aggregated once.
    """
    x = F.col(charge)
    own = df.groupBy(F.col(provider).alias("__provider"), F.col(procedure).alias("__procedure")).agg(F.sum(x).alias("__sum"), F.count(x).alias("__n"))
    market = own.groupBy(F.col("__procedure").alias("__market")).agg(F.sum("__sum").alias("__all"), F.sum("__n").alias("__m"))
    # Decimals are summed exactly, in any order, and each result is one division of such sums.
    average = F.try_divide(F.col("__sum").cast("double"), F.col("__n"))
    ratio = F.try_divide((F.col("__sum") * F.col("__m")).cast("double"), (F.col("__all") * F.col("__n")).cast("double"))
    own = own.join(market, F.col("__procedure") == F.col("__market")).withColumn("provider_avg_charge", average)
    own = own.withColumn("charge_deviation_ratio", F.when(F.col("__all") > 0, ratio).otherwise(1.0))
    out = df.join(own, (df[provider] == own["__provider"]) & (df[procedure] == own["__procedure"]), "left")
    ratio = F.col("charge_deviation_ratio")
    hit = flag((ratio > cfg.provider_ratio_high) | (ratio < cfg.provider_ratio_low))
    return out.select(*[df[c] for c in df.columns], "provider_avg_charge", "charge_deviation_ratio", hit.alias("provider_billing_outlier"))


def temporal_spikes(df: DataFrame, charge: str = "charge_amount", date: str = "service_date", cfg: ScreenConfig = ScreenConfig(), *, by_date: bool = False) -> DataFrame:
    """Charge over a multiple of the mean of the provider's preceding rows.

    Rows follow (calendar year, ISO week), so the last days of December can sort
    to January; date and claim id break ties. by_date orders by date instead.
    """
    order = [date, "claim_id"] if by_date else [F.year(date), F.weekofyear(date), date, "claim_id"]
    frame = Window.partitionBy("provider_id").orderBy(*order).rowsBetween(-cfg.spike_history_rows, -1)
    before = F.avg(F.col(charge).cast("double")).over(frame)
    spike = F.when(before > 0, F.col(charge).cast("double") > cfg.spike_factor * before)
    return df.withColumn("temporal_spike_flag", flag(spike))
