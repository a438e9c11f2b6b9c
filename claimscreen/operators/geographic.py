"""Location rules: distance, state mismatch, clustering, several places in a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimscreen.config import ScreenConfig
from claimscreen.functions.scalar import flag, haversine_miles
from claimscreen.operators.grouped import with_group_stats
from claimscreen.schema import COORDINATES, has_columns


def distance(claims: DataFrame, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """Miles between patient and provider. Without the four coordinates only a FALSE flag is added."""
    if not has_columns(claims, COORDINATES):
        return claims.withColumn("distance_exceeded", F.lit(False))
    out = claims.withColumn("distance_miles", haversine_miles(*map(F.col, COORDINATES)))
    return out.withColumn("distance_exceeded", flag(F.col("distance_miles") > cfg.max_provider_patient_distance_miles))


def state_mismatch(claims: DataFrame) -> DataFrame:
    """Both states known and different."""
    if not has_columns(claims, ("patient_state", "provider_state")):
        return claims.withColumn("state_mismatch", F.lit(False))
    return claims.withColumn("state_mismatch", flag(F.col("patient_state") != F.col("provider_state")))


def clustering(claims: DataFrame, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """Providers with many claims, all from patients of one state that is not their own."""
    stats = {"unique_patient_states": F.size(F.collect_set("patient_state")), "total_patients": F.count("patient_id")}
    hit = (F.col("total_patients") > cfg.clustering_min_claims) & (F.col("unique_patient_states") == 1) & (F.col("patient_state") != F.col("provider_state"))
    return with_group_stats(claims, ["provider_id"], stats).withColumn("geographic_clustering_flag", flag(hit))


def impossible_travel(claims: DataFrame, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """Patients with more provider visits in a day than the limit; every claim counts, also at one place."""
    if not has_columns(claims, COORDINATES):
        return claims.withColumn("impossible_travel_flag", F.lit(False))
    place = F.struct(F.col("provider_lat").alias("lat"), F.col("provider_lon").alias("lon"))
    out = claims.withColumn("provider_locations", F.collect_list(place).over(Window.partitionBy("patient_id", "service_date")))
    out = out.withColumn("num_providers_same_day", F.size("provider_locations"))
    return out.withColumn("impossible_travel_flag", flag(F.col("num_providers_same_day") > cfg.same_day_locations))
