"""Synthetic claims: distributed and reproducible from a seed."""

from __future__ import annotations

import random
import string
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscreen.schema import CLAIM_SCHEMA

#: Procedure codes with the lowest and highest usual charge.
PROCEDURES = {
    "99213": (75, 150), "99214": (100, 200), "99215": (150, 300), "99203": (100, 200),
    "99204": (150, 300), "90834": (100, 175), "90837": (150, 250), "97110": (50, 100),
    "97140": (50, 100), "36415": (15, 30), "80053": (50, 100), "85025": (25, 50),
    "71046": (100, 250), "73030": (75, 200), "99283": (200, 400), "99284": (300, 600),
}
#: Diagnosis codes, states, places of service, round amounts.
DIAGNOSES = ["J06.9", "M54.5", "E11.9", "I10", "F32.9", "J45.909", "M25.561", "R51.9", "K21.0", "N39.0"]
STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA",
    "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
]
PLACES = ["11", "21", "22", "23", "31", "81"]
ROUND_AMOUNTS = [100, 200, 500, 1000, 1500, 2000]


def generate_id(prefix: str, /, *, length: int = 10, rng: random.Random | None = None) -> str:
    """prefix and random capitals and digits."""
    return prefix + "".join((rng or random).choices(string.ascii_uppercase + string.digits, k=length))


def pick(values: list, rand: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), F.floor(rand * len(values)).cast("int"))


def generate_claims(spark: SparkSession, num_claims: int = 10_000, fraud_rate: float = 0.05, num_providers: int = 100, num_patients: int = 1_000, *, seed: int = 42, base_date: date = date(2024, 12, 31), partitions: int | None = None) -> DataFrame:
    """num_claims rows and copies under new ids of a fifth of the anomalous ones. Every draw hashes seed, row and purpose, so partitioning does not matter."""

    def draw(purpose: str, row: str = "n") -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), F.lit(purpose), F.col(row)), F.lit(1 << 52)) / float(1 << 52)

    rows = spark.range(0, num_claims, 1, partitions).select(F.col("id").alias("n"))
    rows = rows.withColumns({"odd": draw("odd") < fraud_rate, "kind": F.floor(draw("kind") * 4), "provider": F.floor(draw("provider") * num_providers), "patient": F.floor(draw("patient") * num_patients), "item": F.floor(draw("item") * len(PROCEDURES)).cast("int")})
    low, high = (F.get(F.array(*[F.lit(float(v[i])) for v in PROCEDURES.values()]), F.col("item")) for i in (0, 1))
    usual = low + draw("charge") * (high - low)
    inflated, round_one, wrong_state = (F.col("odd") & (F.col("kind") == k) for k in (0, 1, 3))
    charge = F.when(inflated, high * (2 + 3 * draw("factor"))).when(round_one, pick([float(a) for a in ROUND_AMOUNTS], draw("round"))).otherwise(usual)
    home = F.floor(draw("home", "provider") * len(STATES)).cast("int")
    other = F.pmod(home + 1 + F.floor(draw("other") * (len(STATES) - 1)).cast("int"), F.lit(len(STATES)))
    anywhere = F.floor(draw("any") * len(STATES)).cast("int")
    states = F.array(*map(F.lit, STATES))
    service = F.date_sub(F.lit(base_date), F.floor(draw("day") * 366).cast("int"))
    claims = rows.select(
        "n", "odd",
        F.format_string("PAT%08d", F.col("patient")).alias("patient_id"),
        F.format_string("PRV%08d", F.col("provider")).alias("provider_id"),
        F.format_string("Provider %04d", F.col("provider") % 10_000).alias("provider_name"),
        F.get(F.array(*map(F.lit, PROCEDURES)), F.col("item")).alias("procedure_code"),
        pick(DIAGNOSES, draw("diagnosis")).alias("diagnosis_code"),
        service.alias("service_date"),
        F.date_add(service, (1 + F.floor(draw("lag") * 30)).cast("int")).alias("submitted_date"),
        F.round(charge, 2).cast("decimal(10,2)").alias("charge_amount"),
        F.round(charge * (0.6 + 0.3 * draw("paid")), 2).cast("decimal(10,2)").alias("paid_amount"),
        F.get(states, F.when(wrong_state, other).when(draw("moved") < 0.1, anywhere).otherwise(home)).alias("patient_state"),
        F.get(states, home).alias("provider_state"),
        pick(PLACES, draw("place")).alias("place_of_service"),
        F.explode(F.when(F.col("odd") & (draw("copy") < 0.2), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    claim_id = F.format_string("CLM%012d", F.col("n") + F.col("copy") * num_claims)
    return claims.withColumn("claim_id", claim_id).select([F.col(f.name).cast(f.dataType) for f in CLAIM_SCHEMA.fields])


def generate_claim(spark: SparkSession, *, is_fraudulent: bool = False, seed: int = 42) -> dict:
    """One claim as a dictionary."""
    return generate_claims(spark, 1, float(is_fraudulent), seed=seed).orderBy("claim_id").first().asDict()


def write_sample(spark: SparkSession, path: str, **options) -> None:
    """A single CSV file; for samples, not for volume."""
    generate_claims(spark, **options).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
