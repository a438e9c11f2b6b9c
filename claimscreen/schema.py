"""The canonical claim schema, optional columns and input checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REQUIRED = ("claim_id", "patient_id", "provider_id", "procedure_code", "service_date", "charge_amount")
COORDINATES = ("patient_lat", "patient_lon", "provider_lat", "provider_lon")

CLAIM_SCHEMA = T.StructType(
    [
        T.StructField("claim_id", T.StringType()),
        T.StructField("patient_id", T.StringType()),
        T.StructField("provider_id", T.StringType()),
        T.StructField("provider_name", T.StringType()),
        T.StructField("procedure_code", T.StringType()),
        T.StructField("diagnosis_code", T.StringType()),
        T.StructField("service_date", T.DateType()),
        T.StructField("submitted_date", T.DateType()),
        T.StructField("charge_amount", T.DecimalType(10, 2)),
        T.StructField("paid_amount", T.DecimalType(10, 2)),
        T.StructField("patient_state", T.StringType()),
        T.StructField("provider_state", T.StringType()),
        T.StructField("place_of_service", T.StringType()),
    ]
)


def has_columns(df: DataFrame, names: Iterable[str]) -> bool:
    return set(names) <= set(df.columns)


def require_columns(df: DataFrame, names: Iterable[str] = REQUIRED) -> DataFrame:
    """Raise ValueError at plan time when a needed column is missing."""
    if missing := [c for c in names if c not in df.columns]:
        raise ValueError(f"missing claim columns: {', '.join(missing)}")
    return df


def duplicate_ids(df: DataFrame) -> DataFrame:
    """Claim ids that occur more than once; the near-duplicate search assumes there are none."""
    return df.groupBy("claim_id").agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def quality_report(df: DataFrame) -> DataFrame:
    """Extension: one row with input counts a run can be gated on."""
    return require_columns(df).agg(
        F.count("*").alias("n_claims"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in REQUIRED],
        F.count_if(F.col("charge_amount") < 0).alias("negative_charges"),
        F.count_if(F.col("charge_amount") == 0).alias("zero_charges"),
    )
