"""Readers, writers and catalog tables. Schemas are explicit: inference would turn codes into numbers and amounts into doubles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscreen.schema import CLAIM_SCHEMA, COORDINATES

COORDINATE_SCHEMA = T.StructType([*CLAIM_SCHEMA.fields, *[T.StructField(c, T.DoubleType()) for c in COORDINATES]])


def read_claims(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = CLAIM_SCHEMA) -> DataFrame:
    if fmt == "csv":
        # Columns are taken by the header's names, so files may omit optional ones or order them otherwise.
        header = spark.read.option("header", True).csv(path).columns
        known = {f.name: f.dataType for f in schema.fields}
        return spark.read.schema(T.StructType([T.StructField(c, known.get(c, T.StringType())) for c in header])).option("header", True).csv(path)
    if fmt == "json":
        return spark.read.schema(schema).json(path)
    if fmt == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unknown format: {fmt}")


#: Scored claims as flat text holds them.
SCORED_CSV = "claim_id string, patient_id string, provider_id string, charge_amount decimal(10,2), fraud_score double, fraud_reasons string, rule_violations string, statistical_flags string, is_duplicate boolean, duplicate_of string, processed_at timestamp"


def read_results(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scored claims as write_results writes them."""
    return spark.read.schema(SCORED_CSV).option("header", True).csv(path) if fmt == "csv" else spark.read.format(fmt).load(path)


def flatten_arrays(df: DataFrame) -> DataFrame:
    """Arrays as comma-separated text, for formats without nesting."""
    return df.select([F.concat_ws(", ", c).alias(c) if kind.startswith("array<string") else F.col(c) for c, kind in df.dtypes])


def write_results(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    if fmt == "csv":
        flatten_arrays(df).write.mode("overwrite").option("header", True).csv(path)
    elif fmt in ("json", "parquet"):
        df.write.mode("overwrite").format(fmt).save(path)
    else:
        raise ValueError(f"unknown format: {fmt}")


def write_partitioned(df: DataFrame, path: str) -> None:
    """Parquet by detection_date. Only the dates being written are replaced; earlier days stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("detection_date").parquet(path)


def create_tables(spark: SparkSession, database: str, claims_path: str, flagged_path: str) -> None:
    """The two external tables over existing folders."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CLAIM_SCHEMA.fields)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.claims ({fields}, year int, month int) USING parquet PARTITIONED BY (year, month) LOCATION '{claims_path}'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.flagged_claims (claim_id string, patient_id string, provider_id string, charge_amount decimal(10,2), fraud_score double, "
        "fraud_reasons array<string>, rule_violations array<string>, statistical_flags array<string>, is_duplicate boolean, duplicate_of string, processed_at timestamp, detection_date date) "
        f"USING parquet PARTITIONED BY (detection_date) LOCATION '{flagged_path}'"
    )
    for table in ("claims", "flagged_claims"):
        discover_partitions(spark, f"{database}.{table}")


def discover_partitions(spark: SparkSession, table: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {table}")


def drop_partition(spark: SparkSession, table: str, detection_date: str) -> None:
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (detection_date='{detection_date}')")
