"""spark-submit entry: score a folder of claims into Parquet by detection date."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from claimscreen.plans.screening import ClaimScreen
from claimscreen.sources.io import read_claims, write_partitioned

log = logging.getLogger("claimscreen.job")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = argparse.ArgumentParser()
    args.add_argument("--input", required=True)
    args.add_argument("--output", required=True)
    args.add_argument("--format", choices=("csv", "parquet", "json"), default="csv")
    args = args.parse_args(argv)
    own = spark is None
    try:
        spark = spark or SparkSession.builder.appName("claimscreen-job").getOrCreate()
        scored = ClaimScreen().detect(read_claims(spark, args.input, args.format))
        today = F.lit(spark.range(1).select(F.current_date()).first()[0])  # one date, also for a run over midnight
        write_partitioned(scored.withColumn("detection_date", today), args.output)
        written = spark.read.parquet(args.output).filter(F.col("detection_date") == today)
        counts = written.agg(F.count("*").alias("all"), F.count_if(F.col("is_duplicate")).alias("copies"), F.count_if(F.col("fraud_score") > 0.7).alias("high")).first()
        log.info("scored %d claims, %d high risk, %d duplicates", counts["all"], counts["high"], counts["copies"])
        return 0
    except Exception:
        log.exception("job failed")
        return 1
    finally:
        if own and spark:
            spark.stop()


if __name__ == "__main__":
    sys.exit(main())
