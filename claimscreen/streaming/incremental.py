"""Extension: screen files as they arrive. Row windows need whole batches, so each micro-batch is a batch run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimscreen.plans.screening import ClaimScreen
from claimscreen.schema import CLAIM_SCHEMA
from claimscreen.sources.io import write_partitioned


def screen_new_files(spark: SparkSession, folder: str, output: str, checkpoint: str, screen: ClaimScreen | None = None, max_files: int = 1) -> StreamingQuery:
    """Screens every file not yet seen, max_files a batch, then stops. Statistics are those of the batch.

    Batches get folders of their own, so a replayed batch replaces its own output and nothing else.
    """
    screen = screen or ClaimScreen()

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        scored = screen.detect(batch).withColumn("detection_date", F.current_date())
        write_partitioned(scored, f"{output}/batch={batch_id}")

    files = spark.readStream.schema(CLAIM_SCHEMA).option("header", True).option("maxFilesPerTrigger", max_files).csv(folder)
    return files.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
