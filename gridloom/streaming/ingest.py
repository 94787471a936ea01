"""Incremental ingest: manifests that arrive in a folder, each applied once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gridloom.spec import MANIFEST


def ingest_manifests(spark: SparkSession, folder: str, state: str, apply: Callable[[DataFrame, int], None], per_batch: int = 16) -> StreamingQuery:
    """Read the manifest files that are new in ``folder`` and hand each micro-batch to
    ``apply(rows, batch)``. All that is there is taken, then the query ends; ``state`` holds the
    checkpoint, so a later call takes up only what came since. ``apply`` may be called again
    for a batch after a failure: commit by batch number, as the store's ledgers allow."""
    rows = spark.readStream.schema(MANIFEST).option("maxFilesPerTrigger", per_batch).parquet(folder)
    return rows.writeStream.foreachBatch(apply).option("checkpointLocation", state).trigger(availableNow=True).start()
