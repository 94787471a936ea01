"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names. Where the session names none, a local session gets
    an own folder; on a cluster no local folder is shared, so that is refused."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        folder = f"{tempfile.gettempdir()}/checkpoints/gridloom"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")
