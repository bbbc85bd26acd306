"""Session helpers of the training-data operators: scratch tables in the shared folder (the library's own) and Arrow batch sizes."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tracelake.plans.store import scratch, settle, unsettle  # noqa: F401

#: Rows in one Arrow batch; texts are long, so a batch of few rows bounds a Python worker's memory.
BATCH_ROWS = 400


def tune(spark: SparkSession) -> None:
    """Bound the Arrow batches sent to Python workers by rows and, where Spark can, by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    # workers import this package: from where it is installed, or from where the driver has it
    environment = spark.sparkContext.environment
    root, known = str(Path(__file__).resolve().parents[2]), environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def crc_mod(doc_id: str, n: int):
    """crc32 of doc_id as text, modulo n; null ids count as the text 'null'."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).cast("binary")), F.lit(n))
