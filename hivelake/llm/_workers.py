"""What the operators ask of a session: that workers can import this package, and Arrow batches of bounded size."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

#: Rows of an Arrow batch, at most: whole texts make large rows, and a batch exists several times on its way.
BATCH_ROWS = 2000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Paths that lead here on every machine, and smaller batches than the default where that is larger."""
    if not 0 < int(spark.conf.get(_ROWS)) <= BATCH_ROWS:
        spark.conf.set(_ROWS, BATCH_ROWS)
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
