"""Intermediate tables in the folder that the cluster shares.

Lineage is cut by writing a table under ``spark.checkpoint.dir`` and reading it again, so a lost executor
costs no more than the tasks it was running.  Where the setting is absent, as in tests, the session's own
warehouse folder takes its place.

Results are read from such tables as long as they are used, so the tables stay: ``scratch`` deletes those of one step
once its result is written elsewhere, ``clear`` all that this program made.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    _made.append(f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def written(df: DataFrame, name: str, *, path: str | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back with its own schema."""
    spark = df.sparkSession
    path = path or new_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def remove(*tables: DataFrame | None) -> None:
    """Delete tables that ``written`` made and nothing reads any more."""
    for df in tables:
        path = getattr(df, "_scratch_path", None)
        if path:
            _delete(df.sparkSession, path)


def clear(spark: SparkSession, since: int = 0) -> None:
    """Delete what this program put into the shared folder; no result of it can be read any more."""
    for path in _made[since:]:
        _delete(spark, path)
    del _made[since:]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end all that was put into the shared folder inside; for one thread."""
    since = len(_made)
    try:
        yield
    finally:
        clear(spark, since)
