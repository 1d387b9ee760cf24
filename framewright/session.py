"""Session settings the library expects, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}

_local_scratch: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it then gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="framewright-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/framewright/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back, which cuts the lineage.

    A written table survives the loss of executors, keeps column pruning and gives
    the optimizer a real size for its choice of join.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
