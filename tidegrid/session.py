"""Session settings, the shared staging folder, and size-checked broadcasting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when it is known to stay at or under this many rows.
BROADCAST_ROW_LIMIT = 200_000

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Side tables come from files; up to this size the planner broadcasts them, above it shuffles.
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    # Lets a join reuse a partitioning on part of its keys (grid joins, then slot windows).
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # A rerun of one month replaces that month only.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

_local_staging: dict[str, str] = {}


def build_session(app_name: str = "tidegrid", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else made."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def staging_root(spark: SparkSession) -> str:
    """Shared folder for tables that cut lineage: ``spark.checkpoint.dir`` of the session.

    Only a local session may go without the setting; it then gets a scratch folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_staging:
        _local_staging[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_staging[app]


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: later actions do not recompute it or lose it."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> bool:
    """True when ``df`` has at most ``limit`` rows; reads no more than that."""
    return df.limit(limit + 1).count() <= limit


def small_side(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast hint behind a row check; beyond the limit the planner shuffles as usual."""
    return F.broadcast(df) if fits_broadcast(df, limit) else df
