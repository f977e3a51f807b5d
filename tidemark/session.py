"""Session settings and what the running Spark offers."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the operators rely on for right results; all can be set at run time.
REQUIRED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
}

TUNING_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # recording the call site of every column costs more than planning does
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "tidemark",
    *,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create or reuse a session.

    ``shuffle_partitions`` is left to the cluster unless given: adaptive execution merges
    small shuffle partitions, so a large starting number is right for large inputs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**REQUIRED_SETTINGS, **TUNING_SETTINGS, **(extra or {})}.items():
        builder = builder.config(name, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that decide results to a session made elsewhere."""
    for name, value in REQUIRED_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def has_source(spark: SparkSession, name: str) -> bool:
    """Whether a data source (``kafka``, ``avro``, ``jdbc`` ...) is on the class path."""
    try:
        spark.read.format(name).load()
    except Exception as error:  # the message tells a missing source from missing options
        return "DATA_SOURCE_NOT_FOUND" not in str(error) and "Failed to find" not in str(error)
    return True
