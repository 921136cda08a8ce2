"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings, safe to change on a session somebody else created.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    # Overflow raises instead of wrapping.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Rows travel to Python workers in Arrow batches of about so many bytes; a larger row travels alone.
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 2 << 20


def narrow_batches(spark: SparkSession) -> SparkSession:
    """Bounds the buffers that every task fills on both sides of its worker, however wide the rows are."""
    if spark.conf.get(BATCH_SETTING, None) != str(BATCH_BYTES):
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; partition counts and memory stay the caller's choice."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", app: str = "mercato", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**RUNTIME, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
