"""Session settings that suit the wide projections of this library."""

from __future__ import annotations

from pyspark.sql import SparkSession

# HotSpot never compiles a method over 8000 bytes of bytecode. Fused stages of wide tables exceed
# that and would run interpreted; below the limit Spark generates smaller methods per operator.
# Sorted rows take many times the bytes they have in a shuffle, so at the default of 64 MB a task of few, full
# partitions takes gigabytes; at this size it takes some hundred MB whatever the input, and small inputs are not affected.
# Where the smaller side of a join comes to at most 16 MB a task, it is hashed and the rows of the other side need no sort.
# Rows that lie in buckets of an invoice meet others of its buckets on the invoice and more columns without an exchange.
# Shuffle files otherwise stay until the driver happens to collect garbage: a build would hold those of all its tables.
RUNTIME_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000", "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16m",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# Set when the session is created. PySpark records the Python call site of every column operation,
# several driver round trips each; composing many wide tables would spend its time on that.
STARTUP_SETTINGS = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, memory: str = "12g", name: str = "regain") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    local = {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": memory,
        # the sample files are small: several splits a core, or else most cores idle
        "spark.sql.files.maxPartitionBytes": "4m",
    }
    for key, value in {**STARTUP_SETTINGS, **local}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
