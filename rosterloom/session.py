"""Session settings the jobs are written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # The panel projects 54 columns at once; beyond this size the JVM would interpret the generated method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Python workers hold a batch or two of texts at a time, whatever the texts' lengths.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


# Settings a running session takes over without changing results.
RUNTIME_SETTINGS = (
    "spark.sql.codegen.hugeMethodLimit",
    "spark.sql.execution.arrow.maxRecordsPerBatch",
    "spark.sql.execution.arrow.maxBytesPerBatch",
)


def share_package(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from the folder the driver has it from.

    A cluster whose machines lack that folder gets the package with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Applies the runtime settings that the session's owner has not set."""
    share_package(spark)
    for key in RUNTIME_SETTINGS:
        if spark.sparkContext.getConf().get(key) is None:
            spark.conf.set(key, SETTINGS[key])
    return spark


def local_session(cores: int = 8, memory: str = "8g", name: str = "rosterloom") -> SparkSession:
    """Session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return share_package(spark)
