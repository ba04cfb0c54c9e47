"""Session settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split hot join keys even where a later step then needs a shuffle of its own.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A profile of 94 columns has more than 100 measures; keep it inside generated code.
    "spark.sql.codegen.maxFields": "400",
    "spark.sql.session.timeZone": "UTC",
}

#: May be set before a session starts only: jobs are built from many column expressions; do not record a call site for each.
STATIC = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Put the settings into a caller's session; all of them may be changed while it runs."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", **extra: str) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName("recordferry")
               .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
               .config("spark.sql.shuffle.partitions", cores))
    for key, value in {**SETTINGS, **STATIC, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
