"""Session settings the library relies on."""

from pyspark import cloudpickle
from pyspark.sql import SparkSession

import applytrail

# functions travel to the executors with the plan: the package need not be installed there
cloudpickle.register_pickle_by_value(applytrail)

SETTINGS = {
    # every timestamp comparison in the library is done in UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the library's SQL settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str, cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benches; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
