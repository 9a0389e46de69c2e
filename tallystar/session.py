"""Session builder and settings from the environment."""
from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Names of the environment settings and their defaults.
MASTER, MASTER_DEFAULT = "SPARK_MASTER_URL", "local[*]"
TIME_ZONE, TIME_ZONE_DEFAULT = "SPARK_TIMEZONE", "UTC"
LOG_LEVEL, LOG_LEVEL_DEFAULT = "SPARK_LOG_LEVEL", "WARN"
CLASSPATH = "SPARK_JDBC_CLASSPATH"

# Adaptive execution splits hot join partitions and turns a join into a broadcast
# only after measuring the side; zstd about halves shuffled hex keys. A generated
# method over 8000 bytes is never compiled by the JVM: staging's 57 columns run
# about a quarter faster when such a stage falls back to split projections.
# Adaptive execution merges small shuffle partitions but splits only skewed joins, so it
# starts from many unless the caller says how many.
PARTITIONS, MANY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "4000"
_DEFAULTS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.io.compression.codec": "zstd",
    "spark.ui.enabled": "false",
}


def setting(name: str, default: str = "", environ: Mapping[str, str] | None = None) -> str:
    return (os.environ if environ is None else environ).get(name, default)


def build_session(
    app_name: str,
    options: Mapping[str, str] | None = None,
    environ: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session from the environment; ``options`` win over every default.

    The class path setting reaches the executors. A driver that already runs cannot take
    it in: name the jars when launching it.
    """
    configured = {
        **_DEFAULTS,
        "spark.sql.session.timeZone": setting(TIME_ZONE, TIME_ZONE_DEFAULT, environ),
    }
    jars = setting(CLASSPATH, "", environ)
    if jars:
        configured["spark.executor.extraClassPath"] = jars
    if "spark.sql.shuffle.partitions" not in (options or {}):
        configured[PARTITIONS] = MANY
    configured.update(options or {})
    builder = SparkSession.builder.appName(app_name).master(
        setting(MASTER, MASTER_DEFAULT, environ)
    )
    spark = builder.config(map=configured).getOrCreate()
    spark.sparkContext.setLogLevel(setting(LOG_LEVEL, LOG_LEVEL_DEFAULT, environ))
    return spark
