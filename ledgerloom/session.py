"""Session defaults for local runs and for `spark-submit` entry points.

The submitter's own settings win: a default is set only where the submitted configuration has no such key, a session
that is already there is used as it is, and the master is only named when the caller asks for one.
"""

from __future__ import annotations

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # A run has more generated classes than the default cache of 100 keeps; evicted ones compile and warm up again.
    "spark.sql.codegen.cache.maxEntries": "2000",
}


def defaults_for(submitted: SparkConf) -> dict[str, str]:
    """The defaults that the submitted configuration leaves open."""
    return {name: value for name, value in DEFAULTS.items() if not submitted.contains(name)}


def build_session(app: str, master: str | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    """The active session, or one with `extra` and the defaults this package is tested under."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    extra = extra or {}
    # The launched JVM takes its memory from `extra`; under `spark-submit` it is there already, with its settings.
    SparkContext._ensure_initialized(conf=SparkConf(loadDefaults=False).setAll(list(extra.items())))
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for name, value in {**defaults_for(SparkConf()), **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
