"""Session settings that the flows are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Catalyst broadcasts a side only if its estimated size is below this; the
    # narrow dimension columns of the reports often are.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # The estimate starts from file sizes; rows in memory are larger.
    "spark.sql.sources.fileCompressionFactor": "4",
    "spark.ui.enabled": "false",
}


# Shuffle files go when their query ends; else they stay until the driver's heap is collected.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def working_session(spark: SparkSession, **settings: str) -> SparkSession:
    """A session beside ``spark``: its settings, others for one piece of work, and no shuffle files kept.

    Temporary views stay behind. ``__`` in a setting's name stands for a dot.
    """
    session = spark.newSession()
    named = {key.replace("__", "."): value for key, value in settings.items()}
    for key, value in {**spark.conf.getAll, FREED: "true", **named}.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    session.catalog.setCurrentCatalog(spark.catalog.currentCatalog())
    session.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return session


def local_session(cores: int | str = "*", memory: str = "8g", **settings: str) -> SparkSession:
    """A session in this process, for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tributary")
    builder = builder.config("spark.driver.memory", memory)
    builder = builder.config("spark.sql.shuffle.partitions", "8")
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
