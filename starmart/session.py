"""Session settings the library is tuned for, and the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cpus: str = "8", memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("starmart")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, fallback: str) -> str:
    """The folder all executors see; ``fallback`` is for local sessions that name none, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and fallback and not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a folder that all executors see in spark.checkpoint.dir")
    return folder or fallback
