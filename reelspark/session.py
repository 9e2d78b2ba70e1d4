"""Session factory used by tests and the bench; production jobs pass their own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int = 8, partitions: int | None = None, app: str = "reelspark") -> SparkSession:
    """A local session with UTC time, adaptive execution and shuffle partitions sized to the cores."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
