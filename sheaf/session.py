"""Session defaults for local runs; a cluster brings its own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(cpus: str | int = "*", name: str = "sheaf") -> SparkSession:
    """A local session with adaptive execution, UTC and few shuffle partitions."""
    n = os.cpu_count() if cpus == "*" else int(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", os.environ.get("SHEAF_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
