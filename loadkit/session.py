"""SparkSession factory for local runs, tests and the bench.

On a cluster the session comes from the launcher; nothing in the library
depends on the settings made here.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "loadkit", cpus: int | str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local session with adaptive execution and skew handling on."""
    cpus = cpus or os.environ.get("BENCH_CPUS") or "*"
    parts = shuffle_partitions or (8 if cpus == "*" else int(cpus))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        # Small pages: a local run has many small hash tables, each of at least one page.
        .config("spark.buffer.pageSize", "4m")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
