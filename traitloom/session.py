"""Session settings the jobs are meant to run with. All of them are ordinary Spark settings; none is required."""

from __future__ import annotations

import pathlib
import tempfile
import zipfile

from pyspark.sql import SparkSession

SETTINGS = {
    # Adaptive execution merges small shuffle partitions and splits skewed join partitions at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM does not compile methods above 8000 bytes of bytecode. A stage whose generated code is larger than that is
    # faster as separate operators than as one method that stays interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# On a cluster: many small shuffle partitions to start from, merged by adaptive execution to about this size. Where the
# cluster has a shuffle service, turn it on as well: shuffle files then outlive their executor.
CLUSTER_SETTINGS = {
    **SETTINGS,
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Splits of this size give 200,000 tasks for 100 TB of raw text, and landed files of a useful size.
    "spark.sql.files.maxPartitionBytes": "512m",
    # Compressed files say little about the rows in them: a side is broadcast only once its size has been measured.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
}


def ship_package(spark: SparkSession) -> str:
    """Hands this package to the Python workers of the executors, where it is not installed; returns the archive's name.

    ``spark-submit --py-files`` with the same archive does as well. The file is read by the driver only, which passes it on.
    """
    here = pathlib.Path(__file__).parent
    archive = f"{tempfile.mkdtemp(prefix='traitloom-')}/{here.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(here.rglob("*.py")):
            out.write(file, file.relative_to(here.parent))
    spark.sparkContext.addPyFile(archive)
    return archive


def local_session(name: str, cores: int = 8, memory: str = "8g", **settings: str) -> SparkSession:
    """Local session for tests and benchmarks; more settings by name, ``__`` standing for a dot."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    extra = {key.replace("__", "."): value for key, value in settings.items()}
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.files.openCostInBytes", "256k")  # small files, one task each
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
