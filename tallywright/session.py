"""Session settings and the shared folder for stage tables."""

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str = "8", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the one you are given."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallywright")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # local tables are many small files: pack them by their real size
        .config("spark.sql.files.openCostInBytes", "16384")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="tallywright-")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir()
