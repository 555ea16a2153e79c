"""Session settings shared by tests, the benchmark and scripts."""

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Call sites of every column expression cost more than small plans themselves.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores="8", shuffle_partitions="8", name="paperloom", extra=None):
    """A single-JVM session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark):
    """Use the shared checkpoint folder the session names.

    A folder of our own is made only in local mode, where driver and executors
    share one machine. On a cluster a missing setting is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="paperloom-checkpoint-"))
    else:
        raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share")


def scratch_root(spark) -> str:
    """A new folder that all executors share, for stores that last no longer than a query."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/paperloom-{uuid.uuid4().hex}"
