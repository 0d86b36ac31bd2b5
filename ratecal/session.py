"""Session settings the operators are written for."""

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus="*", shuffle_partitions=8, memory="12g") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ratecal")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables that the session names in `spark.checkpoint.dir`.

    Only a local session, as in tests, may name none: it gets a new folder of its own, which is
    then its checkpoint directory. Executors of a cluster could not read such a folder, so there a
    missing setting is an error.
    """
    context = spark.sparkContext
    shared = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^-].*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="ratecal-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared)
    return shared


def new_folder(spark: SparkSession) -> str:
    """A name for a table of its own in the work folder."""
    return f"{work_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"


DROPPED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def shuffles_dropped(spark: SparkSession, **further: str):
    """What a query has shuffled leaves the disks when it ends, instead of some time after the session has forgotten it: for
    jobs of several steps that store what they go on from. `further` settings hold as long; underscores stand for dots."""
    settings = DROPPED | {name.replace("_", "."): value for name, value in further.items()}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
