"""Session settings and the shared scratch folder.

Nothing here forces a join strategy.  Broadcasts are left to Spark's own size
check (``spark.sql.autoBroadcastJoinThreshold`` plus AQE's run-time sizes), so a
lookup that outgrows the threshold becomes a shuffled join without a code change.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    # Call-site capture costs several driver round trips per Column.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: str = "8", memory: str = "12g") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillhouse")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own: on a cluster a
    machine-local path would be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillhouse-"))
    return spark.sparkContext.getCheckpointDir()


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives lost executors and gives the planner the true
    size, so a following join broadcasts it only if it really is small.  Zstandard takes
    hashes and digits at half the size, which Snappy stores as they are.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.scratch = path
    return stored


def discard(stored: DataFrame) -> None:
    """Delete what ``materialise`` wrote, once nothing reads it any more."""
    spark = stored.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(stored.scratch)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
