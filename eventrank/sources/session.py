"""Session settings, the shared scratch folder, and shipping this package to the workers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # Wide projections make methods the JVM would only interpret; above this size Spark splits them up itself.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_local_roots: dict[str, str] = {}
_shipped: set[str] = set()


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own and is never reconfigured here."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("eventrank")
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", memory)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _scratch_root(spark: SparkSession) -> str:
    """The application's own folder below the shared one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder shared by all executors")
        root = _local_roots.get(context.applicationId)
        if root is None:
            root = _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="eventrank-")
    return f"{root.rstrip('/')}/eventrank-{context.applicationId}"


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder that all executors can reach, below the one named in ``spark.checkpoint.dir``.

    Only a local session without that setting may fall back to this machine's temporary folder. Results are lazy, so
    nobody but the caller knows when a folder has been read for the last time: ``remove_scratch`` removes them all.
    """
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Removes all scratch folders of this application; call it when its results have been read or written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read from there, for results that are used many times."""
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Hands this package to all Python workers, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="eventrank-code-"), "eventrank_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
