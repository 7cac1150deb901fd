"""Session factory and the shared working folder of a job."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lawmill", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings that the engine's semantics rely on.

    UTC clock, last value wins for repeated map keys, AQE with skew handling.
    Nothing about memory or cores is set here: that is the cluster's business.
    """
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


#: Rows of an Arrow batch: texts of tens of kilobytes pass through Python, and a batch is held whole on both sides.
BATCH_ROWS = "2000"


def bound_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches than Spark's default, unless the session says otherwise."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, BATCH_ROWS)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Where it is unset the master must be local: then a temporary folder is
    taken and remembered in the session. A cluster without the setting is an error,
    because a folder of one machine isn't visible to the others.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    d = "file://" + tempfile.mkdtemp(prefix="lawmill-")
    spark.conf.set("spark.checkpoint.dir", d)
    return d


_to_remove: set[str] = set()


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table, in the application's folder, which goes when the driver's process ends."""
    folder = f"{shared_dir(spark)}/lawmill/{spark.sparkContext.applicationId}"
    if folder not in _to_remove:
        _to_remove.add(folder)
        atexit.register(remove_stages, spark, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def remove_stages(spark: SparkSession, folder: str | None = None) -> None:
    """The staged tables of an application deleted, this one's by default; what was made of them can't be read any more."""
    folder = folder or f"{shared_dir(spark)}/lawmill/{spark.sparkContext.applicationId}"
    try:
        sc = spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
    except Exception:  # noqa: BLE001 - the process is ending, and so may be its JVM
        pass
    _to_remove.discard(folder)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage is cut, and
    the files survive the loss of executors."""
    path = stage_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
