"""Resumable runs as file streams: a second run reads only what is new, and a restarted one repeats nothing."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def run_once(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """All there is now, in micro-batches, then stop. The checkpoint folder must be shared by the cluster."""
    q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def resume_files(spark: SparkSession, folder: str, schema: str, out: str, checkpoint: str, fmt: str = "json", transform: Callable[[DataFrame], DataFrame] | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Files of a folder that no earlier run has read, transformed and appended to ``out``; the whole output.

    With ``keys``, rows whose key was ever seen are dropped, in this run or an earlier one.
    Broken lines are dropped before that, else they would all share the null key.
    """
    read = spark.readStream.schema(f"{schema}, _corrupt_record string" if fmt == "json" else schema).format(fmt)
    s = (read.option("columnNameOfCorruptRecord", "_corrupt_record") if fmt == "json" else read).load(folder)
    if fmt == "json":
        s = s.where("_corrupt_record is null").drop("_corrupt_record")
    if keys:
        s = s.dropDuplicates(list(keys))
    if transform:
        s = transform(s)
    q = s.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out)


BUCKETS = 64


def merge_state(spark: SparkSession, folder: str, schema: str, state_path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str | Column], fmt: str = "parquet", buckets: int = BUCKETS) -> DataFrame:
    """State events of a folder merged into a state table by foreachBatch: per key the last event wins.

    The table lies in hash buckets of its keys. A batch writes a new version of the buckets it touches and of no
    others; the newest whole version of a bucket counts, and older ones are removed once it is there. Versions are numbered by what the
    folder holds, so a new checkpoint adds to a state that is there, and a batch replayed after a failure gives the same table.
    """
    from lawmill.operators.dedupe import last_wins

    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(state_path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions() -> tuple[int, dict[int, int]]:
        """The highest version begun, and of each bucket the newest that was written whole."""
        top, newest = -1, {}
        for v in fs.listStatus(root) if fs.exists(root) else []:
            n = int(v.getPath().getName()[1:])
            top = max(top, n)
            if fs.exists(jvm.org.apache.hadoop.fs.Path(v.getPath(), "_SUCCESS")):
                for b in fs.listStatus(v.getPath()):
                    name = b.getPath().getName()
                    if name.startswith("_bucket="):
                        newest[int(name[8:])] = max(n, newest.get(int(name[8:]), -1))
        return top, newest

    def read(places: dict[int, int]) -> DataFrame:
        paths = [f"{state_path}/v{n}/_bucket={b}" for b, n in sorted(places.items())]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def sink(batch: DataFrame, _: int) -> None:
        top, newest = versions()
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        touched = [r[0] for r in batch.select(bucket).distinct().collect()]  # at most ``buckets`` numbers
        if not touched:
            return
        known = read({b: n for b, n in newest.items() if b in touched})
        last_wins(known.unionByName(batch), keys, order).withColumn("_bucket", bucket).repartition(len(touched), "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{state_path}/v{top + 1}")
        for b in touched:
            if b in newest:
                fs.delete(jvm.org.apache.hadoop.fs.Path(f"{state_path}/v{newest[b]}/_bucket={b}"), True)

    run_once(spark.readStream.schema(schema).format(fmt).load(folder), sink, checkpoint)
    return read(versions()[1])


class ProgressLog(StreamingQueryListener):
    """Logs of every micro-batch how many rows came and how fast they went, and how a query ended."""

    def __init__(self, log: logging.Logger | None = None):
        self.log = log or logging.getLogger("lawmill.streaming")

    def onQueryStarted(self, event) -> None:
        self.log.info("started %s", event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.log.info("batch %s: %s rows, %s rows/s", p.batchId, p.numInputRows, p.processedRowsPerSecond)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.log.info("ended %s%s", event.id, f": {event.exception}" if event.exception else "")
