"""Replay of a table as a stream (B7): ordered files, a pace, a count of losses.

Records are cut into blocks of consecutive positions, one file a block, written
by as many tasks as the shuffle has partitions. A file source takes files by
their time, so the files are stamped in block order after the write (one
metadata call a file). The pace is the consumer's: rows per trigger are files
per trigger times rows per file, and a timed trigger spaces the batches.

A manifest of rows per block is kept beside the files, so that a consumer that
skips lost files can be told how many records it has missed.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrail.functions.columns import json_encode
from tabrail.operators.positions import with_position
from tabrail.streaming.score import INPUT_TOPIC

ROWS_PER_FILE = 10_000
#: Batches that a replay is read in when nothing else sets a pace, and the
#: files that one batch takes at most.
BATCHES = 10
FILES_PER_BATCH = 1000
#: Names of data files, as Hadoop's patterns say it.
DATA = "[!_.]*"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _glob(spark: SparkSession, path: str, *patterns: str):
    """File statuses of all that matches ``patterns`` below ``path``, in path
    order: one call, and no block locations, for which a local disk starts a
    process a file."""
    fs, p = _fs(spark, "/".join([path.rstrip("/"), *patterns]))
    return fs.globStatus(p) or []


def _published(spark: SparkSession, path: str, publish: str = "*", block: str = "*"):
    """Statuses of the data files that calls of ``replay_publish`` have left below ``path``."""
    return _glob(spark, path, f"publish={publish}", f"block={block}", DATA)


def _strange(spark: SparkSession, path: str) -> list:
    """Statuses of the other data files below ``path`` (written by others)."""
    fs, _ = _fs(spark, path)
    out = []
    for s in _glob(spark, path, DATA):
        if not s.isDirectory():
            out.append(s)
        elif not s.getPath().getName().startswith("publish="):
            it = fs.listFiles(s.getPath(), True)
            while it.hasNext():
                f = it.next()
                if not f.getPath().getName().startswith(("_", ".")):
                    out.append(f)
    return out


def manifest_path(path: str) -> str:
    return f"{path.rstrip('/')}-manifest"


def replay_publish(records: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, order: str = "id",
                   dense: bool = False) -> str:
    """Append the records as JSON lines below ``path``, ``rows_per_file``
    consecutive ones (in ``order``) a file, in the order a file source reads.

    ``dense`` says that ``order`` already is 0, 1, 2, ... (replay ids);
    otherwise the records are numbered first. Files of a later call follow
    those of earlier ones."""
    spark = records.sparkSession
    publish = str(time.time_ns())
    base = f"{path.rstrip('/')}/publish={publish}"
    numbered = records.withColumn("_tr_pos", F.col(order).cast("long")) if dense else with_position(records, [order], name="_tr_pos")
    block = F.format_string("%012d", F.expr(f"_tr_pos div {int(rows_per_file)}"))
    dealt = numbered.withColumn("block", block).repartition("block").sortWithinPartitions("block", "_tr_pos").drop("_tr_pos")
    json_encode(dealt, keep=("block",)).write.partitionBy("block").text(base)
    fs, _ = _fs(spark, base)
    new = _published(spark, path, publish)
    earlier = [s for d in _glob(spark, path, "publish=*") for p in [d.getPath().getName().split("=", 1)[1]] if p != publish
               for s in _published(spark, path, p)]
    old = max((s.getModificationTime() for s in [*earlier, *_strange(spark, path)]), default=0)
    first = max(int(time.time() * 1000), old + 1)
    for i, f in enumerate(new):
        fs.setTimes(f.getPath(), first + i, -1)
    if len(new):
        (spark.read.option("basePath", base).text(base).groupBy(F.format_string("%012d", F.col("block").cast("long")).alias("block"))
         .agg(F.count(F.lit(1)).alias("published")).withColumn("publish", F.lit(publish))
         .write.mode("append").parquet(manifest_path(path)))
    return path


def publish_topic(records: DataFrame, servers: str, topic: str = INPUT_TOPIC, key: str = "id") -> None:
    """B7 to Kafka: the records as JSON values, keyed so that equal keys stay
    in order (needs the Kafka package). The consumer sets the pace with
    ``maxOffsetsPerTrigger``."""
    out = json_encode(records.withColumn("key", F.col(key).cast("string")), keep=("key",))
    out.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def pace(rows_per_trigger: int, seconds: float, rows_per_file: int = ROWS_PER_FILE) -> tuple[int, dict]:
    """(files per trigger, trigger) for a replay of ``rows_per_trigger`` rows
    every ``seconds``; the rows have to be whole files."""
    if rows_per_trigger % rows_per_file:
        raise ValueError("rows per trigger must be a multiple of rows per file")
    return rows_per_trigger // rows_per_file, {"processingTime": f"{seconds} seconds"}


def files_per_batch(spark: SparkSession, path: str, batches: int = BATCHES, least: int = 1) -> int:
    """Files per trigger that read the files below ``path`` in ``batches``
    batches, ``least`` files each; beyond ``FILES_PER_BATCH`` files a batch,
    in more. The fixed cost of a batch is then paid a bounded number of times
    or once per many files, whatever the rows of a file."""
    files = len(_published(spark, path)) + len(_strange(spark, path))
    return max(least, min(FILES_PER_BATCH, -(-files // batches)))


def block_of(file: str = "file"):
    """(publish, block) of a record's file path, as the manifest names them."""
    return (F.regexp_extract(file, "publish=([0-9]+)", 1).alias("publish"), F.regexp_extract(file, "block=([0-9]+)", 1).alias("block"))


def loss_report(landed: DataFrame, path: str) -> DataFrame:
    """(publish, block, published, landed, lost) for every published
    block; ``landed`` has a ``file`` column per record (``stream_source`` with
    ``with_file``). Counts meet, not records."""
    got = landed.groupBy(*block_of()).agg(F.count(F.lit(1)).alias("landed"))
    sent = landed.sparkSession.read.parquet(manifest_path(path))
    out = sent.join(got, ["publish", "block"], "left").withColumn("landed", F.coalesce("landed", F.lit(0)))
    return out.select("publish", "block", "published", "landed", (F.col("published") - F.col("landed")).alias("lost"))


def lose_block(spark: SparkSession, path: str, block: int) -> int:
    """Delete the files of a block, as retention would; returns how many."""
    fs, _ = _fs(spark, path)
    gone = _published(spark, path, block=f"{block:012d}")
    for f in gone:
        fs.delete(f.getPath(), False)
    return len(gone)
