"""The monitor of a running stream (E3, F7): newest results, kept per batch.

Every micro-batch is reduced to its newest n rows (a top-k) and merged with the
n rows kept so far; the result is a small table named after the batch id, so
that a batch that runs again after a failure gives the same table again. Work
per batch follows the batch, not the stream's past.

With ``block`` a batch holds many consecutive blocks of results (files, say)
and the metrics are those after every block. A block is cut to its newest n
rows; ``CHUNK`` neighbouring blocks to theirs; then a chunk finds the newest n
of all chunks before it, and a block the newest n of those and of its chunk's
blocks up to it. A block so meets at most (CHUNK + 1) * n rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabrail.operators.metrics import live_metrics, live_metrics_cols, monitor_units
from tabrail.operators.split import last_n


#: Blocks whose newest rows are merged before they meet those of others.
CHUNK = 32


class LiveTop:
    """Newest ``n`` results and their metrics in the folder ``root``: after
    every micro-batch, or after every value of the integer column ``block``
    (ascending with the stream; a block lies in one micro-batch)."""

    def __init__(self, spark: SparkSession, root: str, n: int, order: str = "id", block: str | None = None):
        self.spark, self.root, self.n, self.order, self.block = spark, root.rstrip("/"), n, order, block

    def _versions(self) -> list[int]:
        """Batch ids whose table is complete; at most three are kept."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.root}/top")
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        done = [s.getPath() for s in fs.listStatus(p) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
        return sorted(int(d.getName().split("=")[1]) for d in done)

    def _at(self, batch: int) -> str:
        return f"{self.root}/top/batch={batch}"

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        before = [v for v in self._versions() if v < batch_id]
        kept = batch.sparkSession.read.schema(batch.schema).parquet(self._at(before[-1])) if before else None
        if self.block:
            # Read once: all that follows needs a block's newest rows alone.
            path = f"{self.root}/blocks"
            self._newest(batch, F.col(self.block)).write.mode("overwrite").parquet(path)
            batch = batch.sparkSession.read.schema(batch.schema).parquet(path)
        newest = last_n(batch, self.n, self.order)
        if before:
            newest = last_n(newest.unionByName(kept), self.n, self.order)
        newest.write.mode("overwrite").parquet(self._at(batch_id))
        if self.block:
            after = self._after_blocks(batch, kept)
        else:
            top = batch.sparkSession.read.schema(batch.schema).parquet(self._at(batch_id))
            after = live_metrics(top, self.n, self.order)
        after.write.mode("overwrite").parquet(f"{self.root}/metrics/batch={batch_id}")
        # A batch that runs again needs the table before it, no older one.
        jvm = self.spark.sparkContext._jvm
        for v in before[:-1]:
            p = jvm.org.apache.hadoop.fs.Path(self._at(v))
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def _newest(self, df: DataFrame, *group: Column) -> DataFrame:
        """The newest n rows of every group."""
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.col(self.order).desc()))
        return df.withColumn("_tr_rank", rank).where(F.col("_tr_rank") <= self.n).drop("_tr_rank")

    def _after_blocks(self, tops: DataFrame, kept: DataFrame | None) -> DataFrame:
        """block and live metrics after every block of a batch, from the
        blocks' newest rows and the rows kept before the batch."""
        chunk = F.expr(f"`{self.block}` div {CHUNK}").alias("_tr_chunk")
        rows = tops.select("*", chunk)
        of_chunk = self._newest(rows, F.col("_tr_chunk"))
        chunks = rows.select(F.col("_tr_chunk").alias("_tr_at")).distinct()
        past = of_chunk.join(F.broadcast(chunks), F.col("_tr_chunk") < F.col("_tr_at")).drop("_tr_chunk")
        if kept is not None:
            past = past.unionByName(kept.crossJoin(F.broadcast(chunks)))
        past = self._newest(past, F.col("_tr_at"))
        blocks = rows.select(F.col(self.block).alias("_tr_block"), F.col("_tr_chunk").alias("_tr_at")).distinct()
        here = rows.join(F.broadcast(blocks), (F.col("_tr_chunk") == F.col("_tr_at")) & (F.col(self.block) <= F.col("_tr_block")))
        held = here.drop("_tr_chunk").unionByName(past.join(F.broadcast(blocks), "_tr_at").select(*tops.columns, "_tr_block", "_tr_at"))
        newest = self._newest(held, F.col("_tr_block"))
        return monitor_units(newest).groupBy(F.col("_tr_block").alias("block")).agg(*live_metrics_cols())

    def start(self, results: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        return (results.writeStream.foreachBatch(self.merge).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).start())

    def newest(self) -> DataFrame:
        """The newest ``n`` results as of the last batch."""
        return self.spark.read.parquet(self._at(self._versions()[-1]))

    def metrics(self) -> DataFrame:
        """batch, mae_k, rmse_k, samples: the live metrics after every batch,
        or after every block, then under its own number."""
        found = self.spark.read.parquet(f"{self.root}/metrics")
        if self.block:
            return found.select("mae_k", "rmse_k", "samples", F.col("block").cast("long").alias("batch"))
        return found.withColumn("batch", F.col("batch").cast("long"))
