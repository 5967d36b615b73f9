"""Stream scoring (J1-J6) with its source (A3, J7) and sinks.

The scoring query is stateless append: decode -> model -> error columns ->
JSON, all in one stage per micro-batch; its only state is the source
position in the checkpoint. Kafka is the deployment transport; a text
directory is the same contract (one JSON record per ``value``) and is what
the tests drive, since no Kafka connector jar is on this machine.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tabrail.functions.columns import (
    json_decode,
    json_encode,
    prediction_error,
    stream_record_schema,
)
from tabrail.functions.rules import any_of

# Topic names and run limits of the reference deployment.
INPUT_TOPIC = "house-prices-input"
OUTPUT_TOPIC = "house-prices-output"
RUN_SECONDS = 120
POLL_SECONDS = 5


def stream_source(
    spark: SparkSession,
    fmt: str = "text",
    path: str | None = None,
    topic: str = INPUT_TOPIC,
    servers: str | None = None,
    max_per_trigger: int | None = None,
    with_file: bool = False,
    **options,
) -> DataFrame:
    """A stream of raw records in a ``value`` column.

    kafka: subscribe to ``topic`` from the earliest offset and carry on when
    offsets were trimmed (``failOnDataLoss=false``).
    text:  new files of a directory and its folders, oldest first, one record
    per line; missing files are skipped (``ignoreMissingFiles``), the
    file-source form of the same rule. ``with_file`` adds the path a record
    came from as ``file``.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        reader = reader.option("startingOffsets", "earliest").option("failOnDataLoss", "false")
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    else:
        reader = reader.option("ignoreMissingFiles", "true").option("recursiveFileLookup", "true")
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    for k, v in options.items():
        reader = reader.option(k, v)
    raw = reader.load(path) if path is not None and fmt != "kafka" else reader.load()
    file = [F.col("_metadata.file_path").alias("file")] if with_file else []
    return raw.select(F.col("value").cast("string").alias("value"), *file)


def decode_records(raw: DataFrame, features: Sequence[str]) -> DataFrame:
    """C3 on the input stream: fixed record schema, flat columns, plus the
    raw text (kept for the reject sink)."""
    return json_decode(raw, stream_record_schema(features), keep=("value",))


def complete_record(features: Sequence[str]) -> Column:
    """Whether the model can score the record: only the features feed it."""
    return ~any_of(F.col(c).isNull() for c in features)


def reject_reason(features: Sequence[str]) -> Column:
    """Why the model cannot score a decoded record; null if it can. A record
    without id or known price is scored (its error columns are null)."""
    nan_feature = any_of(F.coalesce(F.isnan(c), F.lit(False)) for c in features)
    return (
        F.when(complete_record(features) & ~nan_feature, F.lit(None))
        .when(F.col("value").isNull() | (F.trim("value") == ""), F.lit("empty record"))
        .when(F.json_object_keys("value").isNull(), F.lit("not a JSON object"))
        .otherwise(F.lit("missing or invalid field"))
    )


def quarantine(decoded: DataFrame, features: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """J6 on a frame: split decoded records into (complete, rejected).
    Rejected rows keep the raw text and a reason; nothing is dropped."""
    marked = decoded.withColumn("reason", reject_reason(features))
    good = marked.where("reason is null").drop("value", "reason")
    return good, marked.where("reason is not null").select("value", "id", "reason")


def score_or_quarantine(raw: DataFrame, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """J6 on a stream: every record once, as outcome 'scored' with its result
    columns or 'rejected' with its raw text and a reason. The input is read
    once: rejected rows pass the model on zeros and their results are blanked,
    so one query with a sink partitioned by ``outcome`` holds both."""
    marked = decode_records(raw, features).withColumn("reason", reject_reason(features))
    ok = F.col("reason").isNull()
    safe = marked.withColumns({c: F.when(ok, F.col(c)).otherwise(F.lit(0.0)) for c in features})
    scored = model.transform(safe).withColumn("prediction", F.when(ok, F.col("prediction")))
    err = F.col("prediction") - F.col("actual_price")
    return scored.select(
        F.when(ok, F.lit("scored")).otherwise(F.lit("rejected")).alias("outcome"),
        "id", "actual_price", F.col("prediction").alias("predicted_price"), err.alias("error"),
        (F.try_divide(err, F.col("actual_price")) * F.lit(100)).alias("error_percentage"),
        F.when(~ok, F.col("value")).alias("value"), "reason")


def score_records(records: DataFrame, model: PipelineModel) -> DataFrame:
    """J1 core: model -> (id, actual_price, predicted_price, error,
    error_percentage)."""
    return prediction_error(model.transform(records))


def score_stream(raw: DataFrame, model: PipelineModel, features: Sequence[str],
                 strict: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """J1 (+ J6): raw records -> scored results, and the rejected records.

    ``strict=True`` is the reference's behaviour: a record that does not
    decode reaches the model and the query fails."""
    decoded = decode_records(raw, features)
    if strict:
        return score_records(decoded.drop("value"), model), None
    good, bad = quarantine(decoded, features)
    return score_records(good, model), bad


def start_sink(
    df: DataFrame,
    path: str | None,
    checkpoint: str,
    fmt: str = "text",
    trigger: dict | None = None,
    topic: str = OUTPUT_TOPIC,
    servers: str | None = None,
    name: str | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Write one JSON ``value`` per row, append mode, with a checkpoint.
    The text sink is exactly-once (its metadata log), Kafka at-least-once.
    ``fmt='memory'`` / ``'console'`` give the debug tap (B5)."""
    if "value" not in df.columns or len(df.columns) != 1:
        if fmt in ("text", "kafka"):
            df = json_encode(df)
    w = df.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    if fmt == "kafka":
        w = w.option("kafka.bootstrap.servers", servers).option("topic", topic)
    elif fmt == "console":
        w = w.option("truncate", "false")
    elif fmt == "memory":
        w = w.queryName(name or "tap")
    elif path is not None:
        w = w.option("path", path)
    if name and fmt != "memory":
        w = w.queryName(name)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


class ProgressLog(StreamingQueryListener):
    """Rows per batch of every query that ran while the log was attached."""

    def __init__(self):
        self.batches: dict[str, dict[int, int]] = {}
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event):
        self.batches.setdefault(str(event.id), {})

    def onQueryProgress(self, event):
        p = event.progress
        self.batches.setdefault(str(p.id), {})[p.batchId] = p.numInputRows

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended[str(event.id)] = event.exception

    def count(self, query: StreamingQuery) -> int:
        """Batches of a query that had rows."""
        return sum(1 for n in self.batches.get(str(query.id), {}).values() if n)


def bounded_run(queries: Sequence[StreamingQuery], timeout_s: float | None = RUN_SECONDS,
                poll_s: float = POLL_SECONDS, max_batches: int | None = None,
                log: ProgressLog | None = None) -> dict:
    """Wait up to ``timeout_s`` (None: without a limit), polling every
    ``poll_s``; stop early when any query has died (failed), when all have
    finished, or when one has done ``max_batches`` batches (counted by ``log``,
    which the caller has attached before the start), and always stop all of
    them. A query failure is re-raised after the stop. ``ended`` says why the
    run ended: only after 'finished' has all input been read. A stopped query
    goes on from its checkpoint."""
    start = time.monotonic()
    end = float("inf") if timeout_s is None else start + timeout_s
    error = None
    reason = "timeout"
    try:
        while True:
            ended = [q for q in queries if not q.isActive]
            failed = [q.exception() for q in ended if q.exception() is not None]
            if failed:
                error, reason = failed[0], "failed"
                break
            if len(ended) == len(queries):
                reason = "finished"
                break
            if max_batches is not None and log is not None and any(log.count(q) >= max_batches for q in queries):
                reason = "limit"
                break
            # The queries are looked at once more after the last sleep: one
            # that has failed by then has not run out of time.
            left = end - time.monotonic()
            if left <= 0:
                break
            time.sleep(min(poll_s, left))
    finally:
        for q in queries:
            q.stop()
    if error is not None:
        raise RuntimeError(f"stream failed: {error}")
    return {"seconds": round(time.monotonic() - start, 3), "ended": reason}


def stream_results(spark: SparkSession, path: str | None = None, fmt: str = "text",
                   topic: str = OUTPUT_TOPIC, servers: str | None = None,
                   schema=None) -> DataFrame:
    """A6 (stream form): read the result sink from its start as a stream and
    decode it; a query on it with a checkpoint resumes from its committed
    position, as the reference's consumer group does."""
    from tabrail.sources.tables import result_schema

    if fmt == "kafka":
        raw = stream_source(spark, "kafka", topic=topic, servers=servers)
    else:
        raw = spark.readStream.format(fmt).load(path).select(F.col("value").cast("string").alias("value"))
    return raw.select(F.from_json("value", schema or result_schema()).alias("r")).select("r.*")


def fan_out(results: DataFrame, sink_path: str, checkpoint_root: str, spark: SparkSession,
            tap_name: str = "tap", trigger: dict | None = None,
            tap_path: str | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """The scored stream feeds the JSON sink; the debug tap reads that
    sink's output instead of scoring again. Each query has its own
    checkpoint. The tap is a Parquet table at ``tap_path``, or an in-memory
    table named ``tap_name`` (debugging only: it keeps rows in the driver)."""
    main = start_sink(results, sink_path, f"{checkpoint_root}/sink", trigger=trigger)
    if (trigger or {"availableNow": True}).get("availableNow"):
        main.awaitTermination()
    else:
        # The tap reads the sink's folder: let the first batches land first.
        main.processAllAvailable()
    tapped = stream_results(spark, sink_path, schema=results.schema)
    if tap_path:
        tap = start_sink(tapped, tap_path, f"{checkpoint_root}/tap", fmt="parquet", trigger=trigger)
    else:
        tap = start_sink(tapped, None, f"{checkpoint_root}/tap", fmt="memory", name=tap_name,
                         trigger=trigger)
    return main, tap


def forget_commit(spark: SparkSession, checkpoint: str) -> int | None:
    """Drop the last entry of a stopped query's commit log, as if it had died
    after its sink took the batch and before the commit: the next start runs
    that batch again. Returns its id."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    ids = [int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit()]
    if not ids:
        return None
    fs.delete(jvm.org.apache.hadoop.fs.Path(p, str(max(ids))), False)
    return max(ids)
