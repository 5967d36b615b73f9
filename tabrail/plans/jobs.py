"""Composed jobs (P1-P4): prepare, train, predict, end to end.

Each job is a plain function over DataFrames and paths; scheduling,
retries and service start-up stay with whatever runs the jobs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrail.config import LAST_N, Settings, scratch, stored, work_dir
from tabrail.functions.columns import replay_record
from tabrail.operators import forest as M
from tabrail.operators.metrics import describe, monitor_series, report_text, row_counts
from tabrail.operators.split import exact_split, head_n, test_positions
from tabrail.sinks.tables import publish_tables, run_status, table_exists, write_csv
from tabrail.sources.models import load_model, save_model
from tabrail.sources.tables import read_results, read_table
from tabrail.streaming.replay import ROWS_PER_FILE, manifest_path, replay_publish
from tabrail.streaming.score import bounded_run, score_stream, start_sink, stream_source

# Fixed value: the label's unit as the reference's data description states it.
LABEL_UNIT = "median price, unit $100,000"


def dataset_report(spark: SparkSession, features: Sequence[str], label: str,
                   counts: DataFrame, unit: str = LABEL_UNIT) -> DataFrame:
    """F8: (section, key, value): feature list, label, unit and the total /
    train / stream counts (``counts`` = one row of ``row_counts``)."""
    meta = spark.createDataFrame(
        [("feature", str(i), f) for i, f in enumerate(features)]
        + [("label", label, unit)],
        "section string, key string, value string",
    )
    numbers = counts.select(
        F.expr("stack(3, 'total', total, 'train', train, 'stream', test) AS (key, n)")
    ).select(F.lit("count").alias("section"), "key", F.col("n").cast("string").alias("value"))
    return meta.unionByName(numbers)


def prepare_job(spark: SparkSession, data: DataFrame, settings: Settings, out_root: str) -> dict:
    """Profile (F2), exact split (S1), write both parts as CSV (B1),
    report (F8). ``data`` is computed and stored once, until the parts are
    written: profile and split scan the columns they need of that copy."""
    data = data.select(*settings.key, *settings.features, settings.label)
    paths = {"train": f"{out_root}/train_data", "stream": f"{out_root}/streaming_data"}
    with scratch(spark):
        data = stored(data, "prepared")
        profile = describe(data, [*settings.features, settings.label])
        split = exact_split(data, list(settings.key), settings.test_fraction, settings.seed, position=None)
        write_csv(split.where(F.col("part") == "train").drop("part"), paths["train"])
        write_csv(test_positions(split, list(settings.key), settings.seed).drop("part"), paths["stream"])
        counts = row_counts(split)
        # One row, counted before the intermediate tables go.
        counts = spark.createDataFrame([counts.first()], counts.schema)
    schema = ", ".join(f"`{c}` {t}" for c, t in data.dtypes)
    return {
        "profile": profile,
        "report": dataset_report(spark, settings.features, settings.label, counts),
        "paths": paths,
        "train": read_table(spark, paths["train"], schema=schema),
        "stream": read_table(spark, paths["stream"], schema=schema + ", id long"),
    }


def train_job(
    spark: SparkSession,
    train: DataFrame,
    settings: Settings,
    warehouse: str,
    model_paths: Sequence[str],
    status_path: str,
    estimator: Pipeline | None = None,
    clock: Callable[[], str] | None = None,
) -> dict:
    """Publish the prepared rows (B2) -> status started (B8) -> split,
    fit, score, report (M6) -> save (B6) -> completed (B8)."""
    published = publish_tables({"train_data": train}, warehouse)
    data = spark.read.parquet(published["train_data"])
    est = estimator or M.forest_estimator(settings.features, settings.label,
                                          settings.num_trees, settings.max_depth, settings.seed)
    status = run_status(spark, status_path, "training", model_path=model_paths[0], clock=clock)
    with status:
        model, predictions, report = M.evaluate(est, data, list(settings.key), settings.label,
                                                1 - settings.test_fraction, settings.seed)
        saved = save_model(model, model_paths)
        status.model_path = saved
        # One row; with its schema, as R2 is null for a constant label.
        report = spark.createDataFrame([report.first()], report.schema)
    return {"model": model, "report": report, "lines": report_text(report), "predictions": predictions, "model_path": saved}


def predict_job(
    spark: SparkSession,
    model_paths: Sequence[str],
    replay: DataFrame,
    settings: Settings,
    run_root: str,
    status_path: str,
    n: int | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    timeout_s: float | None = None,
    clock: Callable[[], str] | None = None,
) -> DataFrame:
    """Status started -> replay the first ``n`` records (B7; their ids are
    positions) -> stream score with a bounded run (J1, J5) -> status
    completed. Returns the result sink read back.

    The run ends when all of the replay is scored or rejected. A run that
    ``timeout_s`` ends before, or that has fewer records in its two sinks than
    were published, fails and is not completed."""
    model, _ = load_model(model_paths)
    inp, out = f"{run_root}/input", f"{run_root}/output"
    with run_status(spark, status_path, "prediction", clock=clock):
        replay_publish(head_n(replay, n, ["id"]), inp, rows_per_file, dense=True)
        results, rejects = score_stream(stream_source(spark, "text", inp), model, settings.features)
        q1 = start_sink(results, out, f"{run_root}/ckpt-out")
        q2 = start_sink(rejects, f"{run_root}/rejects", f"{run_root}/ckpt-rej")
        ended = bounded_run([q1, q2], timeout_s=timeout_s, poll_s=0.5)["ended"]
        if ended != "finished":
            raise TimeoutError(f"stream ended by its {ended} before the replay was scored")
        _require_whole(spark, inp, [out, f"{run_root}/rejects"])
    return read_results(spark, out)


def _require_whole(spark: SparkSession, published: str, sinks: Sequence[str]) -> None:
    """Raise when the text sinks hold fewer records than the replay published
    (the source skips files that are gone)."""
    if not table_exists(spark, manifest_path(published)):
        return
    sent = spark.read.parquet(manifest_path(published)).agg(F.sum("published")).first()[0]
    landed = sum(spark.read.text(s).count() for s in sinks)
    if landed < sent:
        raise RuntimeError(f"{sent - landed} of {sent} published records were not read")


def end_to_end_job(
    spark: SparkSession,
    data: DataFrame,
    settings: Settings,
    estimator: Pipeline | None = None,
    replay_n: int | None = None,
    last_n: int = LAST_N,
    root: str | None = None,
    clock: Callable[[], str] | None = None,
) -> dict:
    """Prepare -> train -> replay -> stream -> monitor (last ``last_n``).

    Training and replay read the two CSV tables that the preparation wrote."""
    root = root or work_dir(spark, "end-to-end")
    prep = prepare_job(spark, data, settings, f"{root}/data")
    trained = train_job(spark, prep["train"], settings, f"{root}/warehouse",
                        [f"{root}/models/primary", f"{root}/models/fallback"],
                        f"{root}/status/training", estimator, clock)
    replay = replay_record(prep["stream"], settings.features, settings.label)
    results = predict_job(spark, [trained["model_path"]], replay, settings, f"{root}/stream",
                          f"{root}/status/prediction", n=replay_n, clock=clock)
    return {
        "prepare": prep,
        "train": trained,
        "results": results,
        "monitor": monitor_series(results, last_n),
    }
