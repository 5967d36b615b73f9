"""Time the headline operators on the driver's tables.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and
prints one JSON line. Inputs (the joined feature table, the request table, the
replay records) are stored first and the scoring model is fitted first, both
untimed and reported apart, so that a time is that of its operator alone. Each
operator runs to completion (``noop`` sink or its own sink) three times, or
until ``BUDGET_S`` is spent, and counts with its median.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tabrail.config import FOREST_PARTITIONS, FOREST_STATS_MB, LAST_N, get_session, work_dir  # noqa: E402
from tabrail.functions import columns as C  # noqa: E402
from tabrail.functions import rules as R  # noqa: E402
from tabrail.operators import forest as M  # noqa: E402
from tabrail.operators import metrics as MT  # noqa: E402
from tabrail.operators.exact_tree import fit_exact_tree  # noqa: E402
from tabrail.operators.split import bernoulli_split, exact_split  # noqa: E402
from tabrail.plans import fixtures as fx  # noqa: E402
from tabrail.plans import jobs as J  # noqa: E402
from tabrail.streaming import replay as RP  # noqa: E402
from tabrail.streaming import score as ST  # noqa: E402

RUNS, BUDGET_S = 3, 45.0
FEATS = list(fx.CHARGE_FEATURES)


def done(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        f"local[{cpus}]",
        app="tabrail-bench",
        **{
            "spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2)),
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        },
    )
    store = tempfile.mkdtemp(prefix="tabrail-bench-")
    t0 = time.perf_counter()

    def stored(df, name):
        df.write.parquet(f"{store}/{name}")
        return spark.read.parquet(f"{store}/{name}")

    charge = stored(fx.charge(spark, sf_dir), "charge")
    requests = stored(fx.requests(spark, sf_dir), "requests")
    ticks = stored(fx.ticks(spark, sf_dir), "ticks")
    results = C.prediction_error(ticks)
    prep = exact_split(charge, ["row_key"], 0.2, 42)
    replay = stored(C.replay_record(prep.where("part = 'test'"), FEATS, "target"), "replay")
    prep_train = prep.where("part = 'train'").drop("part", "id")
    train = bernoulli_split(prep_train, ["row_key"], 0.8, 42)
    model_rows = stored(train, "train")
    input_s = time.perf_counter() - t0
    t0 = time.perf_counter()
    stump = M.fit(M.stump_estimator(fx.STUMP_FEATURES), model_rows.where("part = 'train'"), ["row_key"])
    fit_s = time.perf_counter() - t0

    def forest_fit():
        model = M.fit(M.forest_estimator(FEATS, "target"), model_rows.where("part = 'train'").drop("part"), ["row_key"])
        done(M.score(model, model_rows.where("part = 'test'"), keep=["row_key", "target"]))

    def stream_score():
        root = work_dir(spark, "bench-stream")
        RP.replay_publish(replay, f"{root}/input", dense=True)
        out, _ = ST.score_stream(ST.stream_source(spark, "text", f"{root}/input"), stump, FEATS)
        ST.start_sink(out, f"{root}/output", f"{root}/ckpt").awaitTermination()

    runs = {
        # Describe, exact split, both CSV parts, report.
        "prepare_job": lambda: done(J.prepare_job(spark, charge, fx.CHARGE, work_dir(spark, "bench-prepare"))["report"]),
        # 100 trees, depth 10, on the 80 % of 80 % rows; the rest scored.
        "forest_fit": forest_fit,
        # Split, fit of one split, scores, one-pass report.
        "evaluate_model": lambda: done(M.evaluate(M.stump_estimator(fx.STUMP_FEATURES), model_rows.drop("part"), ["row_key"])[2]),
        # Exact split search over all values of 8 features.
        "tree_fit_exact": lambda: fit_exact_tree(model_rows, FEATS, "target", 1),
        "request_parse": lambda: done(R.request_parse(requests, FEATS)),
        # Parse, validate, score, format every request.
        "score_requests": lambda: done(R.score_requests(requests, stump, FEATS)),
        # Records as files, stream, model, JSON sink.
        "stream_score": stream_score,
        "rolling_last_n_metrics": lambda: done(MT.rolling_metrics(results, LAST_N, "id", block_rows=4096)),
        "describe": lambda: done(MT.describe(charge, [*FEATS, "target"])),
        "exact_split": lambda: done(exact_split(charge, ["row_key"], 0.2, 42, position=None)),
        "regression_report": lambda: done(MT.regression_report(ticks, "actual_price", "prediction")),
    }
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(runs)
    # Untimed warm-up (JVM, code generation, file cache).
    done(charge.agg(*[F.sum(c) for c in FEATS]))
    times, each = {}, {}
    for name in only:
        taken: list[float] = []
        while len(taken) < RUNS and sum(taken) < BUDGET_S:
            t0 = time.perf_counter()
            runs[name]()
            taken.append(round(time.perf_counter() - t0, 3))
        times[name], each[name] = round(statistics.median(taken), 3), taken
        print(f"{name}: {taken} s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "runs": each,
        "untimed": {"inputs": round(input_s, 3), "model": round(fit_s, 3)},
        "forest": {"stats_mb": FOREST_STATS_MB, "partitions": FOREST_PARTITIONS},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
