"""One callable per operator of the inventory: ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (through the fixture frames) and runs
over all of their rows. Columns that come from sums of doubles (means, model
predictions) are rounded to 6 decimals (``_round``); all others are returned
as computed.
"""

from __future__ import annotations

import datetime as _dt
import itertools
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrail.config import LAST_N, stored, work_dir
from tabrail.functions import columns as C
from tabrail.functions import rules as R
from tabrail.operators import forest as M
from tabrail.operators import metrics as MT
from tabrail.operators import split as S
from tabrail.operators.exact_tree import fit_exact_tree
from tabrail.operators.positions import with_position
from tabrail.plans import fixtures as fx
from tabrail.plans import jobs as J
from tabrail.sinks import tables as SK
from tabrail.sources import models as SM
from tabrail.sources import tables as SRC
from tabrail.streaming import replay as RP
from tabrail.streaming import score as ST
from tabrail.streaming.monitor import LiveTop

FEATS = list(fx.CHARGE_FEATURES)
KEY = ["row_key"]
REPLAY_N = 200  # rows the reference's replay step sends in its scheduled run


def _round(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Round the named columns: values of sums, whose last bits depend on the
    order of addition. All other columns are returned as they are."""
    return df.withColumns({c: F.round(c, digits) for c in cols})


REPORT = ("rmse", "mae", "r2")
SCORES = ("predicted_price", "error", "error_percentage")


def _clock() -> Callable[[], str]:
    """Fixed, advancing timestamps for status events (checkable output)."""
    ticks = itertools.count()
    base = _dt.datetime(2024, 1, 1)
    return lambda: (base + _dt.timedelta(minutes=next(ticks))).isoformat()


# --- shared frames -----------------------------------------------------------

class _Prepared:
    """The joined rows of one query, stored once, and their exact split: the
    cutoff is searched once, and the split, the replay, the model's rows and
    its fit scan the stored rows. ``cols`` are the columns the query needs."""

    def __init__(self, spark, sf, cols=None):
        charge = fx.charge(spark, sf)
        self.spark = spark
        self.rows = stored(charge.select(*cols) if cols else charge, "charge")
        self.split = S.exact_split(self.rows, KEY, 0.2, 42, position=None)

    def part(self, name):
        return self.split.where(F.col("part") == name).drop("part")

    def stream_part(self):
        """The test part with its replay ids (numbered in hash order)."""
        return S.test_positions(self.split, KEY).drop("part")

    def replay(self):
        return C.replay_record(self.stream_part(), FEATS, "target")

    def train_rows(self):
        """The reference's model rows: the 80 % of the 80 % (S1 train, S2 train)."""
        return S.bernoulli_split(self.part("train"), KEY, 0.8, 42)

    def fit(self, estimator) -> PipelineModel:
        return M.fit(estimator, self.train_rows().where(F.col("part") == "train").drop("part"), KEY)

    def stump(self) -> PipelineModel:
        return self.fit(M.stump_estimator(fx.STUMP_FEATURES))

    def test_rows(self):
        return self.train_rows().where(F.col("part") == "test").drop("part")


def _stump_test(spark, sf):
    prep = _Prepared(spark, sf, [*KEY, *fx.STUMP_FEATURES, "target"])
    return M.score(prep.stump(), prep.test_rows(), keep=["row_key", "target"])


def _results(spark, sf):
    return C.prediction_error(fx.ticks(spark, sf))


def _published(prep, root, rows_per_file=RP.ROWS_PER_FILE):
    """Replay records published as ordered files; the path of the source."""
    return RP.replay_publish(prep.replay(), f"{root}/input", rows_per_file, dense=True)


def _score_files(prep, root, model=None, **source):
    """The published files, scored by a stream that has yet to start."""
    raw = ST.stream_source(prep.spark, "text", f"{root}/input", **source)
    return ST.score_stream(raw, model or prep.stump(), FEATS)


def _scored_results(spark, path):
    return _round(SRC.read_results(spark, path), *SCORES)


# --- A: sources ----------------------------------------------------------------

def csv_scan(spark, sf):
    path = SK.write_csv(SRC.feature_table(fx.charge(spark, sf), FEATS, "target"), work_dir(spark, "csv"))
    schema = ", ".join(f"{c} double" for c in [*FEATS, "target"])
    return SRC.read_table(spark, path, schema=schema)


def feature_table(spark, sf):
    return SRC.feature_table(fx.charge(spark, sf), FEATS, "target")


def stream_source(spark, sf):
    root = work_dir(spark, "source")
    _published(_Prepared(spark, sf), root)
    raw = ST.stream_source(spark, "text", f"{root}/input")
    ST.start_sink(raw, f"{root}/landed", f"{root}/ckpt", fmt="parquet").awaitTermination()
    return C.json_decode(spark.read.parquet(f"{root}/landed"), C.stream_record_schema(FEATS))


def replay_scan(spark, sf):
    path = SK.write_csv(_Prepared(spark, sf).stream_part().drop("row_key"), work_dir(spark, "replay-csv"))
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in FEATS]
                          + [T.StructField("target", T.DoubleType()), T.StructField("id", T.LongType())])
    return SRC.replay_scan(SRC.read_table(spark, path, schema=schema), REPLAY_N, ["id"])


def rows_to_frame(spark, sf):
    text = fx.charge(spark, sf).select("row_key", *[F.col(c).cast("string").alias(c) for c in FEATS])
    return SRC.frame_from_fields(text, FEATS, keep=["row_key"])


def results_reader(spark, sf):
    root, prep = work_dir(spark, "results"), _Prepared(spark, sf)
    _published(prep, root)
    results, _ = _score_files(prep, root)
    ST.start_sink(results, f"{root}/output", f"{root}/ckpt").awaitTermination()
    # The monitor side: read the result sink as a stream into a table.
    ST.start_sink(ST.stream_results(spark, f"{root}/output"), f"{root}/monitor", f"{root}/ckpt-reader",
                  fmt="parquet").awaitTermination()
    return _round(spark.read.parquet(f"{root}/monitor"), *SCORES)


def csv_bad_lines(spark, sf):
    """A1 on a damaged file: the lines that do not fit the schema."""
    good = _Prepared(spark, sf).replay().select("id", "l_quantity", "actual_price")
    cells = [F.col(c).cast("string") for c in good.columns]
    line = F.concat_ws(",", *cells)
    # Text in a number, a line that ends early, a field too many.
    bad = (F.when(F.col("id") % 97 == 0, F.concat_ws(",", cells[0], F.lit("abc"), cells[2]))
           .when(F.col("id") % 101 == 0, cells[0])
           .when(F.col("id") % 103 == 0, F.concat_ws(",", *cells, F.lit("9")))
           .otherwise(line))
    path = f"{work_dir(spark, 'csv-bad')}/lines"
    good.select(bad.alias("value")).write.text(path)
    found = SRC.bad_lines(spark, path, "id bigint, l_quantity double, actual_price double", header=False)
    fields = F.size(F.split("line", ","))
    fault = F.when(fields == 1, F.lit("short")).when(fields > 3, F.lit("long")).otherwise(F.lit("text"))
    return found.select("id", "l_quantity", "actual_price", fault.alias("fault"))


def model_load(spark, sf):
    root, prep = work_dir(spark, "model-load"), _Prepared(spark, sf)
    saved = SM.save_model(prep.stump(), [f"{root}/primary"])
    model, _ = SM.load_model([f"{root}/missing", saved])
    return _round(M.predict_frame(model, prep.replay(), "id"), "prediction")


# --- B: sinks --------------------------------------------------------------------

_SPLIT_SCHEMA = "row_key string, " + ", ".join(f"{c} double" for c in FEATS) + ", target double"


def csv_write(spark, sf):
    root, prep = work_dir(spark, "csv-write"), _Prepared(spark, sf)
    SK.write_csv(prep.part("train"), f"{root}/train_data")
    SK.write_csv(prep.part("test"), f"{root}/streaming_data")
    back = [SRC.read_table(spark, f"{root}/{n}", schema=_SPLIT_SCHEMA).withColumn("part", F.lit(p))
            for n, p in (("train_data", "train"), ("streaming_data", "test"))]
    return back[0].unionByName(back[1])


def publish_table(spark, sf):
    root = work_dir(spark, "warehouse")
    split = _Prepared(spark, sf).split
    paths = SK.publish_tables({"train_data": split.where("part = 'train'"),
                               "streaming_data": split.where("part = 'test'")}, root)
    back = [spark.read.parquet(p).select(F.lit(n).alias("table_name"), "row_key", "target")
            for n, p in paths.items()]
    return back[0].unionByName(back[1])


def materialize_if_absent(spark, sf):
    path = f"{work_dir(spark, 'prepared')}/table"
    split = _Prepared(spark, sf).split
    SK.materialize_if_absent(spark, lambda: split.where("part = 'test'").select("row_key", "target"), path)
    SK.materialize_if_absent(spark, lambda: split.where("part = 'train'").select("row_key", "target"), path)
    return spark.read.parquet(path)


_TICK = "id bigint, actual_price double, prediction double"


def _ticks_stream(spark, sf, root):
    RP.replay_publish(fx.ticks(spark, sf).select("id", "actual_price", "prediction"), f"{root}/input")
    return C.json_decode(ST.stream_source(spark, "text", f"{root}/input"), T._parse_datatype_string(_TICK))


def stream_json_sink(spark, sf):
    root = work_dir(spark, "json-sink")
    ST.start_sink(C.prediction_error(_ticks_stream(spark, sf, root)), f"{root}/output", f"{root}/ckpt").awaitTermination()
    return SRC.read_results(spark, f"{root}/output")


def stream_debug_tap(spark, sf):
    root = work_dir(spark, "tap")
    # The tap's console/memory forms gather rows in the driver; over whole
    # tables the tap lands in a Parquet table instead (same append query).
    ST.start_sink(C.prediction_error(_ticks_stream(spark, sf, root)), f"{root}/tap", f"{root}/ckpt", fmt="parquet").awaitTermination()
    return spark.read.parquet(f"{root}/tap")


def model_save(spark, sf):
    root, prep = work_dir(spark, "model-save"), _Prepared(spark, sf)
    # The primary location is on a file system that is not there, so the
    # save falls back to the second location, as the reference falls back
    # to a local folder when its cluster store fails.
    fallback = f"{root}/fallback"
    saved = SM.save_model(prep.stump(), ["unreachablefs://primary/model", fallback])
    if saved != fallback:
        raise RuntimeError(f"expected the fallback location, saved to {saved}")
    model, _ = SM.load_model([saved])
    return _round(M.predict_frame(model, prep.replay(), "id"), "prediction")


def replay_publish(spark, sf):
    """The published records with the place of their file among all files
    in the order that a source takes them."""
    root = work_dir(spark, "replay")
    _published(_Prepared(spark, sf), root, rows_per_file=1000)
    raw = ST.stream_source(spark, "text", f"{root}/input", with_file=True)
    ST.start_sink(raw, f"{root}/landed", f"{root}/ckpt", fmt="parquet").awaitTermination()
    landed = spark.read.parquet(f"{root}/landed").select("value", RP.block_of()[1].cast("long").alias("block"))
    return C.json_decode(landed, C.stream_record_schema(FEATS), keep=("block",))


def run_status_log(spark, sf):
    root = work_dir(spark, "status")
    with SK.run_status(spark, f"{root}/log", "prediction", clock=_clock()) as status:
        SK.publish_tables({"streaming_data": status.counted(_Prepared(spark, sf).replay())}, f"{root}/warehouse")
    return SK.read_status(spark, f"{root}/log")


# --- C: projections -------------------------------------------------------------

def feature_columns(spark, sf):
    df = fx.charge(spark, sf)
    return df.select("row_key", *C.feature_columns(df, "target", exclude=KEY))


def assemble_vector(spark, sf):
    df = C.assemble_vector(fx.charge(spark, sf), FEATS)
    return C.vector_columns(df, "features", [f"f{i}" for i in range(len(FEATS))], keep=KEY)


def json_decode(spark, sf):
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in FEATS])
    return C.json_decode(fx.requests(spark, sf), schema, value="body", keep=["request_id"])


def json_encode(spark, sf):
    return C.json_encode(_results(spark, sf), keep=()).select(
        F.get_json_object("value", "$.id").cast("bigint").alias("id"), "value")


def replay_record(spark, sf):
    return _Prepared(spark, sf).replay()


def prediction_error(spark, sf):
    return _results(spark, sf)


def unit_convert(spark, sf):
    return C.unit_convert(_results(spark, sf))


def price_format(spark, sf):
    return fx.ticks(spark, sf).select("id", *C.price_format("prediction"))


def result_line(spark, sf):
    return C.result_line(_results(spark, sf))


def replay_progress_line(spark, sf):
    replay = _Prepared(spark, sf).replay()
    total = replay.count()
    return C.replay_progress_line(replay, total, FEATS[0])


def schema_report(spark, sf):
    """C11 on the written CSV: its types are inferred from the file."""
    path = SK.write_csv(fx.charge(spark, sf), work_dir(spark, "schema-csv"))
    back = SRC.read_table(spark, path)
    return C.schema_report(spark, back, counts=True)


# --- D: request rules -------------------------------------------------------------

def request_parse(spark, sf):
    return R.request_parse(fx.requests(spark, sf), FEATS)


def request_forms(spark, sf):
    """D1, D2 on requests of several content types."""
    parsed = R.request_parse(fx.mixed_requests(spark, sf), FEATS, content_type="content_type")
    return R.request_validate(parsed, FEATS)


def request_validate(spark, sf):
    checked = R.request_validate(R.request_parse(fx.requests(spark, sf), FEATS), FEATS)
    return checked.select("request_id", "status", "reason", "valid")


def request_form_rules(spark, sf):
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in FEATS])
    decoded = C.json_decode(fx.requests(spark, sf), schema, value="body", keep=["request_id"])
    return R.request_form_rules(decoded, FEATS).select("request_id", "missing", "negative", "violations")


# --- S, E: splits and limits --------------------------------------------------------

def exact_split(spark, sf):
    charge = stored(fx.charge(spark, sf), "charge")
    return S.exact_split(charge, KEY, 0.2, 42, position="id").select("row_key", "id", "part")


def bernoulli_split(spark, sf):
    return S.bernoulli_split(fx.charge(spark, sf), KEY, 0.8, 42).select("row_key", "part")


def head_n(spark, sf):
    return S.head_n(fx.ticks(spark, sf), REPLAY_N, ["ts", "id"]).select("id", "actual_price", "prediction")


def sample_rows(spark, sf):
    return _round(S.sample_rows(_stump_test(spark, sf), ["target", "prediction"], ["row_key"], 10), "prediction")


def last_n(spark, sf):
    return S.last_n(_results(spark, sf), LAST_N, "id")


# --- F: aggregations ----------------------------------------------------------------

def row_counts(spark, sf):
    prep = _Prepared(spark, sf, KEY)
    whole = MT.row_counts(prep.split).select(F.lit("prepare").alias("scope"), "*")
    train = MT.row_counts(prep.train_rows()).select(F.lit("train").alias("scope"), "*")
    return whole.unionByName(train)


def describe(spark, sf):
    # One digit more: means of amounts in cents end in a five at the seventh.
    cols = [*FEATS, "target"]
    return _round(MT.describe(stored(fx.charge(spark, sf).select(*cols), "charge"), cols), "mean", "std", "p25", "p50", "p75", digits=7)


def rmse(spark, sf):
    return _round(MT.rmse(fx.ticks(spark, sf), "actual_price", "prediction"), "rmse")


def mae(spark, sf):
    return _round(MT.mae(fx.ticks(spark, sf), "actual_price", "prediction"), "mae")


def r2(spark, sf):
    return _round(MT.r2(fx.ticks(spark, sf), "actual_price", "prediction"), "r2")


def regression_report(spark, sf):
    return _round(MT.regression_report(fx.ticks(spark, sf), "actual_price", "prediction"), *REPORT)


def live_metrics(spark, sf):
    return _round(MT.live_metrics(_results(spark, sf), LAST_N, "id"), "mae_k", "rmse_k")


def dataset_report(spark, sf):
    return J.dataset_report(spark, FEATS, "target", MT.row_counts(_Prepared(spark, sf, KEY).split))


# --- M: model -------------------------------------------------------------------------

def forest_fit(spark, sf):
    prep = _Prepared(spark, sf)
    model = prep.fit(M.forest_estimator(FEATS, "target"))
    return _round(M.score(model, prep.test_rows(), keep=["row_key", "target"]), "prediction")


def forest_fit_depth3(spark, sf):
    """M1 unsampled: one tree of depth 3 on all rows, every test row scored."""
    prep = _Prepared(spark, sf, [*KEY, *fx.STUMP_FEATURES, "target"])
    est = M.forest_estimator(fx.STUMP_FEATURES, "target", num_trees=1, max_depth=3, bootstrap=False,
                             featureSubsetStrategy="all", maxBins=64)
    return _round(M.score(prep.fit(est), prep.test_rows(), keep=["row_key", "target"]), "prediction")


def forest_fit_checks(spark, sf):
    """The forest by what its rows can tell: every test row with its label and
    whether its prediction, a mean of train labels, lies in their range; and
    the forest's trees and depth, the test rows, and whether its error is
    below the labels' spread."""
    prep = _Prepared(spark, sf)
    train = prep.train_rows().where("part = 'train'")
    model = prep.fit(M.forest_estimator(FEATS, "target"))
    trees = model.stages[-1].trees
    low, high = train.agg(F.min("target"), F.max("target")).first()
    scored = stored(M.score(model, prep.test_rows(), keep=["row_key", "target"]), "forest-checks")
    whole = scored.agg(
        F.lit(len(trees)).alias("trees"), F.lit(max(t.depth for t in trees)).alias("depth"),
        F.count(F.lit(1)).alias("rows"), F.round(F.stddev_samp("target"), 6).alias("label_std"),
        (MT.rmse_col("target", "prediction") < F.stddev_samp("target")).alias("below_std"))
    inside = (F.col("prediction") >= F.lit(low) - 1e-9) & (F.col("prediction") <= F.lit(high) + 1e-9)
    return scored.select("row_key", "target", inside.alias("in_label_range")).crossJoin(F.broadcast(whole))


def _exact_tree(spark, sf, depth):
    """The tree and the test rows. Each level is a pass: both parts are stored
    once, so that no pass splits again; train rows need no key by then."""
    rows = _Prepared(spark, sf).train_rows().withColumn("row_key", F.when(F.col("part") == "test", F.col("row_key")))
    rows = stored(rows, "model-rows")
    train, test = (rows.where(F.col("part") == p).drop("part") for p in ("train", "test"))
    return fit_exact_tree(train, FEATS, "target", depth), test


def tree_fit_exact(spark, sf):
    """M2: the best split over every value of all features."""
    tree, _ = _exact_tree(spark, sf, 1)
    root, left, right = (tree.nodes[i] for i in (1, 2, 3))
    return _round(spark.createDataFrame(
        [(root.feature, root.threshold, left.mean, right.mean)],
        "feature string, threshold double, left_prediction double, right_prediction double",
    ), "left_prediction", "right_prediction")


def tree_fit_depth3(spark, sf):
    """M2 to depth 3: every test row scored by the exact tree."""
    tree, test = _exact_tree(spark, sf, 3)
    return _round(tree.transform(test).select("row_key", "target", "prediction"), "prediction")


def model_score(spark, sf):
    return _round(_stump_test(spark, sf), "prediction")


def predict_batch(spark, sf):
    prep = _Prepared(spark, sf)
    return _round(M.predict_frame(prep.stump(), prep.replay(), "id"), "prediction")


def score_requests(spark, sf):
    prep = _Prepared(spark, sf)
    return R.score_requests(fx.requests(spark, sf, prep.rows), prep.stump(), FEATS)


def evaluate_model(spark, sf):
    train = _Prepared(spark, sf, [*KEY, *fx.STUMP_FEATURES, "target"]).train_rows().drop("part")
    _, _, report = M.evaluate(M.stump_estimator(fx.STUMP_FEATURES), train, KEY)
    return _round(report, *REPORT)


# --- H: windows ----------------------------------------------------------------------

def row_position_id(spark, sf):
    return with_position(fx.charge(spark, sf), ["target", "row_key"], name="id").select("row_key", "id")


def sample_index(spark, sf):
    return MT.monitor_series(_results(spark, sf), LAST_N).select("sample_index", "id")


def rolling_last_n_metrics(spark, sf):
    return _round(MT.rolling_metrics(_results(spark, sf), LAST_N, "id", block_rows=4096), "mae_k", "rmse_k")


def monitor_series(spark, sf):
    return MT.monitor_series(_results(spark, sf), LAST_N)


# --- J: streaming -----------------------------------------------------------------------

def stream_score(spark, sf):
    """Scored results and, from the same run, the rejected records."""
    root, prep = work_dir(spark, "stream-score"), _Prepared(spark, sf)
    RP.replay_publish(_faulty_replay(prep), f"{root}/input", dense=True)
    results, rejects = _score_files(prep, root)
    ST.start_sink(results, f"{root}/output", f"{root}/ckpt").awaitTermination()
    ST.start_sink(rejects, f"{root}/rejects", f"{root}/ckpt-rejects", fmt="parquet").awaitTermination()
    none = F.lit(None).cast("double")
    scored = _scored_results(spark, f"{root}/output").withColumn("reason", F.lit(None).cast("string"))
    bad = spark.read.parquet(f"{root}/rejects").select("id", *[none.alias(c) for c in ("actual_price", *SCORES)], "reason")
    return scored.unionByName(bad)


def stream_resume(spark, sf):
    """Half of the files, a failure after the sink has taken the last
    batch and before its commit is logged, then the other half."""
    root, prep = work_dir(spark, "stream-resume"), _Prepared(spark, sf)
    replay = prep.replay()
    halves = [replay.where(F.col("id") % 2 == h) for h in (0, 1)]
    RP.replay_publish(halves[0], f"{root}/input", rows_per_file=1000)
    results, _ = _score_files(prep, root, max_per_trigger=RP.files_per_batch(spark, f"{root}/input", least=2))
    ST.start_sink(results, f"{root}/output", f"{root}/ckpt").awaitTermination()
    ST.forget_commit(spark, f"{root}/ckpt")
    RP.replay_publish(halves[1], f"{root}/input", rows_per_file=1000)
    ST.start_sink(results, f"{root}/output", f"{root}/ckpt").awaitTermination()
    # Same checkpoint again with nothing new: must add no rows.
    ST.start_sink(results, f"{root}/output", f"{root}/ckpt").awaitTermination()
    return _scored_results(spark, f"{root}/output")


def stream_replay(spark, sf):
    """A new checkpoint reads everything again; both outputs, by run."""
    root, prep = work_dir(spark, "stream-replay"), _Prepared(spark, sf)
    _published(prep, root)
    results, _ = _score_files(prep, root)
    for run in (1, 2):
        ST.start_sink(results, f"{root}/output{run}", f"{root}/ckpt{run}").awaitTermination()
    both = [_scored_results(spark, f"{root}/output{run}").withColumn("run", F.lit(run)) for run in (1, 2)]
    return both[0].unionByName(both[1])


def stream_fan_out(spark, sf):
    """What the tap and the sink hold, by consumer."""
    root, prep = work_dir(spark, "fan-out"), _Prepared(spark, sf)
    _published(prep, root)
    results, _ = _score_files(prep, root)
    main, tap = ST.fan_out(results, f"{root}/output", root, spark, tap_path=f"{root}/tap")
    tap.awaitTermination()
    held = {"sink": SRC.read_results(spark, f"{root}/output"), "tap": spark.read.parquet(f"{root}/tap")}
    both = [_round(df, *SCORES).withColumn("consumer", F.lit(name)) for name, df in held.items()]
    return both[0].unionByName(both[1])


def bounded_run(spark, sf):
    """A paced run that its limit ends with files left, then the rest in
    a number of batches that does not follow the number of files."""
    root, prep = work_dir(spark, "bounded"), _Prepared(spark, sf)
    _published(prep, root, rows_per_file=1000)
    files, trigger = RP.pace(1000, 1, rows_per_file=1000)
    model = prep.stump()
    results, _ = _score_files(prep, root, model, max_per_trigger=files)
    log = ST.ProgressLog()
    spark.streams.addListener(log)
    try:
        query = ST.start_sink(results, f"{root}/output", f"{root}/ckpt", trigger=trigger)
        ended = ST.bounded_run([query], timeout_s=300, poll_s=0.1, max_batches=1, log=log)
    finally:
        spark.streams.removeListener(log)
    first = SRC.read_results(spark, f"{root}/output").count()
    rest, _ = _score_files(prep, root, model, max_per_trigger=RP.files_per_batch(spark, f"{root}/input"))
    ST.start_sink(rest, f"{root}/output", f"{root}/ckpt").awaitTermination()
    whole = _scored_results(spark, f"{root}/output")
    return whole.withColumns({"ended": F.lit(ended["ended"]), "first_run_had_rows": F.lit(first >= 1000)})


def _faulty_replay(prep):
    """Replay records with faults keyed on id: every 97th lacks its first
    feature, every 101st its second, every 103rd its price."""
    gap = {FEATS[0]: 97, FEATS[1]: 101, "actual_price": 103}
    return prep.replay().withColumns({c: F.when(F.col("id") % n != 0, F.col(c)) for c, n in gap.items()})


def _faulty_replay_text(prep):
    """Replay records as JSON with faults keyed on id: every 97th lacks its
    first feature, every 101st has text in its second, every 103rd is not
    JSON at all, every 107th has no price, every 109th no id."""
    rec = C.json_encode(prep.replay(), carry=("id",))
    first, second = FEATS[0], FEATS[1]
    value = F.col("value")
    for n, field, text in ((97, first, ""), (101, second, f'"{second}":"n/a",'), (109, "id", '"id":null,')):
        value = F.when(F.col("id") % n == 0, F.regexp_replace(value, f'"{field}":[^,]*,', text)).otherwise(value)
    value = F.when(F.col("id") % 107 == 0, F.regexp_replace(value, '"actual_price":[^}]*', '"actual_price":null')).otherwise(value)
    value = F.when(F.col("id") % 103 == 0, F.lit("not json")).otherwise(value)
    return rec.select("id", value.alias("value"))


def stream_decode_quarantine(spark, sf):
    """One streaming query, one sink parted by outcome; ``rows_read`` is
    the query's own count of input rows."""
    root, prep = work_dir(spark, "quarantine"), _Prepared(spark, sf)
    _faulty_replay_text(prep).select("value").write.text(f"{root}/input")
    raw = ST.stream_source(spark, "text", f"{root}/input")
    routed = ST.score_or_quarantine(raw, prep.stump(), FEATS)
    query = ST.start_sink(routed, f"{root}/routed", f"{root}/ckpt", fmt="parquet", partition_by=["outcome"])
    query.awaitTermination()
    read = sum(p.numInputRows for p in query.recentProgress)
    out = _round(spark.read.parquet(f"{root}/routed"), *SCORES)
    return out.drop("value").withColumn("rows_read", F.lit(read).cast("long"))


def data_loss_tolerance(spark, sf):
    """A file of the replay is lost after the source has listed it and
    before a batch has read it; the survivors, and how many records the
    manifest says are missing."""
    root = work_dir(spark, "data-loss")
    path = _published(_Prepared(spark, sf), root, rows_per_file=500)
    raw = ST.stream_source(spark, "text", path, max_per_trigger=RP.files_per_batch(spark, path), with_file=True)

    def land(batch, batch_id):
        if batch_id == 0:
            RP.lose_block(spark, path, 2)
        batch.write.mode("overwrite").parquet(f"{root}/landed/batch={batch_id}")

    raw.writeStream.foreachBatch(land).option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start().awaitTermination()
    landed = spark.read.parquet(f"{root}/landed").drop("batch")
    lost = RP.loss_report(landed, path).agg(F.sum("lost")).first()[0]
    return C.json_decode(landed, C.stream_record_schema(FEATS)).withColumn("lost", F.lit(lost).cast("long"))


def live_metrics_stream(spark, sf):
    """F7 on a running stream: the metrics after every file of 1000 results,
    many of them a batch; the last batch runs again after a failure."""
    root = work_dir(spark, "live")
    RP.replay_publish(fx.ticks(spark, sf).select("id", "actual_price", "prediction"), f"{root}/input", rows_per_file=1000)
    raw = ST.stream_source(spark, "text", f"{root}/input", max_per_trigger=RP.files_per_batch(spark, f"{root}/input"), with_file=True)
    ticks = C.json_decode(raw, T._parse_datatype_string(_TICK), keep=("file",))
    results = C.prediction_error(ticks, keep=(RP.block_of()[1].cast("long").alias("block"),))
    top = LiveTop(spark, f"{root}/live", LAST_N, block="block")
    top.start(results, f"{root}/ckpt").awaitTermination()
    ST.forget_commit(spark, f"{root}/ckpt")
    top.start(results, f"{root}/ckpt").awaitTermination()
    return _round(top.metrics(), "mae_k", "rmse_k")


# --- P: jobs -----------------------------------------------------------------------------

def prepare_job(spark, sf):
    out = J.prepare_job(spark, fx.charge(spark, sf), fx.CHARGE, work_dir(spark, "prepare"))
    return out["report"]


def train_job(spark, sf):
    root = work_dir(spark, "train-job")
    out = J.train_job(spark, _Prepared(spark, sf).part("train"), fx.CHARGE, f"{root}/warehouse",
                      [f"{root}/models/primary", f"{root}/models/fallback"], f"{root}/status",
                      clock=_clock())
    return _round(out["report"], *REPORT)


def train_job_single_split(spark, sf):
    """P2 with the estimator that SQL can derive."""
    root = work_dir(spark, "train-job")
    out = J.train_job(spark, _Prepared(spark, sf).part("train"), fx.CHARGE, f"{root}/warehouse", [f"{root}/models/primary"], f"{root}/status",
                      estimator=M.stump_estimator(fx.STUMP_FEATURES), clock=_clock())
    return _round(out["report"], *REPORT)


def end_to_end_single_split(spark, sf):
    """P4 with the estimator that SQL can derive."""
    out = J.end_to_end_job(spark, fx.charge(spark, sf), fx.CHARGE, replay_n=None, clock=_clock(),
                           estimator=M.stump_estimator(fx.STUMP_FEATURES))
    return _round(out["monitor"], "predicted_k", "abs_error_k")


def predict_job(spark, sf):
    root, prep = work_dir(spark, "predict-job"), _Prepared(spark, sf)
    path = SM.save_model(prep.stump(), [f"{root}/model"])
    res = J.predict_job(spark, [f"{root}/missing", path], prep.replay(), fx.CHARGE,
                        f"{root}/run", f"{root}/status", n=None, clock=_clock())
    return _round(res, *SCORES)


def end_to_end_job(spark, sf):
    out = J.end_to_end_job(spark, fx.charge(spark, sf), fx.CHARGE, replay_n=None, clock=_clock())
    return _round(out["monitor"], "predicted_k", "abs_error_k")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # A sources
    "csv_scan": csv_scan, "feature_table": feature_table, "stream_source": stream_source,
    "replay_scan": replay_scan, "rows_to_frame": rows_to_frame, "results_reader": results_reader,
    "model_load": model_load, "csv_bad_lines": csv_bad_lines,
    # B sinks
    "csv_write": csv_write, "publish_table": publish_table, "materialize_if_absent": materialize_if_absent,
    "stream_json_sink": stream_json_sink, "stream_debug_tap": stream_debug_tap, "model_save": model_save,
    "replay_publish": replay_publish, "run_status_log": run_status_log,
    # C projections
    "feature_columns": feature_columns, "assemble_vector": assemble_vector, "json_decode": json_decode,
    "json_encode": json_encode, "replay_record": replay_record, "prediction_error": prediction_error,
    "unit_convert": unit_convert, "price_format": price_format, "result_line": result_line,
    "replay_progress_line": replay_progress_line, "schema_report": schema_report,
    # D rules
    "request_parse": request_parse, "request_validate": request_validate,
    "request_form_rules": request_form_rules, "request_forms": request_forms,
    # S, E
    "exact_split": exact_split, "bernoulli_split": bernoulli_split, "head_n": head_n,
    "sample_rows": sample_rows, "last_n": last_n,
    # F
    "row_counts": row_counts, "describe": describe, "rmse": rmse, "mae": mae, "r2": r2,
    "regression_report": regression_report, "live_metrics": live_metrics, "dataset_report": dataset_report,
    "live_metrics_stream": live_metrics_stream,
    # M
    "forest_fit": forest_fit, "tree_fit_exact": tree_fit_exact, "model_score": model_score,
    "predict_batch": predict_batch, "score_requests": score_requests, "evaluate_model": evaluate_model,
    # H
    "row_position_id": row_position_id, "sample_index": sample_index,
    "rolling_last_n_metrics": rolling_last_n_metrics, "monitor_series": monitor_series,
    # J
    "stream_score": stream_score, "stream_resume": stream_resume, "stream_replay": stream_replay,
    "stream_fan_out": stream_fan_out, "bounded_run": bounded_run,
    "stream_decode_quarantine": stream_decode_quarantine, "data_loss_tolerance": data_loss_tolerance,
    # P
    "prepare_job": prepare_job, "train_job": train_job, "predict_job": predict_job,
    "end_to_end_job": end_to_end_job,
    # the forest jobs again, in forms that SQL can check by value
    "forest_fit_checks": forest_fit_checks, "forest_fit_depth3": forest_fit_depth3, "tree_fit_depth3": tree_fit_depth3,
    "train_job_single_split": train_job_single_split,
    "end_to_end_single_split": end_to_end_single_split,
}
