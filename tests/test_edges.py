import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabrail.functions import columns as C
from tabrail.operators import metrics as MT
from tabrail.operators.split import exact_split
from tabrail.streaming import replay as RP
from tabrail.streaming import score as ST
from tabrail.config import work_dir

RES = "id long, actual_price double, predicted_price double, error double, error_percentage double"


def _results(spark, n):
    rows = [(i, 1.0 + i, 1.5 + i, 0.5 * (1 if i % 2 else -1), 1.0) for i in range(n)]
    return spark.createDataFrame(rows, RES)


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6])
def test_last_n_sizes(spark, n):
    N = 5
    res = _results(spark, n)
    series = MT.monitor_series(res, N).orderBy("sample_index").collect()
    assert len(series) == min(n, N)
    assert [r.id for r in series] == list(range(max(0, n - N), n))
    live = MT.live_metrics(res, N).collect()
    assert len(live) == (1 if n else 0)
    if n:
        assert live[0].samples == min(n, N)
        assert live[0].mae_k == pytest.approx(50.0)
    roll = MT.rolling_metrics(res, N, block_rows=2).orderBy("id").collect()
    assert [r.samples for r in roll] == [min(i + 1, N) for i in range(n)]


def test_exact_split_empty_and_one_row(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert exact_split(empty, ["k"]).count() == 0
    one = spark.createDataFrame([("a", 1.0)], "k string, v double")
    r = exact_split(one, ["k"]).collect()
    assert len(r) == 1 and r[0].part == "test" and r[0].id == 0


def test_describe_ignores_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,), (2.0,)], "x double")
    r = MT.describe(df, ["x"]).first()
    exp = pd.Series([1.0, 3.0, 2.0]).describe()
    assert r["count"] == 3 and r.mean == pytest.approx(2.0) and r.p25 == pytest.approx(exp["25%"])
    assert r.std == pytest.approx(exp["std"])


def test_null_actual_price(spark):
    df = spark.createDataFrame([(1, None, 2.0)], "id long, actual_price double, prediction double")
    r = C.prediction_error(df).first()
    assert r.error is None and r.error_percentage is None


def test_memory_tap_on_small_input(spark):
    root = work_dir(spark, "test-tap")
    rows = spark.createDataFrame([(i, 1.0 * i, 2.0 * i) for i in range(1, 6)],
                                 "id long, actual_price double, prediction double")
    RP.replay_publish(rows, f"{root}/in")
    dec = C.json_decode(ST.stream_source(spark, "text", f"{root}/in"),
                        "id bigint, actual_price double, prediction double")
    main, tap = ST.fan_out(C.prediction_error(dec), f"{root}/out", root, spark, tap_name="tap_small")
    tap.awaitTermination()
    assert spark.table("tap_small").count() == 5


def test_fan_out_with_processing_time_trigger(spark):
    root = work_dir(spark, "test-fan-pt")
    rows = spark.createDataFrame([(i, 1.0 * i, 2.0 * i) for i in range(1, 4)],
                                 "id long, actual_price double, prediction double")
    RP.replay_publish(rows, f"{root}/in")
    dec = C.json_decode(ST.stream_source(spark, "text", f"{root}/in"),
                        "id bigint, actual_price double, prediction double")
    main, tap = ST.fan_out(C.prediction_error(dec), f"{root}/out", root, spark,
                           trigger={"processingTime": "1 second"}, tap_path=f"{root}/tap")
    tap.processAllAvailable()
    out = ST.bounded_run([main, tap], timeout_s=1, poll_s=0.5)
    assert spark.read.parquet(f"{root}/tap").count() == 3


def test_exact_split_counts_on_repeated_and_null_keys(spark):
    from tabrail.operators.split import exact_split

    df = spark.createDataFrame([(i // 10, float(i)) for i in range(100)], "k long, x double")
    for f, n in ((0.25, 25), (0.2, 20), (1.0, 100), (0.0, 0)):
        out = exact_split(df, ["k"], test_fraction=f)
        assert out.where("part = 'test'").count() == n and out.count() == 100
    nulls = spark.createDataFrame([(None, "a"), ("a", None), (None, None), ("a", "a"), (None, "a")], "k string, l string")
    for f, n in ((0.8, 4), (0.4, 2), (0.6, 3)):
        assert exact_split(nulls, ["k", "l"], test_fraction=f).where("part = 'test'").count() == n


def test_one_feature_null_labels_and_byte_columns(spark):
    from tabrail.functions import rules as R
    from tabrail.operators import metrics as MT
    from tabrail.streaming import score as ST

    req = spark.createDataFrame([("1", '{"a": 5}'), ("2", '{"a": "5d"}'), ("3", '{"a": "1_000"}'), ("4", "{}"), ("5", '{"a": " 7e1 "}'), ("6", '{"a": "1__0"}')],
                                "request_id string, body string")
    got = {r.request_id: (r.status, r.a) for r in R.request_validate(R.request_parse(req, ["a"]), ["a"]).collect()}
    assert got["1"] == (R.OK, 5.0) and got["3"] == (R.OK, 1000.0) and got["5"] == (R.OK, 70.0)
    assert got["2"][0] == got["4"][0] == got["6"][0] == 400
    rows = spark.createDataFrame([(1.0, 1.1), (2.0, 1.9), (None, 5.0), (4.0, 3.5)], "target double, prediction double")
    rep = MT.regression_report(rows).first()
    mean = 7 / 3
    assert rep.n == 3 and abs(rep.r2 - (1 - 0.27 / sum((x - mean) ** 2 for x in (1, 2, 4)))) < 1e-9
    assert [r.column for r in MT.describe(spark.createDataFrame([(1, 2.0)], "b byte, d double")).collect()] == ["b", "d"]
    rec = spark.createDataFrame([(None, 1.0, None, "x"), (1, None, 2.0, "y")], "id int, a double, actual_price double, value string")
    good, bad = ST.quarantine(rec, ["a"])
    assert good.count() == 1 and bad.count() == 1


def test_forest_repeats_under_other_shuffle_partitions(spark):
    from tabrail.operators import forest as M

    df = spark.range(400).selectExpr("id", "cast(id % 17 as double) a", "cast(id % 29 as double) b", "cast((id * 7) % 31 as double) target")
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("3", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            model = M.fit(M.forest_estimator(["a", "b"], num_trees=8, max_depth=4), df, ["id"])
            seen.append([r.prediction for r in M.score(model, df).orderBy("id").collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]


def test_constant_label_report_keeps_its_schema(spark):
    from tabrail.operators import metrics as MT

    report = MT.regression_report(spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "target double, prediction double"))
    again = spark.createDataFrame([report.first()], report.schema)
    assert again.columns == ["rmse", "mae", "r2", "n"] and again.first().r2 is None


def test_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    import pytest

    from tabrail import config

    session = SimpleNamespace(sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None), conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(ValueError):
        config._ensure_checkpoint_dir(session)
