import pandas as pd
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tabrail.operators import metrics as MT
from tabrail.plans import fixtures as fx

from conftest import SF


def test_report_equals_evaluator(spark):
    t = fx.ticks(spark, SF)
    rep = MT.regression_report(t, "actual_price", "prediction").first()
    for name in ("rmse", "mae", "r2"):
        ev = RegressionEvaluator(labelCol="actual_price", predictionCol="prediction", metricName=name)
        assert rep[name] == pytest.approx(ev.evaluate(t), rel=1e-9)


def test_r2_constant_label_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "target double, prediction double")
    assert MT.r2(df).first().r2 is None


def test_describe_matches_pandas(spark):
    c = fx.charge(spark, SF)
    cols = ["l_quantity", "l_discount", "target"]
    got = MT.describe(c, cols).toPandas().set_index("column")
    exp = c.select(*cols).toPandas().describe()
    for col in cols:
        for stat, name in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                           ("25%", "p25"), ("50%", "p50"), ("75%", "p75"), ("max", "max")):
            assert got.loc[col, name] == pytest.approx(exp.loc[stat, col], rel=1e-9, abs=1e-12)


def test_live_metrics_empty_and_small(spark):
    schema = "id long, actual_price double, predicted_price double, error double, error_percentage double"
    assert MT.live_metrics(spark.createDataFrame([], schema), 100).count() == 0
    df = spark.createDataFrame([(1, 1.0, 1.5, 0.5, 50.0), (2, 2.0, 1.0, -1.0, -50.0)], schema)
    r = MT.live_metrics(df, 100).first()
    assert r.samples == 2 and r.mae_k == pytest.approx(75.0) and r.rmse_k == pytest.approx((12500 / 2 * 2) ** 0.5 / 2 ** 0.5 * 1)


def test_monitor_series_index(spark):
    df = MT.monitor_series(fx.ticks(spark, SF).transform(
        lambda d: d.select("id", F.col("actual_price"), F.col("prediction").alias("predicted_price"),
                           (F.col("prediction") - F.col("actual_price")).alias("error"))), 100)
    rows = df.orderBy("sample_index").collect()
    assert [r.sample_index for r in rows] == list(range(len(rows)))
    assert [r.id for r in rows] == sorted(r.id for r in rows)


def test_report_text_four_decimals(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (3.0, 3.25)], "target double, prediction double")
    rep = MT.regression_report(df).first()
    lines = MT.report_text(MT.regression_report(df)).first()
    assert lines.rmse_line == f"RMSE: {rep.rmse:.4f}"
    assert lines.mae_line == f"MAE:  {rep.mae:.4f}"
    assert lines.r2_line == f"R2:   {rep.r2:.4f}"
