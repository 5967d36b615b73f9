import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabrail.functions import columns as C
from tabrail.operators import forest as M
from tabrail.operators.split import bernoulli_split
from tabrail.plans import fixtures as fx
from tabrail.sources.models import ModelNotFound, load_model, save_model
from tabrail.streaming import replay as RP
from tabrail.streaming import score as ST
from tabrail.config import work_dir

from conftest import SF


@pytest.fixture(scope="module")
def train(spark):
    c = bernoulli_split(fx.charge(spark, SF), ["row_key"])
    return c.where("part = 'train'").drop("part").cache()


def _brute_force_stump(pdf, feats):
    best = None
    total_n, total_s = len(pdf), pdf.target.sum()
    for fi, f in enumerate(feats):
        g = pdf.groupby(f).target.agg(["count", "sum"]).sort_index()
        ln = g["count"].cumsum()
        ls = g["sum"].cumsum()
        vals = list(g.index)
        for i in range(len(vals) - 1):
            rn, rs = total_n - ln.iloc[i], total_s - ls.iloc[i]
            score = ls.iloc[i] ** 2 / ln.iloc[i] + rs ** 2 / rn
            if best is None or score > best[0] + 1e-12:
                best = (score, f, (vals[i] + vals[i + 1]) / 2, ls.iloc[i] / ln.iloc[i], rs / rn)
    return best[1:]


def test_stump_equals_brute_force(spark, train):
    model = M.fit(M.stump_estimator(fx.STUMP_FEATURES), train, ["row_key"])
    s = M.stump_summary(model)
    f, thr, left, right = _brute_force_stump(train.toPandas(), fx.STUMP_FEATURES)
    assert s["feature"] == f and s["threshold"] == pytest.approx(thr)
    assert s["left"] == pytest.approx(left, rel=1e-9) and s["right"] == pytest.approx(right, rel=1e-9)


def test_forest_repeat_reload_and_quality(spark, train):
    est = M.forest_estimator(fx.CHARGE_FEATURES, num_trees=10, max_depth=5)
    m1 = M.fit(est, train, ["row_key"])
    m2 = M.fit(est, train.repartition(3), ["row_key"])
    p1 = M.score(m1, train, keep=["row_key"]).withColumnRenamed("prediction", "p1")
    p2 = M.score(m2, train, keep=["row_key"]).withColumnRenamed("prediction", "p2")
    assert p1.join(p2, "row_key").where(F.abs(F.col("p1") - F.col("p2")) > 1e-12).count() == 0
    root = work_dir(spark, "test-model")
    path = save_model(m1, [f"nosuchfs://x/model", f"{root}/m"])
    assert path.endswith("/m")
    m3, used = load_model([f"{root}/missing", path])
    p3 = M.score(m3, train, keep=["row_key"]).withColumnRenamed("prediction", "p3")
    assert p1.join(p3, "row_key").where(F.col("p1") != F.col("p3")).count() == 0
    rmse = M.score(m1, train).agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("target"), 2)))).first()[0]
    std = train.agg(F.stddev("target")).first()[0]
    assert rmse < std
    with pytest.raises(ModelNotFound):
        load_model([f"{root}/none1", f"{root}/none2"])


def test_predict_batch_edge(spark, train):
    model = M.fit(M.stump_estimator(fx.STUMP_FEATURES), train, ["row_key"])
    rows = [{"l_quantity": 1, "l_discount": "0.01", "l_tax": 0.02}, {"l_quantity": 50, "l_discount": 0.1, "l_tax": 0.0}]
    out = M.predict_batch(spark, model, rows, fx.STUMP_FEATURES)
    assert len(out) == 2
    assert M.predict_one(spark, model, fx.STUMP_FEATURES, **rows[1]) == out[1]


def test_stream_equals_batch_resume_and_quarantine(spark, train):
    model = M.fit(M.stump_estimator(fx.STUMP_FEATURES), train, ["row_key"])
    recs = C.replay_record(fx.charge(spark, SF).withColumn("id", F.monotonically_increasing_id()),
                           fx.CHARGE_FEATURES).cache()
    root = work_dir(spark, "test-stream")
    RP.replay_publish(recs, f"{root}/in")
    # A bad record in the middle of a file set.
    spark.createDataFrame([('{"id": 99999999, "l_quantity": "oops"}',), ("garbage",)], "value string") \
        .coalesce(1).write.mode("append").text(f"{root}/in")
    results, bad = ST.score_stream(ST.stream_source(spark, "text", f"{root}/in"), model, fx.CHARGE_FEATURES)
    ST.start_sink(results, f"{root}/out", f"{root}/ck").awaitTermination()
    ST.start_sink(bad, f"{root}/bad", f"{root}/ckb").awaitTermination()
    from tabrail.sources.tables import read_results
    got = read_results(spark, f"{root}/out")
    exp = C.prediction_error(model.transform(recs))
    assert got.count() == recs.count()
    assert got.exceptAll(exp).count() == 0
    # Second run on the same checkpoint adds nothing.
    ST.start_sink(results, f"{root}/out", f"{root}/ck").awaitTermination()
    assert read_results(spark, f"{root}/out").count() == recs.count()
    assert spark.read.text(f"{root}/bad").count() == 2


def test_strict_stream_fails_on_bad_record(spark, train):
    model = M.fit(M.stump_estimator(fx.STUMP_FEATURES), train, ["row_key"])
    root = work_dir(spark, "test-strict")
    spark.createDataFrame([("garbage",)], "value string").write.text(f"{root}/in")
    results, _ = ST.score_stream(ST.stream_source(spark, "text", f"{root}/in"), model,
                                 fx.CHARGE_FEATURES, strict=True)
    q = ST.start_sink(results, f"{root}/out", f"{root}/ck")
    with pytest.raises(Exception):
        q.awaitTermination()


def test_bounded_run_stops_all_when_one_fails(spark, train):
    model = M.fit(M.stump_estimator(fx.STUMP_FEATURES), train, ["row_key"])
    root = work_dir(spark, "test-bounded")
    spark.createDataFrame([("garbage",)], "value string").write.text(f"{root}/in")
    src = ST.stream_source(spark, "text", f"{root}/in")
    bad, _ = ST.score_stream(src, model, fx.CHARGE_FEATURES, strict=True)
    q1 = ST.start_sink(bad, f"{root}/out", f"{root}/ck1")
    q2 = ST.start_sink(src, f"{root}/raw", f"{root}/ck2", trigger={"processingTime": "1 second"})
    with pytest.raises(RuntimeError):
        ST.bounded_run([q1, q2], timeout_s=120, poll_s=0.5)
    assert not q1.isActive and not q2.isActive


def test_stream_results_reader_resumes(spark, train):
    model = M.fit(M.stump_estimator(fx.STUMP_FEATURES), train, ["row_key"])
    recs = C.replay_record(fx.charge(spark, SF).withColumn("id", F.monotonically_increasing_id()),
                           fx.CHARGE_FEATURES)
    root = work_dir(spark, "test-reader")
    RP.replay_publish(recs, f"{root}/in")
    res, _ = ST.score_stream(ST.stream_source(spark, "text", f"{root}/in"), model, fx.CHARGE_FEATURES)
    ST.start_sink(res, f"{root}/out", f"{root}/ck").awaitTermination()
    reader = ST.stream_results(spark, f"{root}/out")
    ST.start_sink(reader, f"{root}/copy", f"{root}/ckr").awaitTermination()
    ST.start_sink(reader, f"{root}/copy", f"{root}/ckr").awaitTermination()
    from tabrail.sources.tables import read_results
    assert read_results(spark, f"{root}/copy").count() == recs.count()


def test_score_requests_responses(spark, train):
    from tabrail.functions import rules as R

    model = M.fit(M.stump_estimator(fx.STUMP_FEATURES), train, ["row_key"])
    feats = list(fx.CHARGE_FEATURES)
    good = ", ".join(f'"{c}": {i + 1}.5' for i, c in enumerate(feats))
    nan = good.replace('"l_tax": 4.5', '"l_tax": "NaN"')
    bodies = [("ok", "{" + good + "}"), ("zero", "{" + good.replace("1.5", "0") + "}"),
              ("text", "{" + good.replace("2.5", '"abc"') + "}"), ("nan", "{" + nan + "}"),
              ("junk", "not json")]
    req = spark.createDataFrame(bodies, "request_id string, body string")
    out = {r.request_id: r for r in R.score_requests(req, model, feats).collect()}
    ok = out["ok"]
    assert ok.success and ok.status == 200 and ok.error is None
    expect = M.predict_one(spark, model, feats, **{c: i + 1.5 for i, c in enumerate(feats)})
    assert ok.predicted_price == round(expect, 4)
    assert ok.formatted_price == f"${expect * 100000:,.2f}"
    assert (out["zero"].status, out["text"].status, out["nan"].status, out["junk"].status) == (400, 400, 500, 500)
    assert not any(out[k].success for k in ("zero", "text", "nan", "junk"))
    assert all(out[k].predicted_price is None for k in ("zero", "text", "nan", "junk"))


def test_fit_keeps_no_node_ids_and_no_key(spark, monkeypatch):
    rows = spark.range(400).selectExpr("concat('k', id) AS row_key", "double(id % 17) AS a", "double(id % 23) AS b", "double((id * 7) % 31) AS target")
    est = M.forest_estimator(["a", "b"], num_trees=5, max_depth=4)
    assert not est.getStages()[-1].getCacheNodeIds()
    cached = M.forest_estimator(["a", "b"], num_trees=5, max_depth=4, cacheNodeIds=True)
    one, other = (M.fit(e, rows, ["row_key"]).stages[-1] for e in (est, cached))
    assert one.toDebugString.split("\n")[1:] == other.toDebugString.split("\n")[1:]
    seen = []
    monkeypatch.setattr(M.Pipeline, "fit", lambda self, data: seen.append(sorted(data.columns)))
    M.fit(est, rows, ["row_key"])
    assert seen == [["a", "b", "target"]]
