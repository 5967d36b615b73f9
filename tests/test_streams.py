import pytest
from pyspark.sql import functions as F

from tabrail.config import work_dir
from tabrail.functions import columns as C
from tabrail.operators import forest as M
from tabrail.operators import metrics as MT
from tabrail.operators.split import last_n
from tabrail.sources.tables import bad_lines, read_results, read_table
from tabrail.streaming import replay as RP
from tabrail.streaming import score as ST
from tabrail.streaming.monitor import LiveTop

RESULT = "id long, actual_price double, predicted_price double, error double, error_percentage double"


def _results(spark, n):
    return spark.range(n).selectExpr("id", "1.0 + id AS actual_price", "1.5 + id * 1.01 AS predicted_price").selectExpr(
        "*", "predicted_price - actual_price AS error", "(predicted_price - actual_price) / actual_price * 100 AS error_percentage")


def test_replay_order_and_rows_per_trigger(spark):
    root = work_dir(spark, "test-pace")
    rows = spark.range(950).selectExpr("id", "cast(id as double) AS x").repartition(7, "x")
    RP.replay_publish(rows.where("id < 450"), f"{root}/in", rows_per_file=100, dense=True)
    RP.replay_publish(rows.where("id >= 450"), f"{root}/in", rows_per_file=100)
    files, trigger = RP.pace(200, 0.1, rows_per_file=100)
    assert files == 2 and trigger == {"processingTime": "0.1 seconds"}
    with pytest.raises(ValueError):
        RP.pace(150, 1, rows_per_file=100)
    seen = []
    raw = ST.stream_source(spark, "text", f"{root}/in", max_per_trigger=files)
    decoded = C.json_decode(raw, "id long, x double")
    query = decoded.writeStream.foreachBatch(lambda df, i: seen.append(sorted(r.id for r in df.collect()))) \
        .option("checkpointLocation", f"{root}/ck").trigger(**trigger).start()
    query.processAllAvailable()
    query.stop()
    seen = [b for b in seen if b]
    # Five files of the first call (the last one half full), five of the second.
    assert [len(b) for b in seen] == [200, 200, 150, 200, 200]
    assert [i for b in seen for i in b] == list(range(950))
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [200, 200, 150, 200, 200]


def test_manifest_and_loss(spark):
    root = work_dir(spark, "test-loss")
    RP.replay_publish(spark.range(250).selectExpr("id"), f"{root}/in", rows_per_file=100, dense=True)
    assert RP.lose_block(spark, f"{root}/in", 1) == 1
    raw = ST.stream_source(spark, "text", f"{root}/in", with_file=True)
    ST.start_sink(raw, f"{root}/out", f"{root}/ck", fmt="parquet").awaitTermination()
    report = RP.loss_report(spark.read.parquet(f"{root}/out"), f"{root}/in").orderBy("block").collect()
    assert [(int(r.block), r.published, r.landed, r.lost) for r in report] == [(0, 100, 100, 0), (1, 100, 0, 100), (2, 50, 50, 0)]


def test_live_top_equals_batch_after_every_batch_and_restart(spark):
    root = work_dir(spark, "test-top")
    results = _results(spark, 730)
    top, n = LiveTop(spark, f"{root}/live", 60), 60
    done = 0
    for upto in (300, 730):
        RP.replay_publish(results.where(f"id >= {done} AND id < {upto}"), f"{root}/in", rows_per_file=100)
        stream = C.json_decode(ST.stream_source(spark, "text", f"{root}/in", max_per_trigger=1), RESULT)
        if done:
            # Died after the merge and before the commit: the batch runs again.
            assert ST.forget_commit(spark, f"{root}/ck") == 2
        top.start(stream, f"{root}/ck").awaitTermination()
        done = upto
        assert sorted(r.id for r in top.newest().collect()) == list(range(upto - n, upto))
    got = {r.batch: r for r in top.metrics().collect()}
    ends = [100, 200, 300, 400, 500, 600, 700, 730]
    assert sorted(got) == list(range(len(ends)))
    for b, end in enumerate(ends):
        want = MT.live_metrics(results.where(f"id < {end}"), n).first()
        assert got[b].samples == want.samples
        assert got[b].mae_k == pytest.approx(want.mae_k) and got[b].rmse_k == pytest.approx(want.rmse_k)
    # A few small tables are kept, not one a batch.
    assert len(top._versions()) <= 3
    assert last_n(results, n, "id").count() == top.newest().count()


@pytest.fixture(scope="module")
def model(spark):
    df = spark.range(200).selectExpr("cast(id as double) AS a", "cast(id % 7 as double) AS b", "cast(id % 50 as double) AS target")
    return M.fit(M.stump_estimator(["a", "b"], max_bins=256), df, ["a"])


def test_one_query_routes_scored_and_rejected(spark, model):
    root = work_dir(spark, "test-route")
    lines = ['{"id":1,"a":1.0,"b":2.0,"actual_price":4.0}', '{"id":2,"a":1.0,"b":2.0,"actual_price":null}', '{"id":null,"a":1.0,"b":2.0,"actual_price":0}',
             '{"id":4,"a":"x","b":2.0,"actual_price":4.0}', '{"id":5,"b":2.0}', "not json", "   ", '{"id":8,"a":"NaN","b":1}']
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(3).write.text(f"{root}/in")
    routed = ST.score_or_quarantine(ST.stream_source(spark, "text", f"{root}/in"), model, ["a", "b"])
    query = ST.start_sink(routed, f"{root}/out", f"{root}/ck", fmt="parquet", partition_by=["outcome"])
    query.awaitTermination()
    assert sum(p.numInputRows for p in query.recentProgress) == len(lines)
    rows = spark.read.parquet(f"{root}/out").collect()
    scored = {r.id: r for r in rows if r.outcome == "scored"}
    assert set(scored) == {1, 2, None} and all(r.predicted_price is not None and r.value is None for r in scored.values())
    assert scored[1].error == scored[1].predicted_price - 4.0 and scored[2].error is None and scored[None].error_percentage is None
    bad = {r.value: r for r in rows if r.outcome == "rejected"}
    assert {v: r.reason for v, r in bad.items()} == {lines[3]: "missing or invalid field", lines[4]: "missing or invalid field",
                                                     lines[5]: "not a JSON object", lines[6]: "empty record", lines[7]: "missing or invalid field"}
    assert all(r.predicted_price is None and r.error is None for r in bad.values())


def test_limit_then_resume_and_failure_before_the_commit(spark, model):
    root = work_dir(spark, "test-limit")
    recs = spark.range(1000).selectExpr("id", "cast(id as double) AS a", "1.0D AS b", "2.0D AS actual_price")
    RP.replay_publish(recs, f"{root}/in", rows_per_file=100, dense=True)
    results, _ = ST.score_stream(ST.stream_source(spark, "text", f"{root}/in", max_per_trigger=1), model, ["a", "b"])
    log = ST.ProgressLog()
    spark.streams.addListener(log)
    query = ST.start_sink(results, f"{root}/out", f"{root}/ck", trigger={"processingTime": "1 second"})
    out = ST.bounded_run([query], timeout_s=120, poll_s=0.1, max_batches=2, log=log)
    spark.streams.removeListener(log)
    first = read_results(spark, f"{root}/out").count()
    assert out["ended"] == "limit" and 200 <= first < 1000 and not query.isActive
    assert ST.forget_commit(spark, f"{root}/ck") is not None
    ST.start_sink(results, f"{root}/out", f"{root}/ck").awaitTermination()
    got = read_results(spark, f"{root}/out")
    assert sorted(r.id for r in got.collect()) == list(range(1000))
    # A time limit ends a run that would go on.
    query = ST.start_sink(results, f"{root}/out", f"{root}/ck", trigger={"processingTime": "1 second"})
    assert ST.bounded_run([query], timeout_s=0.5, poll_s=0.1)["ended"] == "timeout" and not query.isActive


def test_csv_errors(spark, tmp_path):
    schema = "a long, b double"
    spark.createDataFrame([(x,) for x in ("a,b", "1,2.5", "2,abc", "3", "4,1,9", "5,")], "value string").coalesce(1).write.text(str(tmp_path / "t"))
    with pytest.raises(Exception):
        read_table(spark, str(tmp_path / "t"), schema=schema).collect()
    assert sorted((r.a, r.b) for r in read_table(spark, str(tmp_path / "t"), schema=schema, errors="drop").collect() if r.b) == [(1, 2.5)]
    bad = {r.line: (r.a, r.b) for r in bad_lines(spark, str(tmp_path / "t"), schema).collect()}
    assert set(bad) == {"2,abc", "3", "4,1,9"} and bad["2,abc"] == (2, None)
    assert read_table(spark, str(tmp_path / "t"), schema=schema, errors="keep").count() == 5
    with pytest.raises(ValueError):
        read_table(spark, str(tmp_path / "t"), errors="ignore")


def test_status_counts_the_published_rows(spark, tmp_path):
    from tabrail.sinks import tables as SK

    with SK.run_status(spark, str(tmp_path / "log"), "training", clock=lambda: "t") as status:
        SK.publish_tables({"x": status.counted(spark.range(77).where("id % 2 = 0"))}, str(tmp_path / "w"))
    assert {r.status: r.rows for r in SK.read_status(spark, str(tmp_path / "log")).collect()} == {"started": None, "completed": 39}
    with pytest.raises(FileNotFoundError):
        SK.publish_tables({"x": spark.range(1), "y": str(tmp_path / "nothing")}, str(tmp_path / "v"), spark=spark)
    assert not SK.table_exists(spark, str(tmp_path / "v"))
    SK.publish_tables({"y": str(tmp_path / "w/x")}, str(tmp_path / "v"), spark=spark)
    assert spark.read.parquet(str(tmp_path / "v/y")).count() == 39


def test_half_written_table_is_written_again(spark, tmp_path):
    from tabrail.sinks import tables as SK

    path = tmp_path / "t"
    spark.range(5).write.parquet(str(path))
    (path / "_SUCCESS").unlink()
    SK.materialize_if_absent(spark, lambda: spark.range(9), str(path))
    SK.materialize_if_absent(spark, lambda: spark.range(3), str(path))
    assert spark.read.parquet(str(path)).count() == 9


def test_inferred_schema_report(spark, tmp_path):
    spark.createDataFrame([(1, "a", None), (2, "b", 0.5)], "i int, s string, x double").coalesce(1).write.option("header", True).csv(str(tmp_path / "c"))
    got = C.schema_report(spark, read_table(spark, str(tmp_path / "c")), counts=True).collect()
    assert [tuple(r) for r in got] == [(0, "i", "int", 2), (1, "s", "string", 2), (2, "x", "double", 1)]
    assert C.schema_report(spark, spark.range(1)).columns == ["position", "column", "type"]


def test_batches_do_not_follow_the_number_of_files(spark):
    root = work_dir(spark, "test-files")
    RP.replay_publish(spark.range(450).selectExpr("id"), f"{root}/in", rows_per_file=10, dense=True)
    files = RP.files_per_batch(spark, f"{root}/in")
    assert files == 5 and RP.files_per_batch(spark, f"{root}/none", least=2) == 2
    query = ST.start_sink(ST.stream_source(spark, "text", f"{root}/in", max_per_trigger=files), f"{root}/out", f"{root}/ck")
    query.awaitTermination()
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [50] * 9


def test_files_are_not_asked_for_one_by_one(spark, monkeypatch):
    root, client, calls = work_dir(spark, "test-listing"), spark.sparkContext._gateway._gateway_client, []
    RP.replay_publish(spark.range(400).selectExpr("id"), f"{root}/in", rows_per_file=5, dense=True)
    spark.range(3).selectExpr("cast(id as string) AS value").coalesce(1).write.mode("append").text(f"{root}/in")
    send = client.send_command
    monkeypatch.setattr(client, "send_command", lambda *a, **k: calls.append(1) or send(*a, **k))
    assert RP.files_per_batch(spark, f"{root}/in", batches=1) == 81
    assert RP.lose_block(spark, f"{root}/in", 2) == 1
    # Each of the 80 files took six calls, and a process on a local disk.
    assert len(calls) < 80
    assert RP.files_per_batch(spark, f"{root}/in", batches=1) == 80


@pytest.mark.parametrize("turned", [False, True])
def test_live_metrics_after_every_block_of_a_batch(spark, turned, monkeypatch):
    from tabrail.streaming import monitor

    monkeypatch.setattr(monitor, "CHUNK", 3)
    root, n = work_dir(spark, "test-blocks"), 25
    # Blocks of 10 hold fewer rows than n; turned, newer results come first.
    blocks = _results(spark, 237).withColumn("block", F.expr("23 - id div 10" if turned else "id div 10"))
    top = LiveTop(spark, f"{root}/live", n, block="block")
    for i, (low, high) in enumerate([(0, 9), (9, 10), (10, 24), (10, 24)]):
        top.merge(blocks.where(f"block >= {low} AND block < {high}"), min(i, 2))
    got = {r.batch: r for r in top.metrics().collect()}
    assert sorted(got) == list(range(24))
    for b, r in got.items():
        want = MT.live_metrics(blocks.where(f"block <= {b}"), n).first()
        assert r.samples == want.samples
        assert r.mae_k == pytest.approx(want.mae_k) and r.rmse_k == pytest.approx(want.rmse_k)
    assert sorted(r.id for r in top.newest().collect()) == list(range(212, 237))


def _predict(spark, model, root, recs, **kw):
    from tabrail.config import Settings
    from tabrail.plans import jobs as J
    from tabrail.sources.models import save_model

    settings = Settings(features=("a", "b"), key=("id",))
    path = save_model(model, [f"{root}/model"])
    return J.predict_job(spark, [path], recs, settings, f"{root}/run", f"{root}/status", rows_per_file=100, **kw)


def test_a_run_that_its_limit_ends_is_no_result(spark, model):
    from tabrail.sinks.tables import read_status

    recs = spark.range(300).selectExpr("id", "cast(id as double) AS a", "if(id = 7, null, 1.0D) AS b", "2.0D AS actual_price")
    root = work_dir(spark, "test-cut")
    with pytest.raises(TimeoutError):
        _predict(spark, model, root, recs, timeout_s=0.0)
    assert [r.status for r in read_status(spark, f"{root}/status").collect()] == ["started"]
    root = work_dir(spark, "test-whole")
    assert _predict(spark, model, root, recs).count() == 299
    assert sorted(r.status for r in read_status(spark, f"{root}/status").collect()) == ["completed", "started"]


def test_a_replay_that_is_not_read_whole_fails(spark, model, monkeypatch):
    from tabrail.plans import jobs as J
    from tabrail.sinks.tables import read_status

    def lossy(records, path, *args, **kw):
        RP.replay_publish(records, path, *args, **kw)
        RP.lose_block(spark, path, 1)

    monkeypatch.setattr(J, "replay_publish", lossy)
    root = work_dir(spark, "test-lost")
    recs = spark.range(300).selectExpr("id", "cast(id as double) AS a", "1.0D AS b", "2.0D AS actual_price")
    with pytest.raises(RuntimeError, match="100 of 300"):
        _predict(spark, model, root, recs)
    assert [r.status for r in read_status(spark, f"{root}/status").collect()] == ["started"]


def test_an_empty_replay_has_an_empty_result(spark, model):
    recs = spark.range(0).selectExpr("id", "cast(id as double) AS a", "1.0D AS b", "2.0D AS actual_price")
    assert _predict(spark, model, work_dir(spark, "test-empty"), recs).count() == 0
