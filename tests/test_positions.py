import pandas as pd
from pyspark.sql import functions as F

from tabrail.operators.positions import rolling_last_n, with_position


def test_position_matches_row_number_with_hot_key(spark):
    # A third of the rows share one order value; the key breaks the ties.
    rows = [(i % 3 == 0 and 7 or i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "v long, k long")
    got = with_position(df, ["v", "k"], name="pos", partitions=5, total="n").toPandas()
    exp = pd.DataFrame(rows, columns=["v", "k"]).sort_values(["v", "k"]).reset_index(drop=True)
    exp["pos"] = range(len(exp))
    m = got.merge(exp, on=["v", "k"], suffixes=("", "_e"))
    assert len(m) == 3000
    assert (m.pos == m.pos_e).all()
    assert (got.n == 3000).all()


def test_rolling_matches_brute_force_across_blocks(spark):
    vals = [float((i * 37) % 101) for i in range(1000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "pos long, v double")
    n = 7
    got = rolling_last_n(df, "pos", n, {"s": F.sum("v"), "c": F.count(F.lit(1))}, block_rows=64)
    got = got.orderBy("pos").toPandas()
    s = pd.Series(vals)
    exp_sum = s.rolling(n, min_periods=1).sum()
    exp_cnt = s.rolling(n, min_periods=1).count()
    assert len(got) == 1000
    assert (abs(got.s - exp_sum) < 1e-9).all()
    assert (got.c == exp_cnt).all()


def test_rolling_window_one_and_short_input(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 2.0)], "pos long, v double")
    out = rolling_last_n(df, "pos", 1, {"s": F.sum("v")}, block_rows=1).orderBy("pos").collect()
    assert [r.s for r in out] == [1.0, 2.0]
    out = rolling_last_n(df, "pos", 100, {"s": F.sum("v")}).orderBy("pos").collect()
    assert [r.s for r in out] == [1.0, 3.0]


def test_grouped_prefix_sums_match_cumsum(spark):
    from tabrail.operators.positions import grouped_prefix_sums

    # One group holds most rows and spreads over several ranges.
    rows = [(0 if i % 10 else i % 7, i % 3, float(i * 37 % 1009) + i / 10000, i % 5 + 1, float(i % 11)) for i in range(6000)]
    df = spark.createDataFrame(rows, "g long, h long, v double, n long, s double").repartition(6)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = grouped_prefix_sums(df, ["g", "h"], "v", ["n", "s"]).toPandas().sort_values(["g", "h", "v"]).reset_index(drop=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    exp = pd.DataFrame(rows, columns=["g", "h", "v", "n", "s"]).sort_values(["g", "h", "v"]).reset_index(drop=True)
    by = exp.groupby(["g", "h"])
    assert (got[["g", "h", "v", "n", "s"]] == exp).all().all()
    for c in ("n", "s"):
        assert (abs(got[f"{c}_upto"] - by[c].cumsum()) < 1e-9).all()
        assert (abs(got[f"{c}_all"] - by[c].transform("sum")) < 1e-9).all()
    assert got.following.fillna(-1).tolist() == by.v.shift(-1).fillna(-1).tolist()


def test_number_rows_of_equal_rows(spark):
    from tabrail.operators.positions import number_rows

    got = number_rows(spark.range(1000).selectExpr("1 AS a", "cast(null as string) AS b").repartition(5), "i")
    assert sorted(r.i for r in got.collect()) == list(range(1000))
    assert number_rows(spark.range(0), "i").count() == 0
