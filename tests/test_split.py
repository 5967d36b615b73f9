import math

from pyspark.sql import functions as F

from tabrail.operators.split import bernoulli_split, exact_split, fraction_cutoff, head_n, last_n
from tabrail.plans import fixtures as fx

from conftest import SF


def test_bernoulli_independent_of_partitioning(spark):
    c = fx.charge(spark, SF)
    a = bernoulli_split(c, ["row_key"]).select("row_key", "part")
    b = bernoulli_split(c.repartition(3, "target"), ["row_key"]).select("row_key", "part")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    frac = a.where("part = 'train'").count() / a.count()
    assert 0.75 < frac < 0.85


def test_exact_split_counts(spark):
    c = fx.charge(spark, SF)
    n = c.count()
    s = exact_split(c, ["row_key"], 0.2, 42)
    test = s.where("part = 'test'")
    assert test.count() == math.ceil(0.2 * n)
    ids = [r.id for r in test.orderBy("id").collect()]
    assert ids == list(range(len(ids)))


def test_cutoff():
    assert fraction_cutoff(0.8) == "cccccccc"
    assert fraction_cutoff(0.0) == "00000000" and "f" * 32 < fraction_cutoff(1.0)
    assert fraction_cutoff(0.0) == "00000000"


def test_head_n_edges(spark):
    df = spark.range(50).withColumnRenamed("id", "k")
    assert head_n(df, 0, ["k"]).count() == 50
    assert head_n(df, None, ["k"]).count() == 50
    assert head_n(df, 500, ["k"]).count() == 50
    assert [r.k for r in head_n(df, 3, ["k"]).collect()] == [0, 1, 2]


def test_last_n_edges(spark):
    df = spark.range(10)
    assert last_n(df, 0, "id").count() == 0
    assert sorted(r.id for r in last_n(df, 3, "id").collect()) == [7, 8, 9]
    assert last_n(df, 11, "id").count() == 10
    assert last_n(spark.range(0), 5, "id").count() == 0


def _sorted_head(df, key, fraction):
    from tabrail.operators import split as S

    n = df.count()
    h = df.withColumn("_h", S.split_hash(key, 42, "exact")).orderBy("_h", *key).limit(math.ceil(fraction * n))
    return sorted(tuple(r[c] for c in key) for r in h.collect())


def test_cutoff_over_several_passes_matches_sort(spark, monkeypatch):
    from tabrail.operators import split as S

    monkeypatch.setattr(S, "DIGITS", 1)
    monkeypatch.setattr(S, "FEW_ROWS", 3)
    df = spark.range(5000).selectExpr("cast(id as string) as k")
    for fraction in (0.37, 0.0002, 0.9999, 1.0):
        out = S.exact_split(df, ["k"], fraction, 42, position=None)
        assert sorted((r.k,) for r in out.where("part = 'test'").collect()) == _sorted_head(df, ["k"], fraction)


def test_hot_key_is_settled_by_row_digests(spark, monkeypatch, tmp_path):
    from tabrail.operators import positions as P
    from tabrail.operators import split as S

    monkeypatch.setattr(S, "FEW_ROWS", 50)
    stored = []
    keep = P.scratch_dir
    monkeypatch.setattr(P, "scratch_dir", lambda spark, name: stored.append(name) or keep(spark, name))
    # One key on 4000 of 6000 rows, its rows all different.
    df = spark.range(6000).selectExpr("if(id % 3 = 0, id, -1) AS k", "id * 2 AS x", "cast(if(id % 5 = 0, null, id) as string) AS y")
    for fraction in (0.1, 0.33, 0.5, 0.7, 0.95):
        out = S.exact_split(df, ["k"], fraction, 42, position=None)
        test = out.where("part = 'test'")
        assert test.count() == math.ceil(fraction * 6000) and out.count() == 6000
        assert sorted((r.k,) for r in test.collect()) == _sorted_head(df, ["k"], fraction)
        again = S.exact_split(df.repartition(3), ["k"], fraction, 42, position=None)
        assert out.exceptAll(again).count() == 0
    assert stored == []
    # Equal in every column: the only rows that are stored.
    twins = df.select("k", "x", "y").where("k >= 0").unionByName(spark.range(4000).selectExpr("-1L AS k", "0L AS x", "cast(null as string) AS y"))
    for fraction in (0.1, 0.5, 0.95):
        out = S.exact_split(twins, ["k"], fraction, 42)
        test = out.where("part = 'test'")
        n = math.ceil(fraction * 6000)
        assert test.count() == n and out.count() == 6000
        assert sorted(r.id for r in test.collect()) == list(range(n))
        assert sorted((r.k,) for r in test.collect()) == _sorted_head(twins, ["k"], fraction)
    assert set(stored) == {"numbered", "positions"}


def test_no_copy_of_the_input(spark, monkeypatch):
    """The split without positions is a filter: one scan, no exchange, nothing stored."""
    from tabrail.operators import split as S

    df = spark.range(3000).selectExpr("id AS k", "repeat('x', 100) AS wide")
    out = S.exact_split(df, ["k"], 0.2, 42, position=None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "FileScan" not in plan and out.where("part = 'test'").count() == 600
