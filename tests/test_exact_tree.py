import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabrail.operators import exact_tree as X
from tabrail.operators import forest as M
from tabrail.plans import fixtures as fx

from conftest import SF


def brute(pdf, feats, depth, node=1):
    """Plain exact tree over a pandas frame: {heap number: (feature, threshold)} and leaf means."""
    y = pdf.target
    best = None
    if depth:
        for fi, f in enumerate(feats):
            g = pdf.groupby(f).target.agg(["count", "sum"]).sort_index()
            ln, ls, vals = g["count"].cumsum(), g["sum"].cumsum(), list(g.index)
            for i in range(len(vals) - 1):
                rn, rs = len(pdf) - ln.iloc[i], y.sum() - ls.iloc[i]
                score = ls.iloc[i] ** 2 / ln.iloc[i] + rs ** 2 / rn
                if best is None or score > best[0] * (1 + 1e-13):
                    best = (score, f, (vals[i] + vals[i + 1]) / 2)
    own = y.sum() ** 2 / len(pdf)
    if best is None or best[0] - own <= 1e-12 * max(own, best[0]):
        return {}, {node: y.mean()}
    _, f, t = best
    splits, leaves = {node: (f, t)}, {}
    for child, part in ((2 * node, pdf[pdf[f] <= t]), (2 * node + 1, pdf[pdf[f] > t])):
        s, m = brute(part, feats, depth - 1, child)
        splits |= s
        leaves |= m
    return splits, leaves


def same(tree, pdf, feats, depth):
    splits, leaves = brute(pdf, feats, depth)
    assert {i: (n.feature, n.threshold) for i, n in tree.nodes.items() if n.feature} == splits
    got = {i: n.mean for i, n in tree.nodes.items() if n.feature is None}
    assert got.keys() == leaves.keys() and all(got[i] == pytest.approx(leaves[i], rel=1e-9) for i in got)


def test_depth_three_over_continuous_features(spark):
    feats = ["l_extendedprice", "l_quantity", "o_totalprice", "l_discount"]
    c = fx.charge(spark, SF).select(*feats, "target")
    pdf = c.toPandas()
    assert pdf.l_extendedprice.nunique() > 1000
    tree = X.fit_exact_tree(c, feats, "target", 3)
    same(tree, pdf, feats, 3)
    assert tree.depth == 3
    scored = tree.transform(c).agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("target"), 2)))).first()[0]
    assert scored < pdf.target.std()


def test_same_split_as_the_forest_call(spark):
    c = fx.charge(spark, SF)
    s = M.stump_summary(M.fit(M.stump_estimator(fx.STUMP_FEATURES), c, ["row_key"]))
    root = X.fit_exact_tree(c, fx.STUMP_FEATURES, "target").nodes
    assert (s["feature"], s["threshold"]) == (root[1].feature, pytest.approx(root[1].threshold))
    assert s["left"] == pytest.approx(root[2].mean) and s["right"] == pytest.approx(root[3].mean)


def test_hot_value_ties_and_odd_rows(spark):
    # Half of the rows share a value; two features part the rows alike.
    rows = [(5.0 if i % 2 else float(i), 5.0 if i % 2 else float(i), float(i % 2) * 10 + i % 3) for i in range(400)]
    df = spark.createDataFrame([*rows, (1.0, 2.0, None)], "a double, b double, target double").repartition(7)
    tree = X.fit_exact_tree(df, ["a", "b"], "target", 2)
    assert tree.nodes[1].feature == "a" and tree.nodes[1].n == 400
    same(tree, pd.DataFrame(rows, columns=["a", "b", "target"]), ["a", "b"], 2)
    flat = X.fit_exact_tree(spark.createDataFrame([(1.0, 3.0), (2.0, 3.0)], "a double, target double"), ["a"], "target", 3)
    assert list(flat.nodes) == [1] and flat.depth == 0
    near = X.fit_exact_tree(spark.createDataFrame([(1.0, 0.0), (1.0 + 2 ** -52, 9.0)], "a double, target double"), ["a"])
    assert near.nodes[1].threshold == 1.0 and near.nodes[2].mean == 0.0
    for bad in (None, float("nan")):
        with pytest.raises(ValueError):
            X.fit_exact_tree(spark.createDataFrame([(bad, 1.0), (1.0, 2.0)], "a double, target double"), ["a"])
    with pytest.raises(ValueError):
        X.fit_exact_tree(df.limit(0), ["a"])


def test_levels_read_rows_that_are_split_already(spark, monkeypatch, capsys):
    from tabrail.plans import queries as Q

    rows = spark.range(300).selectExpr("concat('k', id) AS row_key", *[f"double((id * {i + 3}) % 19) AS {c}" for i, c in enumerate(Q.FEATS)],
                                       "double((id * 11) % 29) AS target").cache()
    monkeypatch.setattr(Q.fx, "charge", lambda spark, sf: rows)
    seen = []

    def fit(df, *args):
        seen.append(df)
        return X.fit_exact_tree(df, *args)

    monkeypatch.setattr(Q, "fit_exact_tree", fit)
    got = Q.tree_fit_depth3(spark, "none").collect()
    seen[0].explain()
    assert "md5" not in capsys.readouterr().out
    prep = Q._Prepared(spark, "none")
    assert sorted((r.row_key, r.target) for r in got) == sorted((r.row_key, r.target) for r in prep.test_rows().collect())
    assert seen[0].count() == prep.train_rows().where("part = 'train'").count()
