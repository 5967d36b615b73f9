"""Queries that read the joined rows more than once join them once."""

import pytest
from pyspark.sql import functions as F

from tabrail.operators import forest as M
from tabrail.plans import fixtures as fx
from tabrail.plans import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["row_counts", "describe", "prepare_job", "predict_batch", "score_requests"])
def test_the_joins_are_computed_once(spark, monkeypatch, name):
    runs = spark.sparkContext.accumulator(0)

    def counted(spark, sf):
        first = F.udf(lambda x: runs.add(1) or x, "string")
        return charge(spark, sf).withColumn("row_key", first("row_key"))

    charge = fx.charge
    monkeypatch.setattr(fx, "charge", counted)
    if name in ("describe",):
        # Its stored columns leave the key out: count on a column they keep.
        seen = F.udf(lambda x: runs.add(1) or x, "double")
        monkeypatch.setattr(fx, "charge", lambda spark, sf: charge(spark, sf).withColumn("target", seen("target")))
    Q.QUERIES[name](spark, SF).write.format("noop").mode("overwrite").save()
    assert runs.value == charge(spark, SF).count()


def test_a_fit_reads_the_columns_it_needs(spark):
    df = fx.charge(spark, SF)
    est = M.stump_estimator(fx.STUMP_FEATURES)
    assert M.fit_columns(est, df, ["row_key"]).columns == ["row_key", *fx.STUMP_FEATURES, "target"]


def test_forest_checks_keep_every_test_row(spark, monkeypatch):
    small = M.forest_estimator
    monkeypatch.setattr(M, "forest_estimator", lambda f, label: small(f, label, num_trees=3, max_depth=2))
    out = Q.forest_fit_checks(spark, SF)
    rows = out.collect()
    assert out.columns[:3] == ["row_key", "target", "in_label_range"] and len(rows) == rows[0].rows > 500
    assert all(r.in_label_range and r.trees == 3 and r.depth == 2 and r.below_std for r in rows)
