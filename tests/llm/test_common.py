import numpy as np
import pyarrow as pa
import pytest

from tabrail.llm import common as C


def test_components_of_a_long_path_and_unfinished_rounds(spark):
    n = 300
    nodes = spark.range(n + 5).withColumnRenamed("id", "id")
    links = spark.createDataFrame([(i, i + 1) for i in range(0, n - 1)], "a long, b long")
    got = {r.id: r.comp for r in C.components(nodes, links).collect()}
    assert got == {**{i: 0 for i in range(n)}, **{i: i for i in range(n, n + 5)}}
    with pytest.raises(RuntimeError):
        C.components(nodes, links, rounds=2)


def test_bucket_counts_saturate_and_sum(spark, monkeypatch):
    monkeypatch.setattr(C, "COUNT_AT_ONCE", 7)
    df = spark.createDataFrame([(i % 5 if i < 900 else 6,) for i in range(1000)], "k long").repartition(3)
    got = C.bucket_counts(df, lambda b: [b.column("k").to_numpy().astype(np.uint64)], 3)
    # A task's own count stops at 255; 180 rows a bucket over three tasks do not reach it.
    assert got.tolist() == [180, 180, 180, 180, 180, 0, 100, 0]
    many = spark.createDataFrame([(1,)] * 1000, "k long").coalesce(1)
    assert C.bucket_counts(many, lambda b: [b.column("k").to_numpy().astype(np.uint64)], 2).tolist() == [0, 255, 0, 0]


def test_lean_jobs_drop_what_others_kept():
    import __main__

    kept = __main__.__dict__.setdefault("_tabrail_kept", {})
    kept.update({"one": 1, "two": 2})
    batch = pa.RecordBatch.from_pydict({"x": [1, 2]})
    assert list(C.lean(lambda it: it, "two")([batch])) == [batch]
    assert "one" not in kept and kept.get("two") == 2
    assert list(C.lean(lambda it: it)([])) == [] and not kept
