import random

import pytest

from tabrail.llm import toxicity as X
from tabrail.llm.common import table


@pytest.fixture(scope="module")
def model(spark):
    return X.learn(table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels"))


def auc(pairs):
    pos, neg = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)


def test_held_out_accuracy(spark, model):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    rows = X.score_documents(docs, model).join(labels, "doc_id").where("held_out").collect()
    assert auc([(r.toxic, r.score) for r in rows]) > 0.92
    wrong = [r for r in rows if r.predicted != r.toxic]
    assert len(wrong) < 0.02 * len(rows)
    assert sum(r.predicted for r in rows if r.toxic == 0) <= 0.005 * sum(r.toxic == 0 for r in rows)


def test_restoration(model):
    words = X.Words(model.restorer)
    for hidden, plain in (("5cum", "scum"), ("sc.um", "scum"), ("id1ot", "idiot"), ("trrrash", "trash"), ("m0r0n", "moron"), ("$cum", "scum")):
        assert plain in words.spellings(hidden), (hidden, words.spellings(hidden))
    assert "idiot" in X.words_of("you i d i o t there") and "scum" in X.words_of("the s.c.u.m of it")
    score = model.scorer()
    clean = "The of onre and heti thing that was in the house"
    assert score(clean) < 0.5 and score("") < 0.5
    for hidden in ("1d10t", "i d i o t", "s-c-u-m", "moooron", "5tup1d", "IDIOT!!"):
        assert score(f"{clean} {hidden} {clean}") > score(clean) + 0.2, hidden


def test_odd_rows(spark, model):
    df = spark.createDataFrame([(1, "x", 5), (None, None, 5), (1, "x", 5), (2, "", 5), (3, "a" * 300_000, 5)], "doc_id long, text string, score int")
    rows = X.score_documents(df, model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows) and all(r.held_out is not None for r in rows)
    assert X.score_documents(df.limit(0), model).count() == 0
    empty = X.learn(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in X.score_documents(df, empty).collect()} == {0.0}
    kept = X.toxicity_stage(spark, df, "/root/testdata/sf0.001")
    assert kept.columns == df.columns and kept.count() == 5


def test_only_near_copies_leave_the_sample(spark, monkeypatch):
    rows, r, word = [], random.Random(8), "abcdefghij"
    text = lambda n: " ".join("".join(r.choice(word) for _ in range(6)) for _ in range(n))
    passage = text(60)
    rows += [(i, f"{passage} {text(25)}", i % 2) for i in range(60)]  # alike by about a half
    copied = text(300)
    rows += [(i, f"{copied} {text(2)}", 1) for i in range(60, 90)]  # near copies
    seen, stage = [], X.stage
    monkeypatch.setattr(X, "stage", lambda df, name: seen.append((name, stage(df, name))) or seen[-1][1])
    X.learn(spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string"), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    before, after = [{x.id for x in df.select("id").collect()} for name, df in seen if name == "train"]
    assert {i for i in before if i < 60} == {i for i in after if i < 60}
    assert len([i for i in before if i >= 60]) > 1 and [i for i in after if i >= 60] == [min(i for i in before if i >= 60)]
