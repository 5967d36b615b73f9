import re

import corpus_pipeline as P
from tabrail.llm import packing, pii, toxicity
from tabrail.llm.common import stage, table
from test_jaccard import brute as near
from test_pii import brute as spans
from test_suffix_dedup import brute as repeats

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in P.STAGES] == ["toxicity", "ngram_jaccard", "suffix_dedup", "pii", "packing"]
    frames = [docs]
    for name, step in P.STAGES:
        frames.append(stage(step(spark, frames[-1], SF), f"test-{name}"))
    for f in frames[1:-1]:
        assert f.columns == docs.columns and [x.dataType for x in f.schema] == [x.dataType for x in docs.schema]
    rows = [{r.doc_id: r for r in f.collect()} for f in frames[:-1]]
    # 1: exactly the predicted ones go, and hardly a clean one (accuracy: test_toxicity.py, on more labels).
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    gone = set(rows[0]) - set(rows[1])
    model = toxicity.learn(docs, table(spark, SF, "labels"))
    assert gone == {r.doc_id for r in toxicity.score_documents(docs, model).collect() if r.predicted}
    assert sum(labels.get(i) == 0 for i in gone) <= 2 and sum(labels.get(i) == 1 for i in gone) >= 0.5 * sum(labels.values())
    assert all(rows[1][i] == rows[0][i] for i in rows[1])
    # 2: one document of each group of near copies.
    own = sorted((i, r.text) for i, r in rows[1].items())
    assert sorted(rows[2]) == sorted(i for i, _, c in near(own, 5, 80) if i == c)
    # 3: byte counts and contents.
    own = sorted((i, r.text) for i, r in rows[2].items())
    for (i, n, m, _, _), (_, text) in zip(repeats(own), own):
        left = rows[3][i].text
        assert (left == text) if not m else n - m - 6 <= len(left.encode()) <= n - m
        assert rows[3][i].n_chars == len(left)
    # 4: no base span is left where one was.
    for i, r in rows[3].items():
        n = sum(map(len, spans(r.text).values()))
        assert (rows[4][i].text == r.text) if not n and "[" not in rows[4][i].text else re.search(r"\[(EMAIL|IP|CARD|PHONE|IBAN|SSN)\]", rows[4][i].text)
    # 5: every token once, in sequences that fit.
    count, out = packing.Counter(packing.TOKENIZER), frames[-1].collect()
    assert sum(r.length for r in out) == sum(len(count(r.text)) // 4 + 1 for r in rows[4].values())
    fill = {}
    for r in out:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= packing.CAPACITY and len(fill) <= -(-sum(fill.values()) // packing.CAPACITY) + 3


def test_empty_table_and_run(spark, tmp_path):
    for name in ("documents", "labels"):
        table(spark, "/root/testdata/sf0.001", name).limit(0 if name == "documents" else 10**6).write.parquet(f"{tmp_path}/{name}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
    assert P.run(spark, "/root/testdata/sf0.001").count() > 0
    assert toxicity.THRESHOLD == 0.7 and pii.KINDS[:4] == ("email", "ip", "card", "phone")


def test_odd_rows_through_every_stage(spark, tmp_path):
    long = " ".join(f"word{i % 5003}" for i in range(60_000))
    rows = [(1, "a plain text of a few words", "en", "s", 27, "x"), (1, "a plain text of a few words", "en", "s", 27, "x"), (2, None, None, None, None, None),
            (None, "mail me at a@b.co today", None, "s", 23, "y"), (None, None, "en", "s", 0, None), (3, "", "en", None, 0, "z"), (4, long, "en", "s", len(long), "w"),
            (5, "another plain text, with other words in it than the first", "en", "s", 57, "v")]
    kind = "doc_id long, text string, lang string, source string, n_chars long, `key` string"
    docs = spark.createDataFrame(rows, kind)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, "/root/testdata/sf0.001", "labels").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    frames = [docs]
    for name, step in P.STAGES:
        frames.append(stage(step(spark, frames[-1], str(tmp_path)), f"odd-{name}"))
        if name != "packing":
            assert frames[-1].columns == docs.columns, name
    left = frames[-2].collect()
    # Of the two equal rows one stays; rows without words have no copies.
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text is None) for r in left) == sorted(
        [(False, 1, False), (False, 2, True), (True, 0, False), (True, 0, True), (False, 3, False), (False, 4, False), (False, 5, False)])
    assert {r.text for r in left if r.doc_id is None} == {"mail me at [EMAIL] today", None} and {r.key for r in left if r.doc_id in (1, 5)} == {"x", "v"}
    packed = frames[-1].collect()
    assert len({(r.doc_id, r.piece, r.length) for r in packed}) >= 7 and sum(r.length for r in packed if r.doc_id == 2) == 1
