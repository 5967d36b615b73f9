"""The streamed audit against a plain computation, whatever the order of the files."""

import re
from collections import defaultdict
from itertools import permutations

import pytest

from tabrail.llm import filter_audit as A
from tabrail.llm.common import table

WORD = re.compile("[^\x20\x09-\x0D]+")


def fails(text):
    words = WORD.findall(text)
    out = ""
    out += "A" if len(words) < 200 else ""
    out += "B" if 100 * len(set(words)) < 50 * len(words) else ""
    out += "C" if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else ""
    out += "D" if re.search(r"[#$%&*|]", text) else ""
    return out


def plain(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    bad = {d for d, _, t in labels if t == 1 and d is not None}
    low = {}
    for d, text, _ in docs:
        if d is not None:
            low[text or ""] = min(low.get(text or "", d), d)
    parts = defaultdict(list)
    for d, text, source in docs:
        f = fails(text or "") + ("E" if d is not None and d > low[text or ""] else "")
        parts[source or ""].append((set(f), d in good, d in bad))
    out = {}
    for part, rows in parts.items():
        shapley = defaultdict(int)
        for order in permutations("ABCDE"):
            kept = rows
            for i, f in enumerate(order):
                hit = [r for r in kept if f in r[0]]
                kept = [r for r in kept if f not in r[0]]
                shapley[f] += len(hit)
                out[(part, "".join(order), i + 1)] = [len(kept), len(hit), sum(f in r[0] for r in rows) - len(hit), sum(r[0] == {f} for r in rows),
                                                     sum(r[1] for r in hit), sum(r[2] for r in hit)]
        for order in permutations("ABCDE"):
            for i, f in enumerate(order):
                out[(part, "".join(order), i + 1)].append(shapley[f])
    return out


def rows_of(df):
    got = df.collect()
    out = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in got}
    assert len(out) == len(got)
    return out


DOCS = "doc_id long, text string, source string, mask int"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def odd():
    many = " ".join(f"w{i}" for i in range(250))
    texts = [many, many + " $", "A" + many.upper(), "x " * 300, "\t\n", "", None, many + "  ", many + " y", "w " * 50_000 + many]
    docs = []
    for i in range(90):
        docs.append((i, texts[i % len(texts)], f"s{i % 3}" if i % 7 else None, 1))
    # Copies of one text with falling ids, ids that repeat, rows without id.
    docs += [(500 - i, many, "s1", 1) for i in range(30)] + [(3, many, "s0", 1)] * 3 + [(0, many, "s2", 1)] * 2 + [(None, many, "s0", 1), (None, None, None, 1)] * 2
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 600, 3)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1), (9, None, None)]
    return docs, [(d, q, None if t is None else int(t)) for d, q, t in labels]


@pytest.mark.parametrize("order,batches", [("up", 4), ("down", 4), ("mixed", 7), ("up", 1)])
def test_streamed_is_plain(spark, odd, tmp_path, order, batches):
    docs, labels = odd
    rows = {"up": docs, "down": docs[::-1], "mixed": [docs[i * 37 % len(docs)] for i in range(len(docs))]}[order]
    path = str(tmp_path / "documents.parquet")
    for i in range(0, len(rows), 20):
        spark.createDataFrame(rows[i:i + 20], DOCS).coalesce(1).write.mode("append").parquet(path)
    got = rows_of(A.audit_filters(spark, path, spark.createDataFrame(labels, LABELS), batches))
    assert got == plain([d[:3] for d in rows], labels)


def test_batches_retract_and_run_again(spark, odd, tmp_path):
    docs, labels = odd
    audit = A.Audit(spark, spark.createDataFrame(labels, LABELS), str(tmp_path / "audit"))
    high, low = [d for d in docs if (d[0] or 0) >= 40], [d for d in docs if (d[0] or 0) < 40]
    audit.merge(spark.createDataFrame(high, DOCS), 0)
    assert rows_of(A.report(audit.counters())) == plain([d[:3] for d in high], labels)
    # A batch that runs twice, as after a failure before its commit, counts once.
    for _ in range(2):
        audit.merge(spark.createDataFrame(low, DOCS), 1)
    assert rows_of(A.report(audit.counters())) == plain([d[:3] for d in docs], labels)
    changes = spark.read.schema(A.COUNTER).parquet(str(tmp_path / "audit/counters/000001"))
    assert changes.where("n < 0").count() > 0


def test_query_and_empty_table(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in table(spark, sf, "labels").select("doc_id", "quality", "toxic").collect()]
    assert rows_of(A.op13_retraction_stream(spark, sf)) == plain(docs, labels)
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "none"))
    assert A.audit_filters(spark, str(tmp_path / "none"), spark.createDataFrame([], LABELS)).count() == 0
