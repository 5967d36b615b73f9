import hashlib
import random

import numpy as np
import pytest

from tabrail.llm import suffix_dedup as D
from tabrail.llm.common import table


def brute(rows, n=D.LENGTH):
    seen, out = set(), []
    for i, t in rows:
        d = (t or "").encode()
        gone = np.zeros(len(d), bool)
        for k in range(len(d) - n + 1):
            w = d[k:k + n]
            if w in seen:
                gone[k:k + n] = True
            else:
                seen.add(w)
        spans = int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum())
        out.append((i, len(d), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(d, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def got(df):
    return sorted((tuple(r) for r in D.remove_repeats(df).collect()), key=str)


def test_index_marks_what_a_scan_marks():
    r = random.Random(3)
    for sigma, n in ((2, 8), (3, 5), (26, 4)):
        segs = [bytes(97 + r.randrange(sigma) for _ in range(r.randrange(1, 60))) for _ in range(80)]
        segs += [segs[3], segs[4][:20] + segs[5]]
        idx = D.RunLengthIndex(segs)
        seen, want, at = set(), [], 0
        for s in segs:
            for k in range(len(s) - n + 1):
                if s[k:k + n] in seen:
                    want.append(at + k)
                seen.add(s[k:k + n])
            at += len(s) + 1
        assert idx.repeated(n).tolist() == want
        assert len(idx.run_chars) == len(idx.run_starts) <= len(idx.text)


def test_documents_against_brute_force(spark):
    df = table(spark, "/root/testdata/sf0.01", "documents")
    rows = sorted((r.doc_id, r.text) for r in df.collect())
    assert got(df) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("hot", [D.HOT, 2])
def test_repeats_inside_texts_borders_and_hot_anchors(spark, monkeypatch, hot):
    monkeypatch.setattr(D, "HOT", hot)
    r = random.Random(5)
    passage = "".join(r.choice("abcdefgh é\n") for _ in range(260))
    rows = [(i, "".join(r.choice("abcdefgh é\n") for _ in range(r.randrange(0, 300))) + passage[r.randrange(100):r.randrange(150, 260)] + "x" * r.randrange(5)) for i in range(80)]
    rows += [(100, "ab" * 400), (101, "ab" * 60), (102, "z" * 99), (103, "z" * 100), (104, "z" * 101), (105, passage), (106, passage), (107, ""), (108, "é" * 150), (109, "\0" * 250)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, key int")
    assert got(df) == sorted(brute(rows), key=str)


def test_long_texts_in_slices(spark, monkeypatch):
    monkeypatch.setattr(D, "CHUNK", 700)
    monkeypatch.setattr(D, "BLOCK", 2000)
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcde") for _ in range(r.randrange(1, 9)))
    part = " ".join(word() for _ in range(300))
    rows = [(0, part + " ".join(word() for _ in range(500)) + part), (1, "q" + part[100:900] + "q" + part[5:]), (2, part[50:400])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == sorted(brute(rows), key=str)


def test_odd_rows_and_stage(spark):
    r = random.Random(1)
    long = "".join(r.choice("abcdef ") for _ in range(300))
    rows = [(None, None), (4, long), (4, long), (2, long[:150]), (None, long), (9, None)]
    df = spark.createDataFrame([(i, t, len(t or ""), 1) for i, t in rows], "doc_id long, text string, n_chars int, ranges int")
    out = got(df.select("doc_id", "text"))
    assert len(out) == 6 and sum(x[2] for x in out) == 300 + 300 + 150
    kept = D.dedup_stage(spark, df, "")
    assert kept.columns == df.columns and kept.count() == 6
    assert sorted(r.n_chars or 0 for r in kept.collect()) == [0, 0, 0, 0, 0, 300]
    assert got(df.limit(0).select("doc_id", "text")) == []
