import hashlib
import itertools

import pytest

from tabrail.llm import spotsigs as S
from tabrail.llm.common import table


def test_signatures():
    import zlib

    got = S.signatures("The big dog of a small house.")
    assert set(got.tolist()) == {zlib.crc32(x) for x in (b"the big dog", b"of small house", b"a small house")}
    assert len(S.signatures("")) == 0 and len(S.signatures("!!")) == 1 and len(S.signatures("HELLO there")) == 2
    assert S.jaccard(S.signatures(""), S.signatures("")) == 1.0
    assert set(S.signatures("the b c the d e f", chain=3).tolist()) == {zlib.crc32(b"the d e f")} | {zlib.crc32(b"the b c d")}


def check(rows, got):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    want = []
    for (i, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        t, nxt = t or "", nxt or ""
        h = len(t) // 2
        e = t[:len(t) - h] + nxt[:h]
        s, es = S.signatures(t), S.signatures(e)
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), S.text_form(s), S.text_form(es), S.jaccard(s, es), S.jaccard(s, S.signatures(nxt))))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)


def test_documents_against_brute_force(spark):
    df = table(spark, "/root/testdata/sf0.001", "documents")
    check([(r.doc_id, r.text) for r in df.collect()], S.compare_with_edits(df).collect())


def test_odd_rows(spark):
    rows = [(5, "the quick fox and the dog"), (None, None), (5, "the quick fox and the dog"), (5, "é𝄞" * 50), (-3, ""), (2**40, "x")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, part int")
    check(rows, S.compare_with_edits(df).collect())
    assert S.compare_with_edits(df.limit(0)).count() == 0
    check([(1, "one two")], S.compare_with_edits(spark.createDataFrame([(1, "one two")], "doc_id long, text string")).collect())


def test_near_pairs(spark):
    df = table(spark, "/root/testdata/sf0.001", "documents")
    members, pairs = S.near_pairs(df, 0.8)
    sigs = {r.doc_id: S.signatures(r.text) for r in df.collect()}
    rep = {r.doc_id: r.rep for r in members.collect()}
    assert all(S.jaccard(sigs[i], sigs[j]) == 1.0 for i, j in rep.items())
    got = {frozenset((r.a, r.b)): r.likeness for r in pairs.collect()}
    reps = {rep[i] for i in rep if len(sigs[i])}
    want = {frozenset(p): S.jaccard(sigs[p[0]], sigs[p[1]]) for p in itertools.combinations(sorted(reps), 2) if S.jaccard(sigs[p[0]], sigs[p[1]]) >= 0.8}
    assert got == pytest.approx(want) and want
