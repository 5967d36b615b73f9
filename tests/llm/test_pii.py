import random
import re

import pytest
from pyspark.sql import functions as F

from tabrail.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    d = lambda m: re.sub("[^0-9]", "", m)
    ok = {"email": lambda m: True, "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
          "card": lambda m: 13 <= len(d(m)) <= 19 and luhn(d(m)), "phone": lambda m: 9 <= len(d(m)) <= 15}
    return {k: [(m.start(), m.end()) for m in p.finditer(text or "") if ok[k](m.group())]
            for k, p in (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))}


def random_texts(n):
    r = random.Random(5)
    parts = ["a@b.c", "x.y", "@", ".", "..", "-", "_", "1", "12", "4111 1111 1111 1111", "4111-1111-1111-111", "+1 (212) 555-0100", "+", " ", "é",
             "\u0001", "255.0.0.1", "256.1.1.1", "1.2.3", "000000255.1.1.1", "𝄞", "9", "0", "%", "mail", "(", ")", "\n"]
    return ["".join(r.choice(parts) for _ in range(r.randrange(1, 14))) for _ in range(n)]


def test_base_spans_equal_the_published_patterns(spark):
    texts = random_texts(3000) + [None, "", "a" * 200_000, "1" * 100_000, "a@" + "b." * 30_000 + "c", "1 " * 50_000, "+1" + "(" * 50_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find_spans(df).collect():
        want = brute(texts[r.doc_id]) if len(texts[r.doc_id] or "") < 1000 or r.doc_id == 3004 else None
        if want is not None:
            got = {k: [(s.start, s.end) for s in r[k]] for k in pii.BASE_KINDS}
            assert got == want, texts[r.doc_id][:200]


def test_checksums_context_and_redaction(spark):
    t = ["Transfer to iban DE89370400440532013000 now", "order DE89370400440532013001", "ssn 123-45-6789", "123-45-6789", "my card 4111 1111 1111 1111, mail a@b.co!"]
    rows = pii.find_spans(spark.createDataFrame(list(enumerate(t)), "doc_id long, text string")).transform(pii.redact, "red").orderBy("doc_id").collect()
    assert [(s.kind, s.start, s.end) for s in rows[0].iban] == [("iban", 17, 39)] and rows[0].iban[0].score == pytest.approx(1.0)
    assert not rows[1].iban and rows[2].ssn and not rows[3].ssn
    assert rows[4].red == "my card [CARD], mail [EMAIL]!" and rows[4].card[0].score > pii.PRIOR["card"]


def test_stage_keeps_columns_and_nulls(spark):
    df = spark.createDataFrame([(1, "a@b.co", 6, "x"), (None, None, None, None), (1, "a@b.co", 6, "x")], "doc_id long, text string, n_chars long, `m_email` string")
    out = pii.pii_stage(spark, df, "")
    assert out.schema == df.schema or out.columns == df.columns
    assert sorted([tuple(r) for r in out.collect()], key=str) == [(1, "[EMAIL]", 7, "x")] * 2 + [(None, None, None, None)]
    assert pii.find_spans(df.limit(0)).count() == 0
    assert out.filter(F.col("text") == "").count() == 0


def plain_redact(text, spans):
    out, at = "", 0
    for start, _, end, kind in sorted((s.start, -s.end, s.end, s.kind) for s in spans):
        if start >= at:
            out += text[at:start] + f"[{kind.upper()}]"
        at = max(at, end)
    return out + text[at:]


def test_many_spans_groups_and_context(spark, monkeypatch):
    texts = random_texts(400)
    r = random.Random(9)
    parts = ["mail a@b.co ", "10.0.0.1 ", "+1 (212) 555-0100,", "card 4111 1111 1111 1111 ", "é version 1.2.3.4\n", "words of no note ", "+1112223334", "x@y.zz,"]
    texts += ["".join(r.choice(parts) for _ in range(r.randrange(1, 60))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for go in (1, 3, 512):
        monkeypatch.setattr(pii, "GO", go)
        for row in pii.redact(pii.find_spans(df)).collect():
            text = texts[row.doc_id]
            assert {k: [(s.start, s.end) for s in row[k]] for k in pii.BASE_KINDS} == brute(text)
            spans = [s for k in pii.KINDS for s in row[k]]
            assert row.new_text == plain_redact(text, spans)
            for s in spans:
                near = (text[max(0, s.start - 40):s.start] + " " + text[s.end:s.end + 40]).lower()
                want = pii.PRIOR[s.kind] + 0.2 * bool(re.search(pii.CONTEXT[s.kind], near)) - 0.2 * bool(re.search(pii.AGAINST, near))
                assert s.score == pytest.approx(max(0.0, min(1.0, want))), (text, s)


def test_work_follows_the_text(spark):
    """One text of 32,000 addresses in about the time of many short ones that hold as many."""
    import time

    def seconds(df):
        t = time.monotonic()
        n = pii.redact(pii.find_spans(df)).agg(F.sum(F.size("email")), F.sum(F.length("new_text"))).first()
        return time.monotonic() - t, n

    line = "a@b.co,"
    short = spark.createDataFrame([(i, line * 500) for i in range(64)], "doc_id long, text string").coalesce(1)
    long = spark.createDataFrame([(0, line * 32_000)], "doc_id long, text string")
    seconds(short.limit(2))
    (a, n), (b, m) = seconds(short), seconds(long)
    assert n == m and b < 8 * a + 2, (a, b)
