"""Importance resampling against a plain computation, and the sort by regular sampling by itself."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tabrail.llm import resampling as X
from tabrail.llm.common import stage, table

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_features(text):
    words = WORD.findall(lower(text or ""))
    runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]


def plain(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(plain_features(text)[1])
    for text in target:
        t.update(plain_features(text)[1])
    ss, tt = sum(s.values()), sum(t.values())
    rows = []
    for ident, text in docs:
        words, found = plain_features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (ss + 10000) / ((s[b] + 1) * (tt + 10000)))) for b in found)
        h = int(hashlib.sha256(f"42:{'' if ident is None else ident}".encode()).hexdigest()[:8], 16)
        rows.append([ident, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[:5 * len(able) // 100]
    return rows, drawn


def test_values_of_runs():
    rng = random.Random(5)
    texts = ["", "a", "  lone  ", "x" * 63 + " " + "y" * 64 + " " + "z" * 65 + " é" * 40, "w " * 3 + "q" * 5000 + " end",
             *["".join(rng.choice("aZ09 .é漢\x7f\x80'") for _ in range(rng.randrange(400))) for _ in range(60)]]
    data = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    bucket, row, words = X.features(X.Crc(), X._word_bytes(), np.frombuffer(b"".join(data), np.uint8), off)
    for i, t in enumerate(texts):
        n, want = plain_features(t)
        assert words[i] == n
        assert sorted(bucket[row == i].tolist()) == sorted(want)


def test_query_is_the_plain_computation(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    target = [r.text for r in table(spark, sf, "benchmark").collect()]
    rows, drawn = plain(docs, target)
    got = X.op11_regular_sampling(spark, sf).collect()
    assert sorted(tuple(r)[:4] for r in got) == sorted(tuple(r[:4]) for r in rows)
    assert [r.doc_id for r in sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])] == [r[0] for r in drawn]
    assert sorted(r["rank"] for r in got if r["rank"] is not None) == list(range(1, len(drawn) + 1))
    assert len(drawn) > 0


def test_odd_rows(spark):
    long = " ".join(f"w{i % 91}" for i in range(200_000))
    docs = [(1, None, 0), (2, "", 0), (None, "one two three " * 9, 0), (3, "one two three " * 9, 0), (3, "one two three " * 9, 0), (4, long, 0), (5, "short text", 0)]
    docs += [(k, f"word {k} " * 30, 0) for k in range(10, 100)]
    df = spark.createDataFrame(docs, "doc_id long, text string, rank int")
    target = ["one two three four", None, ""]
    rows, drawn = plain([d[:2] for d in docs], target)
    got = X.resample(df, spark.createDataFrame([(t,) for t in target], "text string")).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:4])
    assert sorted((tuple(r)[:4] for r in got), key=key) == sorted((tuple(r[:4]) for r in rows), key=key)
    assert [r.doc_id for r in sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])] == [r[0] for r in drawn]
    empty = X.resample(df.limit(0), spark.createDataFrame([("a b",)], "text string"))
    assert empty.columns == ["doc_id", "n_features", "weight", "score", "rank"] and empty.count() == 0
    assert X.resample(df, spark.createDataFrame([], "text string")).count() == len(docs)


def test_ranks_with_hot_scores_and_repeated_rows(spark):
    # A third of the rows are one row, repeated; another third share a score.
    n = 9000
    rows = spark.range(0, n, 1, 12).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit(1).cast("long").alias("n_features"), F.lit(0).cast("long").alias("weight"),
        F.when(F.col("id") % 3 == 2, F.col("id") * 7919 % 4000).otherwise(2000).cast("long").alias("score"), (F.col("id") % 10 != 4).alias("enough"),
    ).withColumn("seq", F.monotonically_increasing_id())
    scored = stage(rows, "scored-test")
    able = scored.where("enough").count()
    for take in (0, 1, 2500, able):
        got = X.rank_highest(scored, take, able, 8).collect()
        assert len(got) == n
        order = sorted((r for r in got if r.enough), key=lambda r: (-r.score, r.doc_id, r.seq))
        assert [r["rank"] for r in order] == [*range(1, take + 1), *[None] * (able - take)]
        assert all(r["rank"] is None for r in got if not r.enough)
