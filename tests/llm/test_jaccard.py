import random
import re

import numpy as np
from pyspark.sql import functions as F

from tabrail.llm import jaccard as J
from tabrail.llm.common import table


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted(((rows[i][0], len(sets[i]), rows[find(i)][0]) for i in range(len(rows))), key=str)


def got(df, k, percent):
    return sorted((tuple(r) for r in J.near_duplicates(df, k, percent).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_documents_against_brute_force(spark):
    df = table(spark, "/root/testdata/sf0.01", "documents")
    rows = sorted((r.doc_id, r.text) for r in df.collect())
    assert got(df, 3, 90) == brute(rows, 3, 90)


def test_chains_strays_and_groups(spark):
    r = random.Random(9)
    base = [f"w{r.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(150):  # near copies with one to five changed words: some link only over others
        t = list(base)
        for _ in range(r.randrange(1, 6)):
            t[r.randrange(len(t))] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    common = " ".join(base[:30])
    rows += [(200 + i, common + " " + " ".join(f"y{r.randrange(10**6)}" for _ in range(40 + i))) for i in range(60)]
    rows += [(300 + i, r.choice(["One Two", "one two", "ONE\ttwo ", "é É", "é", "", "  ", "a b c", "a b c d"])) for i in range(40)]
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, cid string")
    for k, percent in ((3, 90), (5, 80), (1, 100)):
        assert got(df, k, percent) == brute(rows, k, percent)


def test_links_inside_a_group_that_miss_its_first_member(spark):
    # Sets of one size whose prefixes often agree: the third links with the second, neither with the first.
    rows, r = [], random.Random(1)
    for seed in range(40):
        base = [f"w{seed}_{i}" for i in range(60)]
        for i, changed in enumerate(((0, 7), (20, 27), (20, 26))):
            t = list(base)
            for k in range(*changed):
                t[k] = f"z{seed}_{changed[0]}_{k}_{r.randrange(3)}"
            rows.append((3 * seed + i, " ".join(t)))
    want = brute(rows, 1, 80)
    assert len({c for _, _, c in want}) > 40
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80) == want


def test_bitmaps_of_long_sets_across_a_doubling(spark):
    # Sizes on both sides of 2048, where whole bitmaps differ in length, and chains over band borders.
    r, rows = random.Random(5), []
    base = [f"w{i}" for i in range(2200)]
    for i in range(30):
        t = base[:r.randrange(1950, 2200)]
        for _ in range(r.randrange(0, 40)):
            t[r.randrange(len(t))] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    rows += [(100 + i, " ".join([*base[:5], *(f"y{r.randrange(10**6)}" for _ in range(2040 + i))])) for i in range(10)]
    rows += [(200 + i, " ".join(f"v{k}" for k in range(10 + i))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for k, percent in ((3, 90), (5, 80)):
        assert got(df, k, percent) == brute(rows, k, percent)


def test_odd_rows(spark):
    rows = [(None, None), (4, "same text here now"), (4, "same text here now"), (2, "same text here now"), (None, "same text here now"), (9, None), (9, "a" * 100_000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, comp int")
    out = J.near_duplicates(df, 3, 90).collect()
    assert len(out) == 7 and sum(r.component_id is None for r in out) == 5
    assert J.near_duplicates(df.limit(0)).count() == 0
    kept = J.jaccard_stage(spark, df, "")
    assert kept.columns == df.columns and sorted([tuple(r)[1] or "" for r in kept.collect()], key=len)[:3] == ["", "", "same text here now"] and kept.count() == 4


def test_stage_keeps_the_first_of_each_component(spark):
    df = table(spark, "/root/testdata/sf0.001", "documents")
    rows = sorted((r.doc_id, r.text) for r in df.collect())
    want = sorted(i for i, _, c in brute(rows, 5, 80) if i == c)
    assert sorted(r.doc_id for r in J.jaccard_stage(spark, df, "").collect()) == want
    assert J.jaccard_stage(spark, df, "").schema == df.schema
    assert df.filter(F.col("doc_id") < 0).count() == 0


def test_unlike_long_texts_of_a_block_make_no_pairs(spark):
    # Forty texts of some 1500 words and of over 5000, nothing in common but their block, and one near copy.
    r = random.Random(3)
    texts = [[f"w{r.randrange(10**9)}" for _ in range(n)] for n in [*range(1500, 1540), *range(5000, 5010)]]
    texts.append([*texts[0][:1490], *(f"x{i}" for i in range(10))])
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "key long, text string")
    sig = J.signatures(rows, 5, 80)
    mixed = sig.select(F.lit(1).alias("tok"), F.col("key").alias("cid"), F.col("key").alias("comp"), "n", "few", J._folded("bits", J.LONG).alias("long"), F.lit(0).cast("long").alias("main"))
    assert [sorted(p) for p in J.pairs_across(mixed, 80).collect()] == [[0, 50]]
    assert {r.w for r in mixed.select(F.size("long").alias("w")).collect()} == {32, 64}


def test_prefix_rows_are_moved_once(spark, capsys):
    rows = [(1, 10, 5, 1), (1, 11, 5, 1), (2, 12, 6, 1), (3, 13, 7, 2), (4, 14, 8, 3), (5, 15, 9, 2), (5, 16, 9, 1)]
    token = spark.createDataFrame(rows, "tok long, gid long, n int, members long")
    found = J.in_blocks(token)
    assert sorted(tuple(r) for r in found.select("tok", "gid", "n", "c").collect()) == [
        (1, 10, 5, 2), (1, 11, 5, 2), (4, 14, 8, 3), (5, 15, 9, 3), (5, 16, 9, 3)]
    found.explain()
    assert capsys.readouterr().out.count("Exchange ") == 1


def test_star_needs_no_exchange_of_its_own(spark):
    # Size classes at 90 percent: 94 to 102 are of one, 90 of the class below, 140 links with none of them.
    rows = [(1, 10, 100, 1), (1, 11, 101, 1), (2, 10, 100, 1), (2, 12, 90, 1), (2, 11, 101, 1), (3, 10, 100, 1), (3, 11, 101, 1), (3, 13, 102, 1),
            (4, 14, 140, 1), (4, 12, 90, 1), (4, 10, 100, 1), (5, 15, 100, 3), (6, 15, 100, 3), (6, 10, 100, 1), (7, 16, 50, 1)]
    token = spark.createDataFrame(rows, "tok long, gid long, n int, members long")
    nb = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / 90))).alias("nb")
    found = J.star(J.in_blocks(token).select("tok", "gid", "n", nb, "groups", "c"), 90)
    got = {(r.tok, r.gid): (r.own, r.next, r.more) for r in found.collect()}
    assert got == {
        (1, 10): (None, None, False), (1, 11): (10, None, False),
        (2, 10): (None, None, False), (2, 12): (None, 10, True), (2, 11): (10, None, True),
        (3, 10): (None, None, False), (3, 11): (10, None, True), (3, 13): (10, None, True),
        (4, 14): (None, None, False), (4, 12): (None, 10, False), (4, 10): (None, None, False),
        (5, 15): (None, None, True), (6, 10): (None, None, True), (6, 15): (10, None, True)}
    plan = found.where("tok > 0")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1, plan


def test_every_pair_of_a_block_is_in_the_star_or_left_for_more(spark):
    rng = np.random.default_rng(5)
    sizes = {g: int(rng.integers(60, 125)) for g in range(400)}
    rows = [(t, int(g), sizes[int(g)], 1) for t in range(300) for g in rng.choice(400, rng.integers(2, 9), replace=False)]
    cls = lambda n: int(np.floor(np.log(n) / float(np.log(100 / 90))))
    rows = [r for r in rows if 41 <= cls(r[2]) <= 47]  # one band
    token = spark.createDataFrame(rows, "tok long, gid long, n int, members long")
    nb = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / 90))).alias("nb")
    got = {(r.tok, r.gid): r for r in J.star(J.in_blocks(token).select("tok", "gid", "n", nb, "groups", "c"), 90).collect()}
    blocks = {}
    for t, g, _, _ in rows:
        blocks.setdefault(t, []).append(g)
    pairs = starred = 0
    for t, gs in blocks.items():
        for a in gs:
            for b in gs:
                if a < b and min(sizes[a], sizes[b]) * 100 >= max(sizes[a], sizes[b]) * 90:
                    pairs += 1
                    x, y = got[t, a], got[t, b]
                    in_star = b in (x["own"], x["next"]) or a in (y["own"], y["next"])
                    starred += in_star
                    assert in_star or (x.more and y.more)
    assert pairs > starred > 200
    assert sum(not r.more for r in got.values()) > 200


def test_strays_carry_no_longer_bitmaps_than_their_sizes_ask_for(spark):
    texts = [" ".join(f"w{i}x{j}" for j in range(n)) for i, n in enumerate((40, 400, 700, 3000, 30_000))]
    rows = spark.createDataFrame(list(enumerate(texts)), "key long, text string")
    sig = J.signatures(rows, 3, 90)
    got = {r.key: (r.w, r.same) for r in sig.select("key", F.size(J.fitting(90)).alias("w"), (J.fitting(90) == F.col("few")).alias("same")).collect()}
    assert got == {0: (4, True), 1: (4, True), 2: (8, False), 3: (32, False), 4: (64, False)}
    assert {r.key: r.w for r in sig.select("key", F.size(J.fitting(80)).alias("w")).collect()} == {0: 4, 1: 8, 2: 16, 3: 64, 4: 64}
