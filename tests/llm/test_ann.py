import numpy as np
import pytest

from tabrail.llm import ann
from tabrail.llm.common import table


def brute(ids, x, every, k):
    u = x / np.sqrt((x * x).sum(axis=1))[:, None]
    out = {}
    for i, q in zip(ids, u):
        if i % every == 0:
            s = u @ q
            order = sorted((-round(float(a), 12), int(j)) for a, j in zip(s, ids) if j != i)[:k]
            out[int(i)] = order
    return out


def test_recall_scores_and_ties(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = df.select("vec_id", "embedding").collect()
    want = brute([r[0] for r in rows], np.array([r[1] for r in rows], float), ann.EVERY, ann.K)
    got = {}
    for r in ann.nearest(df).collect():
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == set(want)
    hit = 0
    for q, rs in got.items():
        rs.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rs] == [1, 2, 3, 4, 5]
        assert sorted([(-r.score, r.vec_id) for r in rs]) == [(-r.score, r.vec_id) for r in rs]
        hit += len({r.vec_id for r in rs} & {j for _, j in want[q]})
        assert rs[0].score == pytest.approx(-want[q][0][0], abs=1e-9) or rs[0].vec_id != want[q][0][1]
    assert hit / (5 * len(want)) >= 0.9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
         (100, [0.0, -1.0]), (None, [1.0, 1.0]), (8, [1.0]), (9, []), (10, [1.0, 0.0]), (11, [1.0, 0.0]), (12, [1.0, 0.0]), (13, [1.0, 0.0])]
    df = spark.createDataFrame([(i, x, "q") for i, x in v], "vec_id long, embedding array<float>, point string")
    got = {}
    for r in ann.nearest(df).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert [x[1] for x in sorted(got[0])] == [1, 2, 10, 11, 12] and sorted(got[0])[0][2] == 1.0
    assert [x[1] for x in sorted(got[50])] == [0, 1, 2, 10, 11] and [x[1] for x in sorted(got[100])] == [0, 1, 2, 10, 11]
    assert ann.nearest(df.limit(0)).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.vec_id) for r in ann.nearest(few).collect()] == [(0, 1)]


def test_repeated_rows_count_once(spark, monkeypatch):
    x = np.random.default_rng(6).standard_normal((300, 6))
    x[7::20] = x[7]  # a vector of several ids, each of them repeated
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    kind = "vec_id long, embedding array<double>"
    key = lambda df: sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in ann.nearest(df).collect())
    for cell_rows in (ann.CELL_ROWS, 40):
        monkeypatch.setattr(ann, "CELL_ROWS", cell_rows)
        got = key(spark.createDataFrame(rows * 10, kind))
        assert len(got) == 6 * 5 and len({r[:2] for r in got}) == len({(r[0], r[2]) for r in got}) == 30
        want = brute(range(300), x, 50, 5)
        assert sum((r[2] in {j for _, j in want[r[0]]}) for r in got) >= 27


def test_an_id_with_several_vectors(spark):
    rows = [(0, [1.0, a / 100]) for a in range(12)] + [(i, [1.0, i / 10]) for i in range(1, 8)] + [(1, [2.0, 0.2])] * 3 + [(0, [1.0, 0.0])] * 9
    got = {}
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        got.setdefault(r["rank"], []).append((r.query_id, r.vec_id))
    # Twelve queries of id 0, none of which answers with id 0; both rows of id 1 count, though they are equally near.
    assert {k: len(v) for k, v in got.items()} == dict.fromkeys(range(1, 6), 12) and all(v > 0 for x in got.values() for _, v in x)
    assert set(got[1]) == set(got[2]) == {(0, 1)} and set(got[3]) == {(0, 2)} and set(got[5]) == {(0, 4)}


def test_chunks_of_full_cells(spark, monkeypatch):
    """Past the most cells, points go in chunks; answers stay those of brute force."""
    monkeypatch.setattr(ann, "MOST_CELLS", 2)
    monkeypatch.setattr(ann, "CELL_ROWS", 40)
    x = np.random.default_rng(5).standard_normal((400, 6))
    x[1::4] = x[1]  # a vector that a quarter of the rows share
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want, got = brute(range(400), x, 50, 5), {}
    for r in ann.nearest(df).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hit = sum(len({v for _, v in got[q]} & {j for _, j in want[q]}) for q in want)
    assert hit / (5 * len(want)) >= 0.9


def test_chi_square():
    assert ann.chi2_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)


def _clustered(n, seed=3):
    """Points around n / 50 centres: near neighbours are much nearer than the rest."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 50, 32))
    return ann.unit(centres[np.arange(n) % len(centres)] + 0.15 * rng.standard_normal((n, 32)))


def test_verified_points_do_not_grow_with_the_rows():
    """Over 10 and 100 times the rows a query verifies about as many points, at the same recall."""
    limit, seen_of = ann.chi2_quantile(1 - ann.MISS, ann.DIMS), {}
    for n in (2_000, 20_000, 200_000):
        x = _clustered(n)
        q = np.arange(0, n, n // 40)
        seen: list[int] = []
        found = ann.search_cell(x, x[q], np.full(len(q), 0.5), limit, ann.K + 1, None, seen)
        s = x[q] @ x.T
        top = np.argsort(-s, axis=1)[:, :ann.K + 1]
        assert np.mean([len(set(f) & set(t)) / len(t) for f, t in zip(found, top)]) >= 0.9
        seen_of[n] = np.mean(seen)
    assert seen_of[200_000] < 8 * seen_of[2_000] and seen_of[200_000] < 0.01 * 200_000, seen_of


def test_other_cells_are_pruned(spark, monkeypatch):
    """A query's own cell bounds it so well that few others are visited."""
    monkeypatch.setattr(ann, "CELL_ROWS", 256)
    x = _clustered(10_000)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    tree = ann.TopTree(x[:ann.SAMPLE] @ ann.projection(32), 40)
    q, limit = x[::50], ann.chi2_quantile(1 - ann.MISS, ann.DIMS)
    near = -np.sort(-(q @ x.T), axis=1)[:, ann.K]
    open_ = tree.gaps(q @ ann.projection(32)) <= limit * (2 - 2 * near)[:, None]
    assert open_.sum(axis=1).mean() < 0.5 * 40
    want, got = brute(range(10_000), x, 50, 5), {}
    for r in ann.nearest(df).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[i] & {j for _, j in want[i]}) / 5 for i in want]) >= 0.9
