"""Nearest neighbours by low-dimensional stable projections and a kd-tree.

Vectors are scaled to length 1 (then the order by distance is the order by
cosine) and projected by a Gaussian, that is 2-stable, matrix to ``DIMS``
dimensions: projected squared distance over true squared distance follows a
chi-square law with ``DIMS`` degrees of freedom. The top of a kd-tree over
the projections, split at medians of a bounded sample, deals every row into
cells; each cell holds a kd-tree of its own. A query is answered in its own
cell first, which bounds the distance of its k-th neighbour; then it visits
the other cells that may pass the test under that bound. Inside a cell it
walks leaves by growing projected distance and verifies points one chunk after
the other in the order of their own projected distances, until the chi-square
test says that what is left holds a nearer vector with probability ``MISS`` at
most; every chunk lowers the bound.

Equal vectors are one point of the index; of each the ``k + 1`` smallest ids
are kept, which is all that any answer can hold (ties go to smaller ids, and
a query leaves out only its own id), so a vector that a third of all rows
share costs one point.

Rows: vectors that are null, zero, of another length than most, or that hold
null or non-finite parts take no part; rows equal in id and vector count once,
as queries and as neighbours; an id with several vectors is a row, and a query
with neighbours of its own, for each of them; other columns are not read,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabrail.llm.common import stage, table

K, EVERY = 5, 50
#: Projected dimensions; chance of a miss per neighbour that ends a walk.
DIMS, MISS = 16, 0.08
#: Points verified before the first test; each further chunk is twice as long.
CHUNK = 64
#: Rows drawn for splits and first bounds (a documented, fixed bound); rows a cell should hold; leaf size.
SAMPLE, CELL_ROWS, MOST_CELLS, LEAF = 8192, 2048, 2048, 64
SEED = 20240607


def chi2_quantile(p: float, k: int) -> float:
    """x with P(chi-square_k <= x) = p, for even k (a Poisson sum), by bisection."""
    def cdf(x):
        term = total = 1.0
        for i in range(1, k // 2):
            term *= x / 2 / i
            total += term
        return 1 - np.exp(-x / 2) * total

    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return hi


def projection(d: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((d, DIMS))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


class TopTree:
    """kd splits at sample medians; ``cell_of`` deals rows, ``boxes`` bound the cells."""

    def __init__(self, points: np.ndarray, cells: int):
        self.splits: list[tuple[int, float, int, int]] = []  # axis, value, left, right; leaves are ~cell
        self.boxes: list[tuple[np.ndarray, np.ndarray]] = []
        self._build(points, cells, np.full(DIMS, -np.inf), np.full(DIMS, np.inf))

    def _build(self, p, cells, lo, hi) -> int:
        axis = int(np.argmax(p.max(axis=0) - p.min(axis=0))) if len(p) > 1 else 0
        value = float(np.median(p[:, axis])) if len(p) > 1 else 0.0
        left = p[:, axis] < value if len(p) > 1 else None
        if cells < 2 or len(p) < 2 or left.all() or not left.any():
            self.boxes.append((lo, hi))
            return ~(len(self.boxes) - 1)
        at = len(self.splits)
        self.splits.append((axis, value, 0, 0))
        mid_hi, mid_lo = hi.copy(), lo.copy()
        mid_hi[axis] = mid_lo[axis] = value
        a = self._build(p[left], cells // 2, lo, mid_hi)
        b = self._build(p[~left], cells - cells // 2, mid_lo, hi)
        self.splits[at] = (axis, value, a, b)
        return at

    def cell_of(self, p: np.ndarray) -> np.ndarray:
        out = np.zeros(len(p), np.int32)
        todo = [(0 if self.splits else ~0, np.arange(len(p)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = ~node
            else:
                axis, value, a, b = self.splits[node]
                left = p[rows, axis] < value
                todo += [(a, rows[left]), (b, rows[~left])]
        return out

    def gaps(self, p: np.ndarray) -> np.ndarray:
        """Squared distance of each point to each cell's box."""
        lo, hi = np.array([b[0] for b in self.boxes]), np.array([b[1] for b in self.boxes])
        return box_gaps(p, lo, hi)


def box_gaps(p, lo, hi):
    out = np.zeros((len(p), len(lo)))
    for a in range(p.shape[1]):
        x = p[:, a][:, None]
        g = np.maximum(np.maximum(lo[:, a][None] - x, x - hi[:, a][None]), 0)
        out += g * g
    return out


def leaves_of(p: np.ndarray) -> tuple[np.ndarray, list[slice], np.ndarray, np.ndarray]:
    """kd-tree leaves: row order, slices of it, tight boxes."""
    order, todo, slices = np.arange(len(p)), [(0, len(p))], []
    while todo:
        i, j = todo.pop()
        if j - i <= LEAF:
            slices.append(slice(i, j))
            continue
        rows = order[i:j]
        axis = int(np.argmax(p[rows].max(axis=0) - p[rows].min(axis=0)))
        m = (j - i) // 2
        order[i:j] = rows[np.argpartition(p[rows, axis], m, kind="introselect")]
        todo += [(i, i + m), (i + m, j)]
    lo = np.array([p[order[s]].min(axis=0) for s in slices])
    hi = np.array([p[order[s]].max(axis=0) for s in slices])
    return order, slices, lo, hi


def search_cell(points, qvecs, bounds, limit, k: int, own=None, seen: list | None = None):
    """For each query the nearest points of one cell: lists of points.

    ``bounds``: squared distance known to be reached by k neighbours; ``own``:
    for each query the points that it leaves out; ``seen`` takes the number of
    points that each query verified."""
    proj = projection(points.shape[1])
    p, q = points @ proj, qvecs @ proj
    order, slices, lo, hi = leaves_of(p)
    start = np.array([s.start for s in slices])
    size = np.array([s.stop - s.start for s in slices])
    p, x = p[order], points[order]
    gaps = box_gaps(q, lo, hi)
    found = []
    for i in range(len(q)):
        bound, verified = bounds[i], 0
        near = np.flatnonzero(gaps[i] <= limit * bound)
        if not len(near):
            found.append(np.empty(0, np.int64))
            if seen is not None:
                seen.append(0)
            continue
        # Projected neighbours in order: those of the leaves that may hold any.
        at = np.repeat(start[near] - np.concatenate([[0], np.cumsum(size[near])[:-1]]), size[near]) + np.arange(size[near].sum())
        gap = ((p[at] - q[i]) ** 2).sum(axis=1)
        keep = gap <= limit * bound
        at, gap = at[keep], gap[keep]
        turn = np.argsort(gap, kind="stable")
        at, gap = at[turn], gap[turn]
        if own is not None and len(own[i]):
            free = ~np.isin(order[at], own[i])
            at, gap = at[free], gap[free]
        best, dist, chunk = np.empty(0, np.int64), np.empty(0), CHUNK
        while verified < len(at) and gap[verified] <= limit * bound:
            # What the bound has closed since is not verified.
            part = at[verified:min(verified + chunk, int(np.searchsorted(gap, limit * bound, "right")))]
            verified, chunk = verified + len(part), 2 * chunk
            best, dist = np.concatenate([best, part]), np.concatenate([dist, np.maximum(2 - 2 * (x[part] @ qvecs[i]), 0)])
            if len(best) > k:
                # Ties at the edge stay: their ids decide later.
                edge = np.partition(dist, k - 1)[k - 1]
                keep = dist <= edge + 1e-9
                best, dist = best[keep], dist[keep]
                bound = min(bound, max(edge, 1e-12))
        found.append(order[best])
        if seen is not None:
            seen.append(verified)
    return found


_ASKED = "cell int, query_id long, query long, bound double, v array<double>"


def nearest(vectors: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for every row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(
        "id is not null and v is not null and size(v) > 0").where(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not size:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, total = size[0]["d"], size[0]["count"]
    # Rows equal in id and vector count once, before anything is cut; the partial aggregate drops them ahead of the shuffle.
    rows = (rows.where(F.size("v") == d).withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64("v", F.lit(1)))
            .groupBy("id", "h1", "h2").agg(F.first("v").alias("v")))
    # Equal vectors are one point. Row number keeps k + 1 ids a point, already before the shuffle.
    points = (rows.withColumn("i", F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))).where(F.col("i") <= k + 1)
              .groupBy("h1", "h2").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.min_by("v", "id").alias("v")))
    points = stage(points.withColumn("point", F.monotonically_increasing_id()).drop("h1", "h2"), "points")
    drawn = points.orderBy(F.xxhash64(F.element_at("ids", 1))).limit(SAMPLE).select("ids", "v").toPandas()
    sample = unit(np.array(drawn["v"].tolist(), float))
    sample_ids = np.array([i[0] for i in drawn["ids"]])
    cells = int(min(MOST_CELLS, max(1, -(-total // CELL_ROWS))))
    tree = TopTree(sample @ projection(d), cells)
    limit = chi2_quantile(1 - MISS, DIMS)
    shared = spark.sparkContext.broadcast((tree, sample, sample_ids, limit))

    def deal(batches):
        tree = shared.value[0]
        proj = projection(d)
        for b in batches:
            x = np.array(b["v"].tolist(), float)
            yield pd.DataFrame({"cell": tree.cell_of(unit(x) @ proj), "point": b["point"], "ids": b["ids"], "v": b["v"]})

    def ask(batches):
        """Queries at their own cell, with a first bound from the sample."""
        tree, sample, ids, _ = shared.value
        proj = projection(d)
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.iloc[at:at + 256]
                q = unit(np.array(part["v"].tolist(), float))
                # k other vectors of the sample bound the k-th distance from above.
                dist = np.maximum(2 - 2 * q @ sample.T, 0)
                dist[part["id"].to_numpy()[:, None] == ids[None]] = np.inf
                if dist.shape[1] >= k:
                    bound = np.maximum(np.partition(dist, k - 1, axis=1)[:, k - 1], 1e-12)
                else:
                    bound = np.full(len(q), np.inf)
                yield pd.DataFrame({"cell": tree.cell_of(q @ proj), "query_id": part["id"], "query": part["h1"], "bound": bound, "v": part["v"]})

    def route(batches):
        """Queries at the other cells that may hold a nearer vector."""
        tree, _, _, limit = shared.value
        proj = projection(d)
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.iloc[at:at + 256]
                p = unit(np.array(part["v"].tolist(), float)) @ proj
                open_ = tree.gaps(p) <= limit * part["bound"].to_numpy()[:, None]
                open_[np.arange(len(p)), part["cell"].to_numpy()] = False
                row, cell = np.nonzero(open_)
                yield pd.DataFrame({"cell": cell.astype(np.int32), **{c: part[c].to_numpy()[row] for c in ("query_id", "query", "bound", "v")}})

    def verify(key, pts, qs):
        if not len(pts) or not len(qs):
            return pd.DataFrame({"query_id": [], "query": [], "vec_id": [], "score": []})
        x, raw_q = np.array(pts["v"].tolist(), float), np.array(qs["v"].tolist(), float)
        limit = shared.value[3]
        norm, ids = np.sqrt((x * x).sum(axis=1)), pts["ids"].to_numpy()
        # Points that a query's id holds alone are left out, however many there are; each of the others has an answer.
        alone: dict[int, list[int]] = {}
        for j, i in enumerate(ids):
            if len(i) == 1:
                alone.setdefault(int(i[0]), []).append(j)
        found = search_cell(x / norm[:, None], unit(raw_q), qs["bound"].to_numpy(), limit, k + 1, [alone.get(i, []) for i in qs["query_id"]])
        out_q, out_r, out_v, out_s = [], [], [], []
        for query, row, own, best in zip(qs["query_id"], qs["query"], raw_q, found):
            if not len(best):
                continue
            score = (x[best] * own).sum(axis=1) / (norm[best] * np.sqrt((own * own).sum()))
            pairs = sorted(((-float(s), int(i)) for s, b in zip(score, best) for i in ids[b] if i != query))[:k]
            out_q += [query] * len(pairs)
            out_r += [row] * len(pairs)
            out_v += [i for _, i in pairs]
            out_s += [-s for s, _ in pairs]
        return pd.DataFrame({"query_id": np.array(out_q, np.int64), "query": np.array(out_r, np.int64), "vec_id": np.array(out_v, np.int64), "score": np.array(out_s, float)})

    dealt = points.mapInPandas(deal, "cell int, point long, ids array<long>, v array<double>")
    asked = rows.where(F.pmod("id", F.lit(every)) == 0).mapInPandas(ask, _ASKED)
    # Past MOST_CELLS cells their points go in chunks, and queries in blocks, so that neither side of a group grows without bound.
    chunks = max(1, -(-total // (cells * CELL_ROWS)))
    blocks = max(1, min(64, total // every // 4096))
    every_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("point"), F.lit(chunks)).cast("int")).withColumn("block", every_of(blocks))
    group = ["cell", "chunk", "block"]

    def answers(asked):
        asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).withColumn("chunk", every_of(chunks))
        return dealt.groupBy(*group).cogroup(asked.groupBy(*group)).applyInPandas(verify, "query_id long, query long, vec_id long, score double")

    asked = stage(asked, "asked")
    home = stage(answers(asked), "home")
    # What the own cell has found bounds the k-th distance.
    row = Window.partitionBy("query_id", "query").orderBy(F.desc("score"))
    reached = home.withColumn("i", F.row_number().over(row)).where(F.col("i") == k).select("query_id", "query", F.greatest(F.lit(1e-12), 2 - 2 * F.col("score") + 1e-9).alias("reached"))
    again = (asked.join(reached, ["query_id", "query"], "left").withColumn("bound", F.least("bound", F.coalesce("reached", "bound")))
             .select("cell", "query_id", "query", "bound", "v").mapInPandas(route, _ASKED))
    hits = home.unionByName(answers(again))
    # A row is in one cell and chunk, and a query in one block, so no pair comes twice.
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op9_stable_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
