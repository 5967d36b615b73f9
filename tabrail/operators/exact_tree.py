"""Regression trees with exact split search (M2).

Every threshold between two neighbouring values of every feature is tried, for
any number of distinct values: no bins and no sampled candidates. A level is
one pass: the rows are reduced to (node, feature, value) with count and label
sum in the map tasks, these are range-sorted once, prefix sums over the ranges
give both sides of every threshold, and the best one is chosen per task and
then per node. At most one row a node, and one a (range, node, feature),
reaches the driver; a value, feature or node that holds most rows is spread
like any other.

Ties go to the earlier feature, then to the smaller value. A row goes left
when its value is at or below the threshold, the middle between the two
neighbouring values of the node's rows. Rows without label are left out; a
null or NaN feature ends the fit, as in the forest.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabrail.config import scratch
from tabrail.functions.rules import any_of
from tabrail.operators.positions import grouped_prefix_sums

#: Gains below this share of a node's own sum of squares are rounding.
LEAST_GAIN = 1e-12


@dataclass
class Node:
    n: int
    total: float
    feature: str | None = None
    threshold: float | None = None

    @property
    def mean(self) -> float:
        return self.total / self.n


@dataclass
class ExactTree:
    """Nodes by heap number: the root is 1, the children of i are 2i and 2i + 1."""

    features: tuple[str, ...]
    nodes: dict[int, Node] = field(default_factory=dict)

    @property
    def depth(self) -> int:
        return max(i.bit_length() for i in self.nodes) - 1

    def _walk(self, leaf, i: int = 1) -> Column:
        node = self.nodes[i]
        if node.feature is None:
            return leaf(i)
        return F.when(F.col(f"`{node.feature}`") <= F.lit(node.threshold), self._walk(leaf, 2 * i)).otherwise(self._walk(leaf, 2 * i + 1))

    def leaf(self) -> Column:
        """Heap number of the leaf that a row ends in."""
        return self._walk(lambda i: F.lit(i))

    def prediction(self) -> Column:
        return self._walk(lambda i: F.lit(self.nodes[i].mean))

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.prediction())


def fit_exact_tree(df: DataFrame, features: Sequence[str], label: str = "target", max_depth: int = 1) -> ExactTree:
    """Grow the tree level by level to ``max_depth`` splits on a path."""
    features = tuple(features)
    data = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in features], F.col(label).cast("double").alias("_tr_y")).where("_tr_y is not null")
    bad = any_of(F.col(f"`{c}`").isNull() | F.isnan(f"`{c}`") for c in features)
    n, total, wrong = data.agg(F.count(F.lit(1)), F.sum("_tr_y"), F.count_if(bad)).first()
    if not n:
        raise ValueError("no rows to fit")
    if wrong:
        raise ValueError(f"{wrong} rows have a null or NaN feature")
    tree = ExactTree(features, {1: Node(n, total)})
    last = {1}
    for _ in range(max_depth):
        grown = set()
        with scratch(df.sparkSession):
            found = _best_splits(data, tree, last)
        for i, s in found.items():
            node = tree.nodes[i]
            own = node.total * node.total / node.n
            if s["score"] - own <= LEAST_GAIN * max(own, s["score"]):
                continue
            node.feature, node.threshold = features[-s["feature"]], s["threshold"]
            tree.nodes[2 * i] = Node(s["n"], s["total"])
            tree.nodes[2 * i + 1] = Node(node.n - s["n"], node.total - s["total"])
            grown |= {2 * i, 2 * i + 1}
        if not grown:
            break
        last = grown
    return tree


def _best_splits(data: DataFrame, tree: ExactTree, wanted: set[int]) -> dict[int, dict]:
    """Best split of each wanted leaf: one row a node reaches the driver."""
    pairs = ", ".join(f"{i}, `{c}`" for i, c in enumerate(tree.features))
    long = (data.withColumn("node", tree.leaf()).where(F.col("node").isin(sorted(wanted)))
            .selectExpr("node", "_tr_y", f"stack({len(tree.features)}, {pairs}) AS (feature, value)"))
    values = long.groupBy("node", "feature", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("_tr_y").alias("s"))
    sides = grouped_prefix_sums(values, ["node", "feature"], "value", ["n", "s"]).where("following is not null")
    ln, ls, rn, rs = F.col("n_upto"), F.col("s_upto"), F.col("n_all") - F.col("n_upto"), F.col("s_all") - F.col("s_upto")
    middle = (F.col("value") + F.col("following")) / 2
    # Neighbouring doubles have no middle between them.
    threshold = F.when(middle < F.col("following"), middle).otherwise(F.col("value"))
    best = sides.groupBy("node").agg(F.max(F.struct(
        (ls * ls / ln + rs * rs / rn).alias("score"), (-F.col("feature")).alias("feature"), (-F.col("value")).alias("value"),
        threshold.alias("threshold"), ln.alias("n"), ls.alias("total"))).alias("b"))
    return {r["node"]: r["b"].asDict() for r in best.collect()}
