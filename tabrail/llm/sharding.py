"""Sharding by a hierarchical weighted hash tree (regions, racks, shards).

Every level is a weighted hash draw: child ``c`` of weight ``w`` draws
``-ln(u(key, c)) / w`` and the smallest draw wins. A change of one child's
weight only moves keys into or out of that child, so movement is confined to
the subtrees whose weights change. DataFrame functions only.

Rows: a null id is a key of its own; a null text has 16 bytes; repeated rows
all get slots; texts of any length are hashed whole; other columns of the
input are not read, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabrail.llm.common import stage, table

#: Rows that get their slots in one sort group.
SLOT_BLOCK = 1 << 16


@dataclass(frozen=True)
class Tree:
    """``regions[r][k]`` maps the shards of rack k of region r to weights."""

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    @staticmethod
    def grid(shards: int, base: int = 40, per_rack: int = 5, racks: int = 2) -> "Tree":
        """Shards below ``base`` fill regions of ``racks`` racks; each later
        shard is a region of its own, so that growth by one shard adds one
        subtree at the root and takes keys only into itself."""
        def split(xs, n):
            return [xs[i:i + n] for i in range(0, len(xs), n)]

        first = [(s, 1.0) for s in range(min(shards, base))]
        regions = [tuple(tuple(k) for k in split(r, per_rack)) for r in split(first, per_rack * racks)]
        regions += [(((s, 1.0),),) for s in range(base, shards)]
        return Tree(tuple(regions))

    def weight(self, r: int, k: int | None = None) -> float:
        racks = self.regions[r] if k is None else (self.regions[r][k],)
        return float(sum(w for rack in racks for _, w in rack))


def _unit(key: Column, *node: Column) -> Column:
    """Uniform in (0, 1) from the key and the node's name."""
    h = F.shiftrightunsigned(F.xxhash64(key, *node), 11)
    return (h.cast("double") + 0.5) * F.lit(2.0 ** -53)


def _draw(key: Column, children: Column, level: str, *path: Column) -> Column:
    """The child (id) with the smallest weighted draw; ties to the smaller id."""
    scored = F.transform(children, lambda c: F.struct(
        (-F.log(_unit(key, F.lit(level), *path, c["id"])) / c["w"]).alias("s"), c["id"].alias("id")))
    return F.array_min(scored)["id"]


def _children(pairs) -> Column:
    return F.array(*[F.struct(F.lit(int(i)).alias("id"), F.lit(float(w)).alias("w")) for i, w in pairs])


def place(df: DataFrame, tree: Tree, key: str, out: str) -> DataFrame:
    """Add column ``out``: the shard that the key's descent ends in."""
    regs = range(len(tree.regions))
    racks = F.array(*[_children([(k, tree.weight(r, k)) for k in range(len(tree.regions[r]))]) for r in regs])
    most = max(len(r) for r in tree.regions)
    leaves = F.array(*[F.array(*[_children(tree.regions[r][k] if k < len(tree.regions[r]) else [(-1, 1.0)]) for k in range(most)]) for r in regs])
    r, k = F.col("__r"), F.col("__k")
    return (df.withColumn("__r", _draw(F.col(key), _children([(i, tree.weight(i)) for i in regs]), "region"))
            .withColumn("__k", _draw(F.col(key), F.element_at(racks, r + 1), "rack", r))
            .withColumn(out, _draw(F.col(key), F.element_at(F.element_at(leaves, r + 1), k + 1), "shard", r, k))
            .drop("__r", "__k"))


def number(df: DataFrame, group: str, out: str) -> DataFrame:
    """Add ``out``: gapless long numbers from 0 inside each value of ``group``.

    Rows are stored once with their place in the writing task; a block is
    ``SLOT_BLOCK`` consecutive rows of one task, so no sort group grows with
    the data or with a hot key. Counts per (group, block) give the starts.
    """
    tagged = stage(df.withColumn("__tag", F.monotonically_increasing_id()), "slots")
    tagged = tagged.withColumn("__block", F.expr(f"__tag div {SLOT_BLOCK}"))
    counts = tagged.groupBy(group, "__block").agg(F.count(F.lit(1)).alias("__n"))
    start = counts.select(group, "__block", (F.sum("__n").over(
        Window.partitionBy(group).orderBy("__block").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")).alias("__start"))
    numbered = tagged.withColumn("__i", F.row_number().over(Window.partitionBy("__block", group).orderBy("__tag")) - 1)
    return (numbered.join(start, ["__block", group])
            .withColumn(out, (F.col("__start") + F.col("__i")).cast("long")).drop("__tag", "__block", "__start", "__i"))


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + 16).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = place(place(rows, Tree.grid(shards), "doc_id", "shard"), Tree.grid(shards + 1), "doc_id", "grown_shard")
    return number(placed, "shard", "slot").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op2_weighted_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
