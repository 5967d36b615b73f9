"""Global row positions and count-based rolling windows without a
single-partition window.

``with_position`` is the DataFrame form of ``zipWithIndex`` after a sort:
range-partition on the order, sort inside each partition, number rows
locally, then add the row count of all earlier partitions. The numbered
rows are written once (Parquet, shared work folder) so that counting and
numbering read the same stored ids. The per-partition
count table has one row per partition, so broadcasting it is bounded by the
partition count, not by the data.

``rolling_last_n`` evaluates a ``rowsBetween(-(n-1), 0)`` frame in blocks of
``block_rows`` consecutive positions; the last ``n-1`` rows of each block are
copied into the next one, so every frame is complete inside a block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabrail.config import scratch_dir

_LOCAL_BITS = 33  # monotonically_increasing_id: partition index << 33 | row


def _cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def with_position(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "pos",
    partitions: int | None = None,
    total: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Add ``name`` = zero-based position of the row in ``order``.

    ``order`` must be a total order (add a unique key as the last column);
    then the positions are deterministic and survive task retries. With
    ``total`` set, also add the row count of the whole frame.
    """
    spark = df.sparkSession
    cols = _cols(order)
    # A global sort is a range partitioning plus a sort inside each range;
    # without an explicit count AQE sizes the ranges from the data.
    if partitions:
        ranged = df.repartitionByRange(int(partitions), *cols).sortWithinPartitions(*cols)
    else:
        ranged = df.orderBy(*cols)
    # Store each row with its (range partition, row in partition) id in the
    # shared work folder: counting and numbering then read fixed values, and
    # a lost executor cannot re-draw the range bounds under them.
    stored = path or scratch_dir(spark, "positions")
    ranged.withColumn("_tr_mid", F.monotonically_increasing_id()).write.parquet(stored)
    tagged = spark.read.parquet(stored)
    tagged = tagged.withColumn("_tr_part", F.shiftright("_tr_mid", _LOCAL_BITS))
    # One row per range partition reaches the driver: the bound is the
    # partition count, not the data.
    counts = sorted(tuple(r) for r in tagged.groupBy("_tr_part").agg(F.count(F.lit(1))).collect())
    rows, seen = [], 0
    for part_id, n in counts:
        rows.append((part_id, seen))
        seen += n
    offsets = spark.createDataFrame(rows, "_tr_part long, _tr_offset long").withColumn(
        "_tr_total", F.lit(seen).cast("long"))
    out = tagged.join(F.broadcast(offsets), "_tr_part")
    local = F.col("_tr_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    out = out.withColumn(name, F.col("_tr_offset") + local)
    if total:
        out = out.withColumnRenamed("_tr_total", total)
    return out.drop("_tr_mid", "_tr_part", "_tr_offset", "_tr_total")


def number_rows(df: DataFrame, name: str = "pos") -> DataFrame:
    """Add ``name`` = 0, 1, 2, ... in no particular order. The rows are stored
    as their tasks hold them; nothing is shuffled, whatever their values."""
    spark = df.sparkSession
    stored = scratch_dir(spark, "numbered")
    df.withColumn("_tr_mid", F.monotonically_increasing_id()).write.parquet(stored)
    tagged = spark.read.parquet(stored).withColumn("_tr_part", F.shiftright("_tr_mid", _LOCAL_BITS))
    # One row per writing task reaches the driver.
    rows, seen = [], 0
    for part_id, n in sorted(tuple(r) for r in tagged.groupBy("_tr_part").agg(F.count(F.lit(1))).collect()):
        rows.append((part_id, seen))
        seen += n
    offsets = spark.createDataFrame(rows, "_tr_part long, _tr_offset long")
    local = F.col("_tr_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return tagged.join(F.broadcast(offsets), "_tr_part").withColumn(name, F.col("_tr_offset") + local).drop("_tr_mid", "_tr_part", "_tr_offset")


def grouped_prefix_sums(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    sums: Sequence[str],
) -> DataFrame:
    """Per group of ``group`` and in ``order``: inclusive prefix sums of the
    columns ``sums`` as ``<name>_upto``, their totals as ``<name>_all``, and
    the following value of ``order`` as ``following`` (null for the last).

    One global range sort, stored; a group of any size spreads over several
    ranges. One row per (range, group) reaches the driver: the caller keeps
    the number of groups bounded. ``order`` must be unique inside a group.
    """
    spark = df.sparkSession
    stored = scratch_dir(spark, "prefix-sums")
    df.orderBy(*group, order).withColumn("_tr_mid", F.monotonically_increasing_id()).write.parquet(stored)
    tagged = spark.read.parquet(stored).withColumn("_tr_part", F.shiftright("_tr_mid", _LOCAL_BITS))
    edges = tagged.groupBy("_tr_part", *group).agg(F.min(order).alias("_tr_first"), *[F.sum(c).alias(c) for c in sums]).collect()
    width = len(group)
    by_group: dict[tuple, list] = {}
    for r in sorted(edges, key=lambda r: r["_tr_part"]):
        by_group.setdefault(tuple(r[1:1 + width]), []).append(r)
    rows = []
    for g, parts in by_group.items():
        total = [sum(p[c] for p in parts) for c in sums]
        before = [t * 0 for t in total]
        for i, p in enumerate(parts):
            follow = parts[i + 1]["_tr_first"] if i + 1 < len(parts) else None
            rows.append((p["_tr_part"], *g, follow, *before, *total))
            before = [b + p[c] for b, c in zip(before, sums)]
    kinds = dict(df.dtypes)
    schema = ", ".join(["_tr_part long", *[f"`{g}` {kinds[g]}" for g in group], f"_tr_follow {kinds[order]}",
                        *[f"`{c}_before` {kinds[c]}" for c in sums], *[f"`{c}_all` {kinds[c]}" for c in sums]])
    offsets = spark.createDataFrame(rows, schema)
    inside = Window.partitionBy("_tr_part", *group).orderBy("_tr_mid")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    joined = tagged.join(F.broadcast(offsets), ["_tr_part", *group])
    return joined.select(
        *df.columns, *[(F.col(f"{c}_before") + F.sum(c).over(upto)).alias(f"{c}_upto") for c in sums],
        *[F.col(f"{c}_all") for c in sums], F.coalesce(F.lead(order).over(inside), F.col("_tr_follow")).alias("following"))


def rolling_last_n(
    df: DataFrame,
    pos: str,
    n: int,
    aggs: dict[str, Column],
    block_rows: int = 1 << 20,
) -> DataFrame:
    """Aggregates over the last ``n`` rows (by dense position ``pos``) at
    every row: the frame ``rowsBetween(-(n-1), 0)``.

    ``pos`` must be 0, 1, 2, ... without gaps (see ``with_position``).
    Work per task is bounded by ``block_rows + n - 1`` rows.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    block = max(int(block_rows), n)
    p = F.col(pos)
    home = F.floor(p / F.lit(block)).cast("long")
    spill = (p % F.lit(block)) >= F.lit(block - (n - 1))
    blocks = F.when(spill & F.lit(n > 1), F.array(home, home + 1)).otherwise(F.array(home))
    expanded = df.withColumn("_tr_home", home).withColumn("_tr_blk", F.explode(blocks))
    frame = Window.partitionBy("_tr_blk").orderBy(pos).rowsBetween(-(n - 1), 0)
    out = expanded.select(
        "*", *[agg.over(frame).alias(name) for name, agg in aggs.items()]
    )
    return out.where(F.col("_tr_blk") == F.col("_tr_home")).drop("_tr_blk", "_tr_home")
