"""Reproducible splits (S1, S2) and limits.

Both splits hash a row key with the seed instead of drawing random numbers,
so the assignment of a row does not depend on partitioning, file order or
task retries; ``randomSplit`` is offered only as a compatibility option.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabrail.operators.positions import number_rows, with_position


def key_text(key: Sequence[str]) -> Column:
    # Nulls have a text of their own, so (null, a) and (a, null) differ.
    return F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in key])


def split_hash(key: Sequence[str], seed: int, purpose: str) -> Column:
    """md5 hex of 'seed:purpose:key'; uniform over the hash space."""
    return F.md5(F.concat(F.lit(f"{seed}:{purpose}:"), key_text(key)))


def fraction_cutoff(fraction: float) -> str:
    """8 hex digits h such that md5 < h holds for ``fraction`` of rows; for
    1 a text above every digest."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    return "g" if fraction == 1.0 else format(math.floor(fraction * 2**32), "08x")


def bernoulli_split(
    df: DataFrame,
    key: Sequence[str],
    train_fraction: float = 0.8,
    seed: int = 42,
    part: str = "part",
) -> DataFrame:
    """Per-row split; adds ``part`` = 'train' or 'test'. No shuffle."""
    h = split_hash(key, seed, "bernoulli")
    return df.withColumn(
        part,
        F.when(h < F.lit(fraction_cutoff(train_fraction)), F.lit("train")).otherwise(F.lit("test")),
    )


#: Hex digits that one histogram pass adds (at most 16 ** DIGITS groups reach
#: the driver), and the number of rows under a prefix that ends the narrowing.
DIGITS = 4
FEW_ROWS = 20_000


def _narrow(df: DataFrame, h: str, rank_of: Callable[[int], int]) -> tuple[str, int]:
    """(prefix, rank inside it) of the ``rank_of(rows)``-th smallest (1-based)
    text in column ``h``; few rows, or equal texts alone, are left under the
    prefix. Rank 0: no prefix. Each pass counts rows per next hex digits; only
    counts reach the driver, so neither the rows nor a text that many of them
    share ever meet in one task."""
    prefix, rank = "", None
    while len(prefix) < 32:
        cur = df.where(F.col(h).startswith(prefix)) if prefix else df
        text = F.xxhash64(h)
        buckets = sorted(cur.groupBy(F.substring(h, 1, len(prefix) + DIGITS).alias("b")).agg(
            F.count(F.lit(1)).alias("n"), (F.min(text) == F.max(text)).alias("one")).collect())
        if rank is None:
            rank = rank_of(sum(r["n"] for r in buckets))
            if rank <= 0:
                return "", 0
        for r in buckets:
            if rank <= r["n"]:
                prefix = r["b"]
                break
            rank -= r["n"]
        else:
            raise ValueError("rank beyond the row count")
        if r["one"] or r["n"] <= FEW_ROWS:
            break
    return prefix, rank


def _cut(df: DataFrame, h: str, cols: Sequence[str], rank_of: Callable[[int], int]) -> tuple[tuple, int, int] | None:
    """The ``rank_of(rows)``-th smallest row (1-based) in (h, *cols) order as
    (values, rank among the rows equal to it, their number); none for rank 0."""
    prefix, rank = _narrow(df, h, rank_of)
    if not rank:
        return None
    few = df.where(F.col(h).startswith(prefix)).groupBy(h, *cols).agg(F.count(F.lit(1)).alias("_tr_n"))
    low = [F.col(c).asc_nulls_first() for c in [h, *cols]]
    for r in few.orderBy(*low).collect():
        if rank <= r["_tr_n"]:
            return tuple(r[c] for c in [h, *cols]), rank, r["_tr_n"]
        rank -= r["_tr_n"]
    raise ValueError("rank beyond the row count")


def _before(cols: Sequence[str], values: tuple) -> Column:
    """``cols`` < ``values`` in lexicographic order, nulls first."""
    cond = F.lit(False)
    for c, v in zip(reversed(list(cols)), reversed(values)):
        below = F.lit(False) if v is None else F.coalesce(F.col(c) < F.lit(v), F.lit(True))
        cond = below | (F.col(c).eqNullSafe(F.lit(v)) & cond)
    return cond


def _equal(cols: Sequence[str], values: tuple) -> Column:
    cond = F.lit(True)
    for c, v in zip(cols, values):
        cond = cond & F.col(c).eqNullSafe(F.lit(v))
    return cond


def row_digest(cols: Sequence[str]) -> Column:
    """Digest of the whole row: equal for equal rows alone."""
    return F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols]), {"ignoreNullFields": "false"}))


def exact_split(
    df: DataFrame,
    key: Sequence[str],
    test_fraction: float = 0.2,
    seed: int = 42,
    part: str = "part",
    position: str | None = "id",
) -> DataFrame:
    """Exact-count split: the first ceil(test_fraction * n) rows in
    (hash, key) order are 'test', the rest 'train' (20640 -> 16512 + 4128).

    The cutoff comes from counts over the key columns alone; the split itself
    is a filter with literal bounds on the source, and nothing is stored.
    Where the cutoff falls inside a repeated key, its rows are settled in the
    same way by counts of their whole-row digests; only rows that are equal
    in every column and straddle the cutoff are stored, to be numbered.

    With ``position`` set, the test rows are numbered 0..k-1 in hash order
    (the replay ids, equal keys by row digest); train rows get null.
    """
    whole = list(df.columns)
    order = ["_tr_h", *key]
    hashed = df.withColumn("_tr_h", split_hash(key, seed, "exact"))
    keys_only = hashed.select(*order)
    found = _cut(keys_only, "_tr_h", key, lambda n: math.ceil(n * float(test_fraction)))
    tied = None
    if found is None:
        is_test = F.lit(False)
    else:
        cut, taken, ties = found
        is_test = _before(order, cut)
        at_cut = _equal(order, cut)
        if taken == ties:
            is_test = is_test | at_cut
        else:
            # The cutoff's key repeats: the same search among its rows.
            digest = row_digest(whole)
            same, taken, ties = _cut(hashed.where(at_cut).select(digest.alias("_tr_d")), "_tr_d", [], lambda _, rank=taken: rank)
            is_test = is_test | (at_cut & (digest < F.lit(same[0])))
            if taken == ties:
                is_test = is_test | (at_cut & (digest == F.lit(same[0])))
            else:
                twin = at_cut & (digest == F.lit(same[0]))
                tied = number_rows(hashed.where(twin), "_tr_tie").withColumn(
                    part, F.when(F.col("_tr_tie") < taken, F.lit("test")).otherwise(F.lit("train"))).drop("_tr_tie")
                hashed = hashed.where(~twin)
    out = hashed.withColumn(part, F.when(is_test, F.lit("test")).otherwise(F.lit("train")))
    if tied is not None:
        out = out.unionByName(tied)
    out = out.drop("_tr_h")
    if position:
        train = out.where(F.col(part) == "train").withColumn(position, F.lit(None).cast("long"))
        out = test_positions(out, key, seed, part, position).unionByName(train)
    return out


def test_positions(split: DataFrame, key: Sequence[str], seed: int = 42, part: str = "part",
                   position: str = "id") -> DataFrame:
    """The test rows of an exact split, numbered 0..k-1 in hash order (equal
    keys by row digest). The cutoff is not searched again and the train rows
    are not read."""
    digest = row_digest([c for c in split.columns if c != part])
    test = split.where(F.col(part) == "test").withColumn("_tr_h", split_hash(key, seed, "exact"))
    # The last columns part rows with equal keys, so that the range sort
    # can deal them to several tasks.
    return with_position(test, ["_tr_h", *key, digest, F.monotonically_increasing_id()], name=position).drop("_tr_h")


test_positions.__test__ = False  # no test case, whatever its name begins with


# --- limits -----------------------------------------------------------------

# Above this many rows a top-k would gather too much in one task; take the
# rows by global position instead (a filter, evaluated in parallel).
TOP_K_MAX = 100_000


def head_n(df: DataFrame, n: int | None, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows by ``order``; None or 0 means all rows."""
    if not n:
        return df
    if n <= TOP_K_MAX:
        return df.orderBy(*order).limit(int(n))
    return with_position(df, order, name="_tr_pos").where(F.col("_tr_pos") < n).drop("_tr_pos")


def sample_rows(df: DataFrame, cols: Sequence[str], order: Sequence[str], n: int = 10) -> DataFrame:
    """The few rows a report shows, in a fixed order."""
    return df.orderBy(*order).limit(n).select(*cols)


def last_n(df: DataFrame, n: int, order: str) -> DataFrame:
    """Newest ``n`` rows by ``order`` (top-k, no full sort), oldest first
    when sorted ascending afterwards."""
    if n is None or n < 0:
        raise ValueError("n must be >= 0")
    return df.orderBy(F.col(order).desc()).limit(int(n))
