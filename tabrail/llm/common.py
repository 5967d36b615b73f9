"""Shared helpers: tables, staged Parquet, row keys, bounded sketches, components."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabrail.config import shared_root

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder (``spark.checkpoint.dir``)
    and read it back: cuts the lineage, survives lost executors. The folder is
    deleted when the driver's file system closes."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/tabrail-llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete a staged table that nothing will read again."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for d in sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()}):
        p = jvm.org.apache.hadoop.fs.Path(d)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, doc_id, text) with a unique, ordered ``key`` and no null text."""
    return keyed_rows(docs, id_col, text_col)[0]


def keyed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> tuple[DataFrame, bool]:
    """(key, doc_id, text) and whether the keys are the ids; with ``carry`` also ``row``, all columns as a struct.

    Unique non-null ids are their own keys. Otherwise (null or repeated ids)
    rows are numbered in (doc_id, text) order, nulls first; the numbering is
    stored, so every later read sees the same keys.
    """
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] * carry
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *whole)
    # One partial aggregate per id; only the number of ids that repeat comes back.
    odd = base.groupBy("doc_id").count().where("doc_id is null or count > 1").limit(1).count()
    if not odd:
        return base.select(F.col("doc_id").alias("key"), *base.columns), True
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    digest = F.sha2("text", 256)
    tagged = stage(
        base.withColumn("d", digest).repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "d", F.rand(7))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "d")
        .withColumn("tag", F.monotonically_increasing_id()).drop("d"), "keyed")
    part, within = F.shiftrightunsigned("tag", 33), F.col("tag").bitwiseAND(F.lit((1 << 33) - 1))
    counts = tagged.groupBy(part.alias("part")).count()
    start = counts.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("start"))
    return tagged.withColumn("part", part).join(start, "part").select((F.col("start") + within).alias("key"), *base.columns), False


def kept_in_worker(name: str, make: Callable):
    """``make()`` once per Python worker process; later tasks of the worker find it again."""
    import __main__

    own = __main__.__dict__.setdefault("_tabrail_kept", {})
    if name not in own:
        own[name] = make()
    return own[name]


def free_memory() -> None:
    """Give freed memory of a Python worker back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library, which keeps what it has


def lean(run: Callable, keep: str | None = None) -> Callable:
    """``run`` for mapInArrow or mapInPandas, with what earlier jobs kept in
    the worker dropped before it (but for ``keep``), and its own memory given
    back after it: workers outlive their jobs, and executors count them all."""
    def wrapped(batches):
        import __main__

        own = __main__.__dict__.setdefault("_tabrail_kept", {})
        for name in [n for n in own if n != keep]:
            del own[name]
        try:
            yield from run(batches)
        finally:
            free_memory()

    return wrapped


def texts_of(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column (null: empty)."""
    col = batch.column(name)
    if pa.types.is_dictionary(col.type):
        col = col.dictionary_decode()
    if not (pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)):
        col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.cast(pa.large_binary()).fill_null(b"")
    _, off, data = col.buffers()
    o = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    d = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return d[o[0]:o[-1]] if len(o) else d[:0], o - o[0] if len(o) else np.zeros(1, np.int64)


def spans_of(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each (a longer row comes alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: Counts of one sketch block travel as one row.
SKETCH_BLOCK = 1 << 14


#: Hashes that are counted at once.
COUNT_AT_ONCE = 1 << 18


def bucket_counts(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterable[np.ndarray]], bits: int) -> np.ndarray:
    """Counts of ``hash mod 2**bits`` over all rows, a fixed-size table.

    ``hashes`` gives the uint64 hashes of a batch, in arrays. Each task sums
    its own table of bytes (counts over 255 saturate: they are only compared,
    never reported), blocks are summed by key on the executors, and
    4 * 2**bits bytes reach the driver whatever the input's size.
    """
    size, block = 1 << bits, min(SKETCH_BLOCK, 1 << bits)

    def count(batches):
        own, held, n = np.zeros(size, np.uint8), [], 0

        def add():
            at, c = np.unique(np.concatenate(held) & U64(size - 1), return_counts=True)
            at = at.astype(np.int64)
            own[at] = np.minimum(own[at] + c, 255)

        for b in batches:
            for h in hashes(b):
                held.append(h)
                n += len(h)
                if n > COUNT_AT_ONCE:
                    add()
                    held, n = [], 0
        if held:
            add()
        for k in range(0, size, block):
            if own[k:k + block].any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([k // block], pa.int32()), "counts": pa.array([own[k:k + block].tobytes()], pa.binary())})

    def total(key, pdf):
        import pandas as pd

        s = np.zeros(block, np.int64)
        for c in pdf["counts"]:
            s += np.frombuffer(c, np.uint8)
        return pd.DataFrame({"block": [key[0]], "counts": [np.minimum(s, 2**32 - 1).astype(np.uint32).tobytes()]})

    rows = df.mapInArrow(lean(count), "block int, counts binary").groupBy("block").applyInPandas(total, "block int, counts binary").collect()
    out = np.zeros(size, np.uint32)
    for r in rows:
        out[r["block"] * block:(r["block"] + 1) * block] = np.frombuffer(r["counts"], np.uint32)
    return out


def components(nodes: DataFrame, links: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components: (id, comp) for every ``id`` of ``nodes``; comp is
    the smallest id reachable over ``links`` (a, b).

    Alternating large-star and small-star contraction of the edge list; a
    component of any size ends as a star around its smallest id in a
    logarithmic number of rounds. Each round is a partial ``min`` per node and
    a join, so a node with many links is never gathered. Only the number of
    edges that changed reaches the driver.
    """
    e = stage(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: every larger neighbour of u points at u's smallest neighbour.
        big = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low2 = big.groupBy("u").agg(F.min("v").alias("m"))
        # Small star: u and its smaller neighbours point at the smallest of them.
        small = big.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low2.select("u", F.col("m").alias("v")))
        new = stage(small.where("u != v").distinct(), "edges")
        # Settled when the edge set is a set of stars that no longer changes.
        if new.exceptAll(e).isEmpty() and e.exceptAll(new).isEmpty():
            break
        release(e)
        e = new
    else:
        raise RuntimeError(f"components are not settled after {rounds} rounds")
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    return nodes.select("id").join(low, F.col("id") == F.col("u"), "left").select("id", F.coalesce("m", "id").alias("comp"))
