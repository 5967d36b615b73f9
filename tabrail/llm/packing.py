"""Best-fit packing of token sequences by a grouping genetic algorithm.

A chromosome is a whole packing (a list of bins). Crossover injects well
filled bins of one parent into the other, drops the bins that now hold a
document twice, and best-fits the displaced documents, longest first.
Islands evolve apart in Spark tasks; after each epoch the elites migrate to
the other islands of the same cell. A cell is a bounded random share of the
pieces; badly filled bins of all cells are opened and packed once more.

Ids are those of the `tokenizers` library under its defaults: the vocabulary's
added tokens are found in texts first.

Rows: a null text is empty and holds the end id alone; null ids and repeated
rows are separate documents; texts of any length are cut into as many pieces as
they need; other columns are not read, whatever their names; an empty table
gives an empty result. Pieces of
the full length need no search and are sequences of their own.
"""

from __future__ import annotations

import json
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrail.llm.bpe import _RUN, WORDS, load_ranks
from tabrail.llm.common import kept_in_worker, lean, stage, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
CAPACITY, END_ID = 1024, 2
#: Pieces a cell holds on average; islands of a cell; epochs between which elites migrate.
CELL, ISLANDS, EPOCHS, POPULATION, CHILDREN, ELITES = 4096, 2, 2, 4, 6, 2
#: Bins under this fill are opened for the second level.
GOOD_FILL = 0.995


def added_tokens(path: str) -> dict[str, int]:
    """Text -> id of the JSON's added tokens, which no merge crosses."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f).get("added_tokens", [])
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in found):
        raise ValueError(f"{path}: added tokens that take in white space, stand alone or are normalized")
    return {t["content"]: t["id"] for t in found}


class Counter:
    """Ids as little-endian unsigned 32-bit bytes; recurring words are encoded once.

    Added tokens in a text are ids of their own and the parts between them are
    encoded apart, as the library does by default."""

    def __init__(self, path: str):
        ranks = load_ranks(path)
        self.added = {t: np.array([i], "<u4").tobytes() for t, i in added_tokens(path).items()}
        # The longest first, as the library prefers.
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else lambda text: [text]
        self.enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def raw(self, text: str) -> bytes:
        return np.array(self.enc.encode_ordinary(text), "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        parts = self.split(text)
        if len(parts) == 1:
            return self.ordinary(text)
        return b"".join(self.added[x] if i % 2 else self.ordinary(x) for i, x in enumerate(parts))

    def ordinary(self, text: str) -> bytes:
        if not text or _RUN.search(text):
            return self.raw(text)
        first, *rest = text.split(" ")
        known = self.known
        found = list(map(known.get, rest))
        if None in found:
            if len(known) > WORDS:
                known.clear()
            for i, x in enumerate(found):
                if x is None:
                    w = rest[i]
                    x = known.get(w)
                    if x is None:
                        x = known[w] = self.raw(" " + w)
                    found[i] = x
        return (self.raw(first) if first else b"") + b"".join(found)


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, the first may be shorter."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)] if n else []


def pieces(docs: DataFrame, path: str = TOKENIZER, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row, in one pass."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType

    def run(batches):
        count, end = kept_in_worker(f"count:{path}", lambda: Counter(path)), np.array([END_ID], "<u4").tobytes()
        for b in batches:
            out = []
            for i, t in enumerate(b.column("text")):
                ids = count(t.as_py() or "") + end
                out += [(i, k, s, n, zlib.crc32(ids[4 * s:4 * (s + n)])) for k, (s, n) in enumerate(cut(len(ids) // 4, capacity))]
            if out:
                row, k, s, n, c = zip(*out)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(row)), pa.array(k, pa.int32()), *(pa.array(x, pa.int64()) for x in (s, n, c))],
                                                 ["doc_id", "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(lean(run, f"count:{path}"), f"doc_id {kind.simpleString()}, piece int, start long, length long, ids_crc32 long")


def best_fit(order, lengths, bins, free, capacity: int) -> None:
    """Put documents (longest first) where the least room is left; ``bins`` and
    ``free`` grow in place. Open bins wait by room; a bit per room finds the tightest."""
    by_room: dict[int, list[int]] = {}
    bits = 0
    for b, f in enumerate(free):
        if f:
            by_room.setdefault(f, []).append(b)
            bits |= 1 << f
    for i in order:
        n = lengths[i]
        fits = bits >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            waiting = by_room[room]
            b = waiting.pop()
            if not waiting:
                bits &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
            free.append(0)
        free[b] = left = room - n
        if left:
            if bits >> left & 1:
                by_room[left].append(b)
            else:
                by_room[left] = [b]
                bits |= 1 << left


def fitness(free, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones (mean squared fill)."""
    fill = 1 - np.asarray(free) / capacity
    return -len(free), float((fill * fill).mean()) if len(free) else 0.0


def crossover(a, b, lengths, rng, capacity: int):
    """Inject well-filled bins of ``b`` into ``a``, drop bins with duplicates, best-fit the rest."""
    (bins_a, free_a), (bins_b, free_b) = a, b
    well = [x for x, f in enumerate(free_b) if f <= capacity * (1 - GOOD_FILL)] or list(range(len(bins_b)))
    chosen = rng.sample(well, max(1, len(well) // 2))
    bins, free = [list(bins_b[x]) for x in chosen], [free_b[x] for x in chosen]
    placed = {i for x in bins for i in x}
    displaced = []
    for x, f in zip(bins_a, free_a):
        if placed.isdisjoint(x):
            bins.append(list(x))
            free.append(f)
        else:
            displaced += [i for i in x if i not in placed]
    displaced.sort(key=lambda i: (-lengths[i], i))
    best_fit(displaced, lengths, bins, free, capacity)
    return bins, free


def mutate(a, lengths, rng, capacity: int, share: float = 0.1):
    """Open the emptiest bins and a few random ones; best-fit what they held."""
    bins, free = a
    n = len(bins)
    worst = set(sorted(range(n), key=lambda x: -free[x])[:max(1, int(n * share / 2))]) | set(rng.sample(range(n), max(1, int(n * share / 2))))
    kept, left = [list(x) for i, x in enumerate(bins) if i not in worst], [f for i, f in enumerate(free) if i not in worst]
    out = [i for x in worst for i in bins[x]]
    out.sort(key=lambda i: (-lengths[i], i))
    best_fit(out, lengths, kept, left, capacity)
    return kept, left


def evolve(lengths, start, seed: int, capacity: int = CAPACITY) -> list:
    """One epoch of one island; returns its elites as (bins, free), best first."""
    rng = random.Random(seed)
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    people = list(start)
    while len(people) < POPULATION:
        # The first is best fit by falling length; the others disturb that order a little.
        own = order if not people else sorted(order, key=lambda i: -lengths[i] * rng.uniform(0.97, 1.0))
        bins, free = [], []
        best_fit(own, lengths, bins, free, capacity)
        people.append((bins, free))
    bound = -(-sum(lengths) // capacity)
    for _ in range(CHILDREN):
        people.sort(key=lambda p: fitness(p[1], capacity), reverse=True)
        if len(people[0][0]) <= bound:
            break
        child = crossover(people[0], people[rng.randrange(1, len(people))], lengths, rng, capacity)
        if rng.random() < 0.5:
            child = mutate(child, lengths, rng, capacity)
        people = [*people[:POPULATION - 1], child]
    people.sort(key=lambda p: fitness(p[1], capacity), reverse=True)
    return people[:ELITES]


def _island(iterator, capacity: int, epoch: int):
    import pandas as pd

    for pdf in iterator:
        out = []
        for cell, island, lengths, elites in zip(pdf["cell"], pdf["island"], pdf["lengths"], pdf["elites"]):
            lengths = [int(x) for x in lengths]
            start = []
            for flat in elites if elites is not None else []:
                bins: dict[int, list[int]] = {}
                for i, b in enumerate(flat):
                    bins.setdefault(int(b), []).append(i)
                rows = list(bins.values())
                start.append((rows, [capacity - sum(lengths[i] for i in x) for x in rows]))
            best = evolve(lengths, start, int(cell) * 1009 + int(island) * 31 + epoch, capacity)
            flat_out = []
            for bins, _ in best:
                flat = [0] * len(lengths)
                for b, x in enumerate(bins):
                    for i in x:
                        flat[i] = b
                flat_out.append(flat)
            out.append((cell, island, len(best[0][0]) if best else 0, flat_out))
        yield pd.DataFrame(out, columns=["cell", "island", "n_bins", "elites"])


def pack_items(items: DataFrame, capacity: int, name: str) -> DataFrame:
    """(tag, length) -> (cell, bin, tag, length) of the best packing of each cell."""
    cells = max(1, -(-items.count() // CELL))
    packed = (items.groupBy(F.pmod(F.xxhash64("tag"), F.lit(cells)).cast("int").alias("cell"))
              .agg(F.array_sort(F.collect_list(F.struct("tag", "length"))).alias("items")))
    packed = stage(packed.select("cell", F.col("items.tag").alias("tags"), F.col("items.length").alias("lengths")), f"{name}-cells")
    islands = packed.select("cell", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), "lengths")
    tasks = max(1, min(cells * ISLANDS, 4 * items.sparkSession.sparkContext.defaultParallelism + cells * ISLANDS // 8))
    found = None
    for epoch in range(EPOCHS):
        if found is None:
            given = islands.withColumn("elites", F.lit(None).cast("array<array<int>>"))
        else:
            given = islands.join(found.groupBy("cell").agg(F.flatten(F.collect_list("elites")).alias("elites")), "cell")
        given = given.repartition(tasks, "cell", "island")
        found = stage(given.mapInPandas(lean(lambda it, e=epoch: _island(it, capacity, e)), "cell int, island int, n_bins int, elites array<array<int>>"), f"{name}-elites")
    best = found.groupBy("cell").agg(F.min_by(F.element_at("elites", 1), F.struct("n_bins", "island")).alias("bins"))
    rows = packed.join(best, "cell").select("cell", F.explode(F.arrays_zip("tags", "lengths", "bins")).alias("x"))
    return rows.select("cell", F.col("x.bins").alias("bin"), F.col("x.tags").alias("tag"), F.col("x.lengths").alias("length"))


def pack_documents(docs: DataFrame, path: str = TOKENIZER, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cutted = stage(pieces(docs, path, capacity, id_col, text_col).withColumn("tag", F.monotonically_increasing_id()), "pieces")
    first = stage(pack_items(cutted.where(F.col("length") < capacity).select("tag", "length"), capacity, "pack1"), "packed1")
    fill = first.groupBy("cell", "bin").agg(F.sum("length").alias("fill"))
    marked = first.join(fill, ["cell", "bin"])
    good = F.col("fill") >= int(capacity * GOOD_FILL)
    again = pack_items(marked.where(~good).select("tag", "length"), capacity, "pack2")
    # A sequence is named by its smallest tag, which no other sequence holds.
    placed = marked.where(good).select(F.lit(1).alias("level"), "cell", "bin", "tag", "length").unionByName(
        again.select(F.lit(2).alias("level"), "cell", "bin", "tag", "length"))
    # A sequence holds at most `capacity` pieces, so its list is bounded.
    lists = placed.groupBy("level", "cell", "bin").agg(F.array_sort(F.collect_list(F.struct("tag", "length"))).alias("x"))
    at = F.transform("x", lambda v, i: F.struct(v["tag"].alias("tag"), F.aggregate(F.slice("x", F.lit(1), i), F.lit(0).cast("long"), lambda s, y: s + y["length"]).alias("offset")))
    slots = lists.select(F.element_at("x", 1)["tag"].alias("sequence_id"), F.explode(at).alias("y")).select(F.col("y.tag").alias("tag"), "sequence_id", F.col("y.offset").alias("offset"))
    return (cutted.join(slots, "tag", "left")
            .select("doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("sequence_id", "tag").alias("sequence_id"), F.coalesce("offset", F.lit(0)).alias("offset")))


def op8_grouping_genetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)
