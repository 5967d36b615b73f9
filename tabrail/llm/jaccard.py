"""Near-duplicate texts by a grouped prefix join on word shingles.

Texts with equal shingle sets are one class. Shingles are ordered by how
often they occur (rare first, from a fixed-size count sketch, ties by hash);
two sets whose Jaccard likeness is at least t share one of the first
``n - ceil(t n) + 1``. Classes with the same prefix and size are collapsed
into one group, groups that share a prefix shingle are paired, pairs are
filtered by size and by parity bitmaps (every differing shingle flips one
bit, so the bits that differ bound the difference from below; a bitmap has at
least as many bits as its set has shingles, so that it tells long sets apart
too), and what is left is expanded to members and verified on the whole sets.
Blocks are cut by size band, as sets of unlike sizes cannot link.

Only components are asked for, so a large group of near copies is not paired
off: first every group is verified against one representative of a block
(a star, linear in the block's rows), then only pairs across the components
found so far, of which one side is outside its block's largest component.
No link between components is lost: each such pair passes an exact filter
or is verified.

Rows: null, empty or blank texts have the empty set and link with nothing;
null or repeated ids are put in (doc_id, text) order, nulls first; texts of
any length give their whole sets; other columns are not read (the pipeline
stage keeps them), whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabrail.llm.common import U64, bucket_counts, components, keyed_rows, lean, mix, release, spans_of, stage, table, texts_of

#: Count sketch of shingles, bitmap of documents to verify (log2 of their fixed sizes).
SKETCH_BITS, WANTED_BITS = 22, 22
#: Parity bitmaps: words of 64 bits of the first test and, at least, of the whole one (up to 2 ** MOST_BITS bits).
SHORT, WORDS, MOST_BITS = 4, 16, 24
#: Words, at most, of the bitmaps that the join of strays compares.
LONG = 64
#: A bitmap of m bits tells sets of n shingles apart if FIT * m >= n * (100 - percent): unlike ones differ in over twice the bits that linked ones may.
FIT = 20
#: Size classes of a block's band; the last one of a band is in the next band as well.
BAND = 6
CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = [U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


class Shingler:
    """64-bit hashes of the distinct word shingles of texts, a chunk of rows at a time."""

    def __init__(self, words: int):
        self.k = words
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.lower = np.arange(256, dtype=np.uint64)
        self.lower[65:91] += U64(32)
        self.power = self.inverse = np.ones(1, U64)

    def _powers(self, n: int):
        if len(self.power) < n:
            base, back = U64(_BASE), U64(pow(_BASE, -1, 1 << 64))
            self.power = np.concatenate([np.ones(1, U64), np.cumprod(np.full(n, base, U64))])
            self.inverse = np.concatenate([np.ones(1, U64), np.cumprod(np.full(n, back, U64))])
        return self.power, self.inverse

    def chunk(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all shingles in row order, and each row's first place among them (len(off) places)."""
        n = len(data)
        rows = len(off) - 1
        if not n:
            return np.zeros(0, U64), np.zeros(rows + 1, np.int64)
        power, inverse = self._powers(n + 1)
        word = ~self.space[data]
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        before = np.empty(n, bool)
        before[0], before[1:] = True, ~word[:-1]
        after = np.empty(n, bool)
        after[-1], after[:-1] = True, ~word[1:]
        starts = np.nonzero(word & (before | edge[:n]))[0]
        ends = np.nonzero(word & (after | edge[1:]))[0] + 1
        total = np.zeros(n + 1, U64)
        np.cumsum(self.lower[data] * power[:n], out=total[1:])
        w = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U64) * U64(0xFF51AFD7ED558CCD))
        at = np.searchsorted(starts, off)  # the first word of each row
        count = np.diff(at)
        k, m = self.k, len(w)
        if m >= k:
            acc = np.zeros(m - k + 1, U64)
            for i in range(k):
                acc += w[i:m - k + 1 + i] * _STEP[i % len(_STEP)] + U64(i)
            h = mix(acc)
        else:
            h = np.zeros(0, U64)
        out, places = [], np.zeros(rows + 1, np.int64)
        np.cumsum(np.where(count >= k, count - k + 1, (count > 0).astype(np.int64)), out=places[1:])
        if (count >= k).all():
            keep = np.ones(len(h), bool)
            for a in at[1:-1]:
                keep[max(0, a - k + 1):a] = False
            return h[keep], places
        for r in range(rows):
            if count[r] >= k:
                out.append(h[at[r]:at[r + 1] - k + 1])
            elif count[r]:
                # Fewer words than a shingle: the whole sequence is the one shingle.
                acc = U64(count[r])
                for i, x in enumerate(w[at[r]:at[r + 1]]):
                    acc = acc + x * _STEP[i % len(_STEP)] + U64(i + 77)
                out.append(mix(np.array([acc], U64)))
        return np.concatenate(out) if out else np.zeros(0, U64), places

    def sets(self, batch: pa.RecordBatch):
        """The sorted distinct hashes of each row of a batch."""
        data, off = texts_of(batch, "text")
        with np.errstate(over="ignore"):
            for i, j in spans_of(off, CHUNK):
                h, places = self.chunk(data[off[i]:off[j]], off[i:j + 1] - off[i])
                for a, b in zip(places[:-1], places[1:]):
                    s = np.sort(h[a:b])
                    yield s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) > 1 else s


def least_common(n, percent: int):
    """Shingles that a set of n shares with any set of likeness ``percent`` or more (ceil(t n))."""
    return (n * percent + 99) // 100


def _list(values: list, kind) -> pa.Array:
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    off = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat, kind))


def signatures(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """(key, n, d1, d2, g, prefix, few, bits): set size, digests of set and prefix, prefix, parity bitmaps."""
    spark = rows.sparkSession

    def hashes(batch):
        return Shingler(words).sets(batch)

    counts = bucket_counts(rows.select("text"), hashes, SKETCH_BITS)
    # Half-octaves over the mean: chance differences of rare shingles keep them in one class.
    rare = np.floor(2 * np.log2(np.maximum(1.0, counts / max(1.0, float(counts.mean()))))).astype(np.uint8)
    shared = spark.sparkContext.broadcast(rare)

    def run(batches):
        rare, shingler, mask = shared.value, Shingler(words), U64((1 << SKETCH_BITS) - 1)
        for b in batches:
            cols = {k: [] for k in ("n", "d1", "d2", "g", "prefix", "few", "bits")}
            with np.errstate(over="ignore"):
                for u in shingler.sets(b):
                    n = len(u)
                    p = n - least_common(n, percent) + 1 if n else 0
                    first = u[np.argsort(rare[(u & mask).astype(np.int64)], kind="stable")[:p]]
                    size = max(64 * WORDS, 1 << min(MOST_BITS, max(0, n - 1).bit_length()))
                    flips = (np.bincount((u >> U64(64 - MOST_BITS)).astype(np.int64) & (size - 1), minlength=size) & 1).astype(np.uint8)
                    cols["n"].append(n)
                    cols["d1"].append(int(mix(u + U64(1)).sum(dtype=U64).astype(np.int64)))
                    cols["d2"].append(int(mix(u ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64).astype(np.int64)))
                    cols["g"].append(int(mix(first + U64(3)).sum(dtype=U64).astype(np.int64)))
                    cols["prefix"].append(first.view(np.int64))
                    cols["few"].append(np.packbits(np.bitwise_xor.reduce(flips.reshape(-1, 64 * SHORT))).view(np.int64))
                    cols["bits"].append(np.packbits(flips).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), pa.array(cols["n"], pa.int32()), *(pa.array(cols[k], pa.int64()) for k in ("d1", "d2", "g")), *(_list(cols[k], pa.int64()) for k in ("prefix", "few", "bits"))],
                ["key", "n", "d1", "d2", "g", "prefix", "few", "bits"])

    return rows.mapInArrow(lean(run), "key long, n int, d1 long, d2 long, g long, prefix array<long>, few array<long>, bits array<long>")


def _differ(a: str, b: str, words: int):
    """Bits in which two parity bitmaps of ``words`` words differ."""
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(1, words)), F.bit_count(F.col(a)[0].bitwiseXOR(F.col(b)[0])))


def _differ_whole(a: str, b: str):
    """Bits in which two whole parity bitmaps differ; one twice as long is folded first, ones of less like lengths count as equal."""
    words = F.least(F.size(a), F.size(b))

    def fold(c):
        return F.when(F.size(c) > words, F.zip_with(F.slice(c, F.lit(1), words), F.slice(c, words + 1, words), lambda x, y: x.bitwiseXOR(y))).otherwise(F.col(c))

    differ = F.aggregate(F.zip_with(fold(a), fold(b), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return F.when(F.greatest(F.size(a), F.size(b)) <= 2 * words, differ).otherwise(F.lit(0))


def _differ_fitted(a: str, b: str):
    """As ``_differ_whole``; bitmaps of SHORT words, which are the most, are compared without lambdas."""
    short = (F.size(a) == SHORT) & (F.size(b) == SHORT)
    return F.when(short, _differ(a, b, SHORT)).otherwise(_differ_whole(a, b))


def _folded(c: str, words):
    """A parity bitmap of at most ``words`` words (a number or a column): longer ones are folded to that many."""
    words = F.lit(words)
    step = F.transform(F.sequence(F.lit(1), words), lambda i: F.aggregate(
        F.sequence(i, F.size(c), words), F.lit(0).cast("long"), lambda x, k: x.bitwiseXOR(F.element_at(c, k))))
    return F.when(F.size(c) > words, step).otherwise(F.col(c))


def fitting(percent: int):
    """The parity bitmap ``bits`` of a set of ``n``, folded to the fewest words (LONG at most) that tell such sets apart: ``few`` for most."""
    need = F.col("n") * (100 - percent) / float(64 * FIT)
    words = F.least(F.lit(LONG), F.pow(F.lit(2), F.ceil(F.log2(need))).cast("int"))
    return F.when(need > SHORT, _folded("bits", words)).otherwise(F.col("few"))


def _may_link(n1: str, n2: str, percent: int):
    """Size filter: the smaller set is at least ``percent`` of the larger."""
    return F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent


def _few_bits(differ, n1: str, n2: str, percent: int):
    """|A xor B| <= (1 - t) / (1 + t) (|A| + |B|) for likeness t or more."""
    return differ * (100 + percent) <= (F.col(n1) + F.col(n2)) * (100 - percent)


def in_blocks(token: DataFrame) -> DataFrame:
    """The prefix rows (tok, gid, n, members) whose block pairs something, with the block's ``groups`` and classes ``c``.

    Block and rows come of one exchange: most rows are alone in their block, so counting the blocks
    apart and joining them to the rows would move all of them a second time."""
    block = Window.partitionBy("tok")
    counted = token.withColumns({"groups": F.count(F.lit(1)).over(block), "c": F.sum("members").over(block)})
    return counted.where("groups > 1 or c > 2").drop("members")


def star(blocks: DataFrame, percent: int) -> DataFrame:
    """``blocks`` (tok, gid, n, nb, groups, c) with ``own`` and ``next``, the first group of the block's same size
    class and of the next one, where the sizes may link (else null), and ``more``: whether the row may link to
    a row of the block that is not among these pairs.

    It needs no exchange beyond that of ``in_blocks``. A block has at most BAND + 1 size classes, all
    neighbours, so their remainders tell them apart."""
    block = Window.partitionBy("tok")
    slot = lambda nb: F.pmod(nb, F.lit(BAND + 1)).cast("int")
    each = [F.when(slot(F.col("nb")) == i, F.struct("gid", "n")) for i in range(BAND + 1)]
    rows = blocks.withColumns({"firsts": F.array(*[F.min(x).over(block) for x in each]), "sizes": F.array(*[F.count(x).over(block) for x in each])})
    rows = rows.withColumns({f"{what}{k}": F.get(what, slot(F.col("nb") + k - 1)) for what in ("firsts", "sizes") for k in range(3)})
    end = lambda r: F.when((F.col("gid") != F.col(f"{r}.gid")) & _may_link("n", f"{r}.n", percent), F.col(f"{r}.gid"))
    # Unsettled are pairs of one size class without its first group, and pairs of neighbouring
    # classes without the first one of the upper; of a group of several classes, only one is in the star.
    later = F.col("gid") != F.col("firsts1.gid")
    unsettled = (later & (F.col("sizes1") > 2)) | (F.col("sizes2") > 1) | (later & (F.col("sizes0") > 0))
    more = F.when(F.col("groups") == F.col("c"), unsettled).otherwise(F.col("c") > 2)
    return rows.select("tok", "gid", end("firsts1").alias("own"), end("firsts2").alias("next"), more.alias("more"))


def pairs_across(mixed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) across the components of a block that both bitmaps leave, one side outside the block's main one.

    ``mixed`` has tok, cid, comp, n, long and main. The short bitmaps of sets of more than some 600 shingles
    all differ by less than such sets may, so ``long`` is as long as its set asks for (see ``fitting``)."""
    stray = mixed.where("comp != main").select("tok", F.col("cid").alias("a"), F.col("comp").alias("ca"), F.col("n").alias("na"), F.col("long").alias("la"))
    other = mixed.select("tok", F.col("cid").alias("b"), F.col("comp").alias("cb"), F.col("n").alias("nb"), F.col("long").alias("lb"), (F.col("comp") == F.col("main")).alias("is_main"))
    return stray.join(other, (stray["tok"] == other["tok"]) & (F.col("ca") != F.col("cb")) & (F.col("is_main") | (F.col("a") < F.col("b")))
                      & _may_link("na", "nb", percent) & _few_bits(_differ_fitted("la", "lb"), "na", "nb", percent)).select("a", "b")


def verify(rows: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of keys whose whole sets link; b may be common to many pairs."""
    spark = rows.sparkSession
    ends = pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct()
    to_bucket = lambda k: mix(np.asarray(k).astype(np.int64).view(U64))
    counts = bucket_counts(ends.repartition(4), lambda b: [to_bucket(b.column("k"))], WANTED_BITS)
    wanted = spark.sparkContext.broadcast(np.packbits(counts > 0))

    def sets(batches):
        # A fixed-size bitmap spares most other texts; the join below is what decides.
        bits, shingler = np.unpackbits(wanted.value).astype(bool), Shingler(words)
        for b in batches:
            at = np.nonzero(bits[(to_bucket(b.column("key")) & U64((1 << WANTED_BITS) - 1)).astype(np.int64)])[0]
            if len(at):
                b = b.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([b.column("key"), pa.array([u.tobytes() for u in shingler.sets(b)], pa.binary())], ["key", "set"])

    found = stage(rows.select("key", "text").mapInArrow(lean(sets), "key long, set binary"), "sets")
    left = pairs.join(found.select(F.col("key").alias("a"), F.col("set").alias("x")), "a")
    both = left.join(found.select(F.col("key").alias("b"), F.col("set").alias("y")), "b")

    def link(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("x"), b.column("y")):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                s = np.sort(np.concatenate([x, y]))
                common = int((s[1:] == s[:-1]).sum())
                keep.append(100 * common >= percent * (len(s) - common))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    out = stage(both.select("a", "b", "x", "y").mapInArrow(lean(link), "a long, b long"), "links")
    release(found)
    return out


def classes(docs: DataFrame, words: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, doc_id, n, comp) of every row; comp is the smallest key reachable over links."""
    rows, _ = keyed_rows(docs, id_col, text_col)
    sig = stage(signatures(rows, words, percent), "signatures")
    same = sig.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("key").alias("cid"), F.count(F.lit(1)).alias("copies"))
    copies = sig.select("key", "n", "d1", "d2").join(same.where("copies > 1"), ["n", "d1", "d2"]).where("key != cid").select("key", "cid")
    copies = stage(copies, "copies")
    node = sig.where("n > 0").join(copies.select("key"), "key", "left_anti").withColumnRenamed("key", "cid")
    size_class = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent) if percent < 100 else 1e-6)).alias("nb")
    group = node.groupBy("g", "n").agg(F.min("cid").alias("gid"), F.count(F.lit(1)).alias("members"))
    member = stage(node.select("cid", "n", "g", "few", "bits").join(group, ["g", "n"]).select("cid", "gid", "n", "few", "bits"), "members")
    whole = stage(sig.select("key", "n").join(copies, "key", "left").withColumn("cid", F.coalesce("cid", "key")), "whole")
    # Prefix rows of groups. A shingle that one class alone has pairs nothing; that of one group of two is settled by `own` below.
    first = node.join(group.select(F.col("gid").alias("cid"), "members"), "cid")
    # Sets that link are of one size class or of neighbouring ones, so some band holds both.
    first = first.select("prefix", F.col("cid").alias("gid"), "n", "members", size_class)
    band = F.floor(F.col("nb") / BAND)
    first = first.withColumn("band", F.explode(F.when(F.pmod("nb", F.lit(BAND)) == BAND - 1, F.array(band, band + 1)).otherwise(F.array(band))))
    token = first.select(F.explode("prefix").alias("tok"), "band", "gid", "n", "members")
    token = token.select(F.xxhash64("tok", "band").alias("tok"), "gid", "n", "members")
    shared = stage(star(in_blocks(token).select("tok", "gid", "n", size_class, "groups", "c"), percent), "blocks")
    # All that is read of the signatures from here on is in `member` and `whole`.
    release(sig)
    release(copies)
    bits = member.select("cid", "n", "bits")
    end = lambda k: bits.select(F.col("cid").alias(k), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"bits{k}"))

    def close(pairs):
        """Pairs (a, b) that the whole bitmaps leave."""
        return pairs.distinct().join(end("a"), "a").join(end("b"), "b").where(_few_bits(_differ_whole("bitsa", "bitsb"), "na", "nb", percent)).select("a", "b")

    # Star: every group with the first group of its block's size class and of the next one.
    short = lambda k: member.where("cid = gid").select(F.col("cid").alias(k), F.col("n").alias(f"n{k}"), F.col("few").alias(f"few{k}"))
    near = shared.select(F.col("gid").alias("a"), F.explode(F.array("own", "next")).alias("b")).where("b is not null").distinct()
    near = near.join(short("a"), "a").join(short("b"), "b").where(_few_bits(_differ("fewa", "fewb", SHORT), "na", "nb", percent)).select("a", "b")
    own = member.where("cid != gid").select(F.col("cid").alias("a"), F.col("gid").alias("b"))
    links = verify(rows, stage(close(near).unionByName(own).distinct(), "star"), words, percent)
    # The star has settled all pairs of most rows. Where the others of a block are of
    # several components so far, those outside the largest are strays.
    large = shared.where("more").select("tok", "gid")
    nodes = member.select(F.col("cid").alias("id"))
    sign = member.select("cid", "gid", "n", fitting(percent).alias("long"))

    def mixed_blocks(links):
        comp = stage(components(nodes, links), "comp")
        mixed = large.join(sign.join(comp, F.col("cid") == F.col("id")).select("gid", "cid", "comp", "n", "long"), "gid")
        sizes = mixed.groupBy("tok", "comp").agg(F.count(F.lit(1)).alias("c"))
        main = sizes.groupBy("tok").agg(F.max_by("comp", F.struct("c", F.col("comp"))).alias("main"), F.count(F.lit(1)).alias("k")).where("k > 1").select("tok", "main")
        return stage(mixed.drop("gid").join(main, "tok"), "mixed")

    # What is left: every pair across components of a block, one side of it a stray.
    mixed = mixed_blocks(links)
    release(shared)
    left = stage(close(pairs_across(mixed, percent)), "left")
    release(mixed)
    links = links.unionByName(verify(rows, left, words, percent))
    comp = components(nodes, links)
    out = whole.join(comp.withColumnRenamed("id", "cid"), "cid", "left").select("key", "n", F.coalesce("comp", "key").alias("comp"))
    return out


def op3_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id at three words and 90 percent."""
    return near_duplicates(table(spark, sf_dir, "documents"), 3, 90)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    rows, unique = keyed_rows(docs)
    found = classes(rows if unique else rows.drop("doc_id").withColumnRenamed("key", "doc_id"), words, percent)
    if unique:
        return found.select(F.col("key").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.col("comp").alias("component_id"))
    names = rows.select("key", "doc_id")
    return (found.join(names, "key").join(names.select(F.col("key").alias("comp"), F.col("doc_id").alias("component_id")), "comp")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id"))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage (five words, 80 percent): the first document of each component stays, unchanged."""
    rows, unique = keyed_rows(docs, carry=True)
    found = classes(rows.select(F.col("key").alias("doc_id"), "text"), 5, 80)
    kept = found.where("key = comp").select("key")
    if unique:
        return docs.join(kept.withColumnRenamed("key", "doc_id"), "doc_id", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
    return rows.join(kept, "key", "left_semi").select("row.*")
