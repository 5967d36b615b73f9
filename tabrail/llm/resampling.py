"""Importance resampling towards a target distribution.

Weights: every run of one to three words falls into one of 10,000 buckets by
its CRC-32; a bucket's gain compares its share in the target texts with its
share in the corpus, a document's weight is the sum of its features' gains.
The gains are one array of fixed size, so weights are array look-ups.

Draw: Gumbel noise from a digest of the id makes the highest scores a sample
without replacement. The ranks come from a parallel sort by regular sampling:
each partition of the scored rows is sorted as a run and gives every step-th
row as a sample; the sorted samples give regular splitters; the rows between
two splitters are a segment, whose size is counted before anything moves.
Prefix sums of the sizes give each segment its first rank, segments beyond the
draw stay where they are, and the others are exchanged, merged by a local sort
and numbered from their first rank.

Scale: the texts are scanned twice and never shuffled; counts are summed in
the tasks and 10,000 sums reach the driver, whatever the input. Scored rows
(40 bytes) are stored once; samples on the driver number at most ``SAMPLES``
a shuffle partition plus one a run. Rows carry a stored place as last sort
column, so rows with equal scores and ids fall into different segments.

CRC-32 is linear: a run's value follows from those of its words by one table
look-up a byte of the register, for all runs of a batch at once. Words of 64
bytes or more take a few look-ups more.

Rows: a null text has no words, weight 0; a null id is hashed as the empty
text and comes after all others in ties; repeated rows are all scored, counted
and ranked (their order among equals is their stored place); an empty corpus
or target gives weights by the formula (empty corpus: no rows); columns other
than doc_id and text are not read; a text of any length is taken whole.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrail.llm.common import kept_in_worker, release, spans_of, stage, table, texts_of

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Samples a shuffle partition: the splitters' evenness.
SAMPLES = 32
#: Text bytes that are turned into features at once.
SPAN = 1 << 20
#: Words below this length have a table of their own for joining values.
SHORT = 64

U32 = np.uint32


class Crc:
    """CRC-32 of many byte strings at once, and of their concatenations."""

    def __init__(self):
        t = np.arange(256, dtype=U32)
        for _ in range(8):
            t = np.where(t & U32(1), (t >> U32(1)) ^ U32(0xEDB88320), t >> U32(1)).astype(U32)
        self.table = t
        # shift[n, k, b]: what byte k of value b becomes after n more bytes.
        one = np.zeros((SHORT, 4, 256), U32)
        one[0] = (np.arange(256, dtype=U32)[None, :] << (U32(8) * np.arange(4, dtype=U32))[:, None]).astype(U32)
        for n in range(1, SHORT):
            one[n] = self._byte(one[n - 1])
        self.shift = one.reshape(-1)
        # powers[j]: the same for 64 * 2**j bytes.
        self.powers = [self._byte(one[SHORT - 1])]

    def _byte(self, c: np.ndarray) -> np.ndarray:
        return self.table[c & U32(255)] ^ (c >> U32(8))

    @staticmethod
    def _apply(tables: np.ndarray, c: np.ndarray) -> np.ndarray:
        return (tables[0][c & U32(255)] ^ tables[1][(c >> U32(8)) & U32(255)]
                ^ tables[2][(c >> U32(16)) & U32(255)] ^ tables[3][c >> U32(24)])

    def _power(self, j: int) -> np.ndarray:
        while len(self.powers) <= j:
            last = self.powers[-1]
            self.powers.append(self._apply(last, last))
        return self.powers[j]

    def words(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """CRC-32 of data[start:start+length] for all words."""
        c = np.full(len(start), 0xFFFFFFFF, U32)
        order = np.argsort(-np.minimum(length, SHORT), kind="stable")
        s, n = start[order], np.minimum(length, SHORT)[order]
        reg = c[order]
        # Words that still have a byte at place i are the first ones in this order.
        alive = np.searchsorted(-n, -np.arange(1, SHORT + 1), "right")
        for i in range(SHORT):
            k = int(alive[i])
            if not k:
                break
            reg[:k] = self.table[(reg[:k] ^ data[s[:k] + i]) & U32(255)] ^ (reg[:k] >> U32(8))
        c[order] = ~reg
        for i in np.flatnonzero(length > SHORT):
            c[i] = zlib.crc32(data[start[i]:start[i] + length[i]])
        return c

    def then_space(self, c: np.ndarray) -> np.ndarray:
        return ~self._byte(~c ^ U32(32))

    def joined(self, first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
        """CRC-32 of first + second, from both values and the second's length."""
        base = (length & (SHORT - 1)) * 1024
        sh = self.shift
        out = (sh[base + (first & U32(255))] ^ sh[base + 256 + ((first >> U32(8)) & U32(255))]
               ^ sh[base + 512 + ((first >> U32(16)) & U32(255))] ^ sh[base + 768 + (first >> U32(24))])
        high, j = length // SHORT, 0
        while high.any():
            odd = np.flatnonzero(high & 1)
            if len(odd):
                out[odd] = self._apply(self._power(j), out[odd])
            high, j = high >> 1, j + 1
        return out ^ second


def _word_bytes() -> np.ndarray:
    """Lower-cased byte of a word, or 0 for a byte between words."""
    t = np.arange(256, dtype=np.uint8)
    t[0x41:0x5B] += 0x20
    for low, high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
        t[low:high + 1] = 0
    return t


def features(crc: Crc, fold: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, row) of every feature and the number of words of every row."""
    rows = len(offsets) - 1
    low = fold[data]
    # A 0 before the first byte of every row keeps words inside their rows.
    place = np.arange(len(data), dtype=np.int64) + np.repeat(np.arange(1, rows + 1), np.diff(offsets))
    wide = np.zeros(len(data) + rows + 1, np.uint8)
    wide[place] = low
    edge = np.flatnonzero(np.diff((wide != 0).astype(np.int8)))
    start, length = edge[0::2] + 1, edge[1::2] - edge[0::2]
    row = np.searchsorted(offsets + np.arange(rows + 1), start, "right") - 1
    one = crc.words(wide, start, length)
    two = three = np.zeros(0, U32)
    at2 = at3 = np.zeros(0, np.int64)
    if len(one) > 1:
        same = np.flatnonzero(row[1:] == row[:-1])
        both = crc.joined(crc.then_space(one[same]), one[same + 1], length[same + 1])
        two, at2 = both, row[same]
        third = np.flatnonzero((same[1:] == same[:-1] + 1))
        if len(third):
            i = same[third] + 2
            three, at3 = crc.joined(crc.then_space(both[third]), one[i], length[i]), row[i]
    bucket = np.concatenate([one, two, three]) % U32(BUCKETS)
    return bucket, np.concatenate([row, at2, at3]), np.bincount(row, minlength=rows)


def _spans(batch: pa.RecordBatch, name: str):
    """(first row, features) of row ranges of about ``SPAN`` bytes."""
    crc, fold = kept_in_worker("crc", Crc), kept_in_worker("word-bytes", _word_bytes)
    data, off = texts_of(batch, name)
    for i, j in spans_of(off, SPAN):
        yield i, features(crc, fold, data[off[i]:off[j]], off[i:j + 1] - off[i])


def bucket_totals(texts: DataFrame, name: str = "text") -> np.ndarray:
    """Features of all rows per bucket; ``BUCKETS`` sums reach the driver."""
    def count(batches):
        own = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for _, (bucket, _, _) in _spans(b, name):
                own += np.bincount(bucket, minlength=BUCKETS)
        held = np.flatnonzero(own)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(held, pa.int32()), "n": pa.array(own[held], pa.int64())})

    out = np.zeros(BUCKETS, np.int64)
    for r in texts.select(name).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    s, t = int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((int(b) + 1) * (s + BUCKETS) / ((int(a) + 1) * (t + BUCKETS)))) for a, b in zip(corpus, target)], np.int64)


def _noise(ident) -> int:
    h = int(hashlib.sha256(f"{SEED}:{'' if ident is None else ident}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


SCORED = "doc_id long, n_features long, weight long, score long, enough boolean"


def score_documents(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_features, weight, score and whether the text has enough words."""
    def rows(batches):
        for b in batches:
            n = b.num_rows
            count, weight, words = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for i, (bucket, row, held) in _spans(b, "text"):
                m = len(held)
                count[i:i + m] = np.bincount(row, minlength=m)
                # Whole numbers far below 2**53: sums of doubles are exact.
                weight[i:i + m] = np.bincount(row, weights=gain[bucket], minlength=m).astype(np.int64)
                words[i:i + m] = held
            ids = b.column("doc_id").cast(pa.int64())
            noise = np.array([_noise(x) for x in ids.to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([ids, pa.array(count), pa.array(weight), pa.array(weight + noise), pa.array(words >= LEAST_WORDS)],
                                             names=["doc_id", "n_features", "weight", "score", "enough"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(rows, SCORED)


def _order() -> list:
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("seq")]


LAST = (1 << 63) - 1


def _keys(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort columns of a batch, all ascending."""
    ident = b.column("doc_id").fill_null(LAST).to_numpy(zero_copy_only=False)
    return -b.column("score").to_numpy(zero_copy_only=False), ident, b.column("seq").to_numpy(zero_copy_only=False)


def rank_highest(scored: DataFrame, take: int, enough: int, partitions: int) -> DataFrame:
    """Add ``rank`` 1 to ``take`` to the ``take`` highest of the ``enough``
    rows that may be drawn; null for all others. ``scored`` is stored, with a
    unique ``seq``."""
    every = [*scored.columns, "rank"]
    schema = "doc_id long, n_features long, weight long, score long, enough boolean, seq long"
    none = F.lit(None).cast("long")
    if take <= 0:
        return scored.withColumn("rank", none)
    able = scored.where("enough")
    step = max(1, enough // (SAMPLES * partitions))

    def sample(batches):
        seen = 0
        for b in batches:
            at = np.arange((-seen) % step, b.num_rows, step)
            seen += b.num_rows
            if len(at):
                s, i, q = _keys(b)
                yield pa.RecordBatch.from_pydict({"s": pa.array(s[at]), "i": pa.array(i[at]), "q": pa.array(q[at])})

    runs = able.select("score", "doc_id", "seq").sortWithinPartitions(*_order())
    samples = sorted(tuple(r) for r in runs.mapInArrow(sample, "s long, i long, q long").collect())
    marks = [samples[len(samples) * k // partitions] for k in range(1, partitions)] if samples else []
    splitters = sorted(set(marks))
    first = np.array([m[0] for m in splitters], np.int64)

    def segment(batches):
        for b in batches:
            s, i, q = _keys(b)
            low, high = np.searchsorted(first, s, "left"), np.searchsorted(first, s, "right")
            for r in np.flatnonzero(low != high):
                low[r] = bisect_left(splitters, (int(s[r]), int(i[r]), int(q[r])), int(low[r]), int(high[r]))
            yield b.append_column("segment", pa.array(low.astype(np.int32)))

    dealt = able.mapInArrow(segment, schema + ", segment int")
    sizes = {r["segment"]: r["n"] for r in dealt.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).collect()}
    start, at = {}, 0
    for k in sorted(sizes):
        start[k] = at
        at += sizes[k]
    last = max(k for k in start if start[k] < take)

    def number(batches):
        # Segments come whole and in order; a segment's rows may span batches.
        now, done = None, 0
        for b in batches:
            seg = b.column("segment").to_numpy(zero_copy_only=False)
            rank = np.empty(len(seg), np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(seg)) + 1).tolist(), len(seg)]
            for x, y in zip(cuts[:-1], cuts[1:]):
                if x == y:
                    continue
                if int(seg[x]) != now:
                    now, done = int(seg[x]), 0
                rank[x:y] = start[now] + done + np.arange(1, y - x + 1)
                done += y - x
            yield b.append_column("rank", pa.array(rank, pa.int64(), mask=rank > take))

    drawn = (dealt.where(F.col("segment") <= last).repartition(min(partitions, last + 1), "segment")
             .sortWithinPartitions("segment", *_order()).mapInArrow(number, schema + ", segment int, rank long"))
    rest = dealt.where(F.col("segment") > last).withColumn("rank", none)
    return drawn.select(*every).unionByName(rest.select(*every)).unionByName(scored.where("not enough").withColumn("rank", none))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_features, weight, score, rank for every row of ``docs``."""
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    gain = gains(bucket_totals(docs), bucket_totals(target))
    scored = stage(score_documents(docs, gain).withColumn("seq", F.monotonically_increasing_id()), "scored")
    enough = scored.where("enough").count()
    ranked = rank_highest(scored, percent * enough // 100, enough, parts)
    out = stage(ranked.select("doc_id", "n_features", "weight", "score", "rank"), "resampled")
    release(scored)
    return out


def op11_regular_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
