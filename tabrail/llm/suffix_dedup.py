"""Removal of long repeated byte strings over a run-length suffix index.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts
earlier (smaller key, or earlier in the same text). No index of the whole
corpus could live in one task, so strings are dealt by content first: each
window of ``LENGTH`` bytes belongs to its smallest ``GRAM``-gram by hash (its
anchor), equal windows to equal anchors; the windows of one anchor occurrence
form a segment of at most ``2 LENGTH - GRAM`` bytes. Anchors that occur once
cannot repeat and end there. Equal segments count once: all but the first
are removed whole, so a large group of copies costs one segment. Only
different segments under one anchor need an index.

There, per block of anchors: the Burrows-Wheeler transform of the segments
(in order, each ended by an end mark of its own) is kept as runs, with the
suffix positions at run ends sampled; the longest match with the neighbouring
suffix is computed at run heads only and streamed through the text for all
other positions (it drops by one a step inside a run); matches of ``LENGTH``
or more join equal windows, of which all but the earliest are marked.

An anchor with more than ``HOT`` different segments is split instead: its
windows are grouped by hash, where the earliest of each is a partial minimum.

Rows: null texts are empty and lose nothing, as do texts under ``LENGTH``
bytes; null or repeated ids are put in (doc_id, text) order, nulls first; texts
of any length are cut into segments; other columns are not read (the pipeline
stage keeps them), whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrail.llm.common import keyed_rows, lean, mix, spans_of, stage, table, texts_of, U64

LENGTH, GRAM = 100, 32
#: Bytes of text hashed at once; bytes of segments in one index; segments under one anchor for an index.
CHUNK, BLOCK, HOT = 1 << 19, 1 << 18, 4096
_ODD = [U64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD[0])


def window_hashes(data: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """For each size, a 64-bit hash of the bytes from every position where so many are left."""
    ladder, h, n = {}, _BYTE[data], 1
    while True:
        ladder[n] = h
        if 2 * n > max(sizes) or len(h) <= n:
            break
        h = h[:-n] * _ODD[n.bit_length() % 8] + h[n:]
        n *= 2
    out = []
    for size in sizes:
        if len(data) < size:
            out.append(np.zeros(0, U64))
            continue
        acc, at = np.zeros(len(data) - size + 1, U64), 0
        for bit in range(size.bit_length() - 1, -1, -1):
            if size >> bit & 1:
                acc = acc * _ODD[(bit + 3) % 8] + ladder[1 << bit][at:at + len(acc)]
                at += 1 << bit
        out.append(mix(acc))
    return out


def _least(packed: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each ``width`` consecutive values."""
    m, n = packed, 1
    while 2 * n <= width:
        m = np.minimum(m[:-n], m[n:])
        n *= 2
    return np.minimum(m[:len(m) - (width - n)], m[width - n:]) if width > n else m


def segments(data: np.ndarray, off: np.ndarray):
    """Segments of the rows in ``data``: (row, anchor hash, content hash, start, windows, anchor place) arrays."""
    gram, whole = window_hashes(data, (GRAM, LENGTH))
    if not len(whole):
        return None
    packed = (gram & U64(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=np.uint64)
    anchor = (_least(packed, LENGTH - GRAM + 1) & U64(0xFFFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))[:len(whole)]
    fits = off[1:][row] - np.arange(len(whole)) >= LENGTH
    first = fits.copy()
    first[1:] &= ~fits[:-1] | (anchor[1:] != anchor[:-1])
    last = fits.copy()
    last[:-1] &= ~fits[1:] | (anchor[1:] != anchor[:-1])
    s, e = np.nonzero(first)[0], np.nonzero(last)[0]
    p = anchor[s]
    n, a = e - s + 1, p - s
    content = mix(whole[s] * _ODD[5] + whole[e] * _ODD[6] + (n * 256 + a).astype(U64))
    return row[s], gram[p], content, s - off[row[s]], n, a


def _pieces(off: np.ndarray):
    """(row range, byte range, shift): chunks of rows; rows over CHUNK bytes in overlapping slices."""
    for i, j in spans_of(off, CHUNK):
        if j - i == 1 and off[j] - off[i] > 2 * CHUNK:
            for at in range(off[i], off[j] - LENGTH + 1, CHUNK):
                yield i, j, at, min(off[j], at + CHUNK + LENGTH - 1)
        else:
            yield i, j, off[i], off[j]


def occurrences(rows: DataFrame) -> DataFrame:
    """(h, c, key, at) of every segment; at packs start, windows and anchor place."""
    def run(batches):
        for b in batches:
            data, off = texts_of(b, "text")
            keys = np.asarray(b.column("key"))
            with np.errstate(over="ignore"):
                for i, j, lo, hi in _pieces(off):
                    own = np.clip(off[i:j + 1], lo, hi) - lo
                    found = segments(data[lo:hi], own)
                    if found is None or not len(found[0]):
                        continue
                    r, h, c, s, n, a = found
                    at = ((s + (lo - off[i] if j - i == 1 else 0)) << 16) | (n << 8) | a
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(keys[i:j][r]), pa.array(at)], ["h", "c", "key", "at"])

    return rows.select("key", "text").mapInArrow(lean(run), "h long, c long, key long, at long")


def cut_segments(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Bytes of the wanted segments (h, m, key, at): (h, m, key, place, start, bytes)."""
    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("h", "m", "at")).alias("list"))
    joined = rows.select("key", "text").join(lists, "key")

    def run(batches):
        for b in batches:
            data, off = texts_of(b, "text")
            out = []
            for i, (key, found) in enumerate(zip(b.column("key").to_pylist(), b.column("list").to_pylist())):
                for x in found:
                    s, n, a = x["at"] >> 16, x["at"] >> 8 & 255, x["at"] & 255
                    out.append((x["h"], x["m"], key, s + a, s, data[off[i] + s:off[i] + s + n - 1 + LENGTH].tobytes()))
            if out:
                h, m, k, p, s, d = zip(*out)
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (h, m, k, p, s)), pa.array(d, pa.binary())], ["h", "m", "key", "place", "start", "bytes"])

    return joined.mapInArrow(lean(run), "h long, m long, key long, place long, start long, bytes binary")


class RunLengthIndex:
    """Run-length Burrows-Wheeler transform of segments, with sampled run ends.

    ``text`` holds bytes + 1 and an end mark (0) behind each segment; end marks
    are ordered by place and equal nothing."""

    def __init__(self, segments_: list[bytes]):
        parts = [np.frombuffer(s + b"\0", np.uint8).astype(np.int64) + 1 for s in segments_]
        for p in parts:
            p[-1] = 0
        self.text = text = np.concatenate(parts)
        order = self._suffix_order(text)
        before = text[order - 1]
        # Runs of equal characters; a run of end marks is split, as they are all different.
        head = np.concatenate([[True], (before[1:] != before[:-1]) | (before[1:] == 0)])
        self.run_starts = np.nonzero(head)[0]
        self.run_chars = before[self.run_starts]
        ends = np.concatenate([self.run_starts[1:], [len(order)]]) - 1
        self.head_samples, self.end_samples = order[self.run_starts], order[ends]
        self.order = order

    @staticmethod
    def _sevens(text: np.ndarray) -> np.ndarray:
        """Seven characters from each position as one number."""
        key = np.zeros(len(text), np.int64)
        for i in range(7):
            key <<= 9
            key[:len(text) - i] |= text[i:]
        return key

    @staticmethod
    def _suffix_order(text: np.ndarray) -> np.ndarray:
        """Order of all suffixes by prefix doubling; ends of text sort first."""
        n = len(text)
        key, step = RunLengthIndex._sevens(text), 7
        while True:
            order = np.argsort(key, kind="stable")
            k = key[order]
            new = np.concatenate([[0], np.cumsum(k[1:] != k[:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = new
            if new[-1] == n - 1:
                return order
            key = rank << 32
            if step < n:
                key[:n - step] |= rank[step:] + 1
            step *= 2

    def matching_lengths(self) -> np.ndarray:
        """For every text position, the longest match with the suffix before it in order.

        Compared at run heads only; elsewhere the length is that of the
        position before, less one, streamed through the text."""
        text, n = self.text, len(self.text)
        pos, prev = self.head_samples, np.concatenate([[0], self.end_samples[:-1]])
        length = np.zeros(len(pos), np.int64)
        live = np.arange(1, len(pos))  # the first suffix has none before it
        # Seven characters at a time as long as none of them is an end mark, then one at a time.
        sevens = self._sevens(text)
        ends = np.concatenate([np.nonzero(text == 0)[0], [n]])
        to_end = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
        far = live
        while len(far):
            x, y = pos[far] + length[far], prev[far] + length[far]
            far = far[(sevens[x] == sevens[y]) & (to_end[x] >= 7) & (to_end[y] >= 7)]
            length[far] += 7
        while len(live):
            x, y = pos[live] + length[live], prev[live] + length[live]
            inside = (x < n) & (y < n)
            live, x, y = live[inside], x[inside], y[inside]
            same = (text[x] == text[y]) & (text[x] != 0)
            live = live[same]
            length[live] += 1
        value = np.full(n, -1, np.int64)
        value[pos] = length + pos
        at = np.maximum.accumulate(np.where(value >= 0, np.arange(n), 0))
        return np.maximum(value[at] - np.arange(n), 0)

    def repeated(self, length: int) -> np.ndarray:
        """Positions of windows of ``length`` that also start earlier in the text."""
        lengths = self.matching_lengths()[self.order]
        heads = np.nonzero(lengths < length)[0]
        if len(heads) == len(lengths):
            return np.zeros(0, np.int64)
        earliest = np.repeat(np.minimum.reduceat(self.order, heads), np.diff(np.concatenate([heads, [len(lengths)]])))
        return np.sort(self.order[self.order != earliest])


def _ranges(keys, starts, sizes, repeated):
    """Byte ranges (key, lo, hi) that the repeated windows of concatenated segments cover."""
    begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    seg = np.searchsorted(begin, repeated, "right") - 1
    new = np.concatenate([[True], (np.diff(repeated) > 1) | (np.diff(seg) > 0)])
    first = np.nonzero(new)[0]
    last = np.concatenate([first[1:], [len(repeated)]]) - 1
    s = seg[first]
    return keys[s], starts[s] + repeated[first] - begin[s], starts[s] + repeated[last] - begin[s] + LENGTH


_RANGE = "key long, lo long, hi long"


def index_blocks(batches):
    """Rows sorted by (h, key, place) -> ranges to remove; blocks end where an anchor does."""
    def flush(rows):
        with np.errstate(over="ignore"):
            idx = RunLengthIndex([r[3] for r in rows])
            found = idx.repeated(LENGTH)
        if len(found):
            out = _ranges(np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), np.array([len(r[3]) for r in rows]), found)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["key", "lo", "hi"])

    block, size = [], 0
    for b in batches:
        for row in zip(b.column("h").to_pylist(), b.column("key").to_pylist(), b.column("start").to_pylist(), b.column("bytes").to_pylist()):
            if size > BLOCK and row[0] != block[-1][0]:
                yield from flush(block)
                block, size = [], 0
            block.append(row)
            size += len(row[3]) + 1
    if block:
        yield from flush(block)


def hot_windows(batches):
    """Windows of segments under hot anchors: (w1, w2, key, lo)."""
    for b in batches:
        for key, s, d in zip(b.column("key").to_pylist(), b.column("start").to_pylist(), b.column("bytes").to_pylist()):
            with np.errstate(over="ignore"):
                data = np.frombuffer(d, np.uint8)
                w = window_hashes(data, (LENGTH,))[0]
                v = window_hashes(data[::-1], (LENGTH,))[0][::-1]
            yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(v.view(np.int64)), pa.array(np.full(len(w), key)), pa.array(s + np.arange(len(w)))], ["w1", "w2", "key", "lo"])


def repeated_ranges(rows: DataFrame) -> DataFrame:
    """(key, lo, hi): byte ranges covered by strings that start earlier (they may overlap)."""
    occ = occurrences(rows)
    # Stored, so that both sides of the join are plain exchanges, whose hot keys Spark can split.
    often = stage(occ.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "often")
    again = stage(occ.join(often, "h"), "segments")
    # One row per different segment; of equal ones the first stays.
    kind = stage(again.groupBy("h", "c").agg(F.min(F.struct("key", "at")).alias("first"), F.count(F.lit(1)).alias("n")), "kinds")
    later = again.join(kind.where("n > 1").select("h", "c", "first"), ["h", "c"]).where((F.col("key") != F.col("first.key")) | (F.col("at") != F.col("first.at")))
    start, windows = F.shiftright("at", 16), F.shiftright("at", 8).bitwiseAND(F.lit(255))
    whole = later.select("key", start.alias("lo"), (start + windows - 1 + LENGTH).alias("hi"))
    several = kind.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    wanted = kind.join(several, "h").select("h", "m", F.col("first.key").alias("key"), F.col("first.at").alias("at"))
    cuts = stage(cut_segments(rows, wanted), "cuts")
    dealt = cuts.where(F.col("m") <= HOT).select("h", "key", "place", "start", "bytes").repartition("h").sortWithinPartitions("h", "key", "place")
    indexed = dealt.mapInArrow(lean(index_blocks), _RANGE)
    hot = cuts.where(F.col("m") > HOT).select("key", "start", "bytes").mapInArrow(lean(hot_windows), "w1 long, w2 long, key long, lo long")
    head = hot.groupBy("w1", "w2").agg(F.min(F.struct("key", "lo")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("w1", "w2", "first")
    split = hot.join(head, ["w1", "w2"]).where((F.col("key") != F.col("first.key")) | (F.col("lo") != F.col("first.lo"))).select("key", "lo", (F.col("lo") + LENGTH).alias("hi"))
    return whole.unionByName(indexed).unionByName(split)


def _merge(ranges) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def with_ranges(rows: DataFrame) -> DataFrame:
    """The rows with ``ranges``, the list of byte ranges to remove (null: none)."""
    lists = repeated_ranges(rows).groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    return rows.join(lists, "key", "left")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    rows, _ = keyed_rows(docs, id_col, text_col)
    joined = with_ranges(rows).select("doc_id", "text", "ranges")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches):
        for b in batches:
            out = []
            for text, ranges in zip(b.column("text"), b.column("ranges")):
                data = text.as_py().encode()
                spans = _merge((r["lo"], r["hi"]) for r in ranges.as_py() or [])
                kept, at = hashlib.sha256(), 0
                for lo, hi in spans:
                    kept.update(data[at:lo])
                    at = hi
                kept.update(data[at:])
                out.append((len(data), sum(hi - lo for lo, hi in spans), len(spans), kept.hexdigest()))
            if out:
                n, m, s, d = zip(*out)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, m, s)), pa.array(d, pa.string())], names)

    return joined.mapInArrow(lean(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op10_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated strings leave the texts; n_chars follows.

    What is left of a character that a removed range cuts in two is dropped.
    Null texts stay null; all rows and columns stay.
    """
    rows, _ = keyed_rows(docs, carry=True)
    joined = with_ranges(rows.select("key", "text", "row"))
    n_chars = "n_chars" in docs.columns

    def run(batches):
        for b in batches:
            texts = []
            for text, own, ranges in zip(b.column("text"), b.column("row"), b.column("ranges")):
                spans = _merge((r["lo"], r["hi"]) for r in ranges.as_py() or []) if ranges.is_valid else []
                if not spans:
                    texts.append(None if own["text"].as_py() is None else text.as_py())
                    continue
                data, at, kept = text.as_py().encode(), 0, []
                for lo, hi in spans:
                    kept.append(data[at:lo])
                    at = hi
                texts.append(b"".join([*kept, data[at:]]).decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), b.column("row")], ["new_text", "row"])

    row_type = joined.schema["row"].dataType.simpleString()
    done = joined.select("text", "row", "ranges").mapInArrow(lean(run), f"new_text string, row {row_type}")
    return done.select(*[
        F.col("new_text").alias(c) if c == "text" else
        F.length("new_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" and n_chars else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
