"""Byte-level BPE by a hierarchical-bitmap rank queue; decoding; token counts.

Merging: positions of a linked list of tokens wait in one bucket per merge
rank; a two-level bitmap over the ranks finds the lowest non-empty bucket
by find-first-set; entries whose pair has changed since are skipped. A
pre-token of any length costs O(n log n), which suits very long ones. New
pre-tokens of many texts share one list and queue; short ones are merged a
whole bucket at a time.

Texts are split at single spaces first (a space before a non-space always
begins a pre-token), so that recurring words and pre-tokens are merged once
per worker, and their ids decoded once; a table of them is emptied when it is full. Texts with runs of white space
take the pattern over the whole text.

Rows: a null or empty text has no tokens; null ids and repeated rows are
kept; texts of any length are encoded whole; other columns are not read,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrail.llm.common import kept_in_worker, table

RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Words, and pre-tokens, kept per worker; beyond it their table starts anew.
WORDS = 400_000
#: Characters of texts whose new pre-tokens are merged together; bytes up to which a pre-token is short.
AT_ONCE, SHORT = 1 << 23, 48
_RUN = re.compile(r"\s\s")


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a rank file or from a tokenizer's JSON whose ids are ranks."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec.get("added_tokens", [])}
        # The printable stand-ins of byte-level vocabularies: visible bytes stand for themselves, the others follow from 256 on.
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in seen]
        back = {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}
        return {bytes(back[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


_BIT = [1 << i for i in range(256)]


class RankQueue:
    """Bitmaps over the ranks: one bit a rank in words of 256, one bit a non-empty word above them.

    With it a hash table of all pairs of tokens that make a token, for looking
    up the ranks of many pairs at once."""

    BITS = 21

    def __init__(self, ranks: dict[bytes, int]):
        self.words = [0] * ((max(ranks.values()) >> 8) + 1)  # all zero between merges
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)])
        self.pairs = np.full(1 << 16, -1)
        both: dict[int, int] = {}
        for t, r in ranks.items():
            if len(t) == 2:
                self.pairs[t[0] * 256 + t[1]] = r
            for i in range(1, len(t)):
                x, y = ranks.get(t[:i]), ranks.get(t[i:])
                if x is not None and y is not None:
                    both[x << 20 | y] = r
        size = 1 << max(self.BITS, len(both).bit_length() + 2)
        self.mask = size - 1
        self.keys, self.made = np.full(size, -1), np.full(size, -1)
        keys, made = np.array(list(both), np.int64), np.array(list(both.values()), np.int64)
        place, step = self._hash(keys), 0
        while len(keys):
            at = (place + step) & self.mask
            mine = np.zeros(len(keys), bool)
            mine[np.unique(at, return_index=True)[1]] = True
            mine &= self.keys[at] < 0
            self.keys[at[mine]], self.made[at[mine]] = keys[mine], made[mine]
            keys, made, place, step = keys[~mine], made[~mine], place[~mine], step + 1

    def _hash(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.int64(-7046029254386353131)) >> np.int64(40)) & self.mask

    def ranks_of(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Rank of each pair of token ids; -1: none (an id below 0 is none)."""
        key = x << 20 | y
        out = np.full(len(key), -1)
        place, todo, step = self._hash(key), np.flatnonzero((x >= 0) & (y >= 0)), 0
        while len(todo):
            at = (place[todo] + step) & self.mask
            held = self.keys[at]
            hit = held == key[todo]
            out[todo[hit]] = self.made[at[hit]]
            todo, step = todo[~hit & (held >= 0)], step + 1
        return out


def merge_short(pieces: list[bytes], queue: RankQueue) -> list[list[int]]:
    """Ids of many short pre-tokens, as ``merge_all`` gives them.

    The same linked list, buckets and bitmaps; of the bucket that
    find-first-set picks, the leftmost live entry of every pre-token is merged
    at once, stale ones are skipped and the others wait in the bucket. Order
    matters inside a pre-token alone, so each sees its own lowest rank first."""
    if not pieces:
        return []
    buf = b"\0".join(pieces) + b"\0"
    n, sizes = len(buf), np.array([len(p) + 1 for p in pieces])
    ids = queue.bytes[np.frombuffer(buf, np.uint8)]
    ids[np.cumsum(sizes) - 1] = -1  # barriers
    piece = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
    nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
    pair = np.append(queue.ranks_of(ids[:-1], ids[1:]), -1)
    words, top = queue.words, 0
    buckets: dict[int, list[np.ndarray]] = {}

    def push(at: np.ndarray, ranks: np.ndarray) -> None:
        nonlocal top
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        for i, j, r in zip(cuts[:-1], cuts[1:], ranks[cuts[:-1]].tolist()):
            if r in buckets:
                buckets[r].append(at[i:j])
            else:
                buckets[r] = [at[i:j]]
                words[r >> 8] |= _BIT[r & 255]
                top |= 1 << (r >> 8)

    first = np.flatnonzero(pair >= 0)
    if len(first):
        push(first, pair[first])
    while top:
        w = (top & -top).bit_length() - 1
        word = words[w]
        low = word & -word
        rank = (w << 8) + low.bit_length() - 1
        words[w] = word = word ^ low
        if not word:
            top &= top - 1
        held = buckets.pop(rank)
        at = np.unique(np.concatenate(held)) if len(held) > 1 else held[0]
        at = at[pair[at] == rank]  # the others are stale
        if not len(at):
            continue
        lead = np.append(True, piece[at[1:]] != piece[at[:-1]])
        if not lead.all():
            push(at[~lead], np.full(len(at) - int(lead.sum()), rank))
            at = at[lead]
        gone = nxt[at]
        behind, before = nxt[gone], prv[at]
        nxt[at], prv[behind], ids[at], ids[gone], pair[gone] = behind, at, rank, -1, -1
        own, left = np.full(len(at), rank), np.where(before >= 0, ids[before], -1)
        ranks = queue.ranks_of(np.concatenate([own, left]), np.concatenate([ids[behind], own]))
        pair[at] = ranks[:len(at)]
        inner = left >= 0
        pair[before[inner]] = ranks[len(at):][inner]
        live = ranks >= 0
        if live.any():
            push(np.concatenate([at, before])[live], ranks[live])
    keep = ids >= 0
    flat, ends = ids[keep].tolist(), np.cumsum(np.bincount(piece[keep], minlength=len(pieces))).tolist()
    return [flat[i:j] for i, j in zip([0, *ends[:-1]], ends)]


def merge_all(pieces: list[bytes], ranks: dict[bytes, int], queue: RankQueue) -> list[list[int]]:
    """Ids of each pre-token: lowest rank first, leftmost among equals.

    All pre-tokens share one linked list, with a barrier behind each that no
    pair crosses, and one queue; only the order inside a pre-token matters.
    Queue operations stand inline: they are the inner loop."""
    if not pieces:
        return []
    buf = b"\0".join(pieces) + b"\0"
    n = len(buf)
    ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
    data = np.frombuffer(buf, np.uint8).astype(np.int64)
    inside = np.ones(n, bool)
    inside[ends] = False
    first = queue.pairs[data[:-1] * 256 + data[1:]]
    first[~(inside[:-1] & inside[1:])] = -1
    pair = first.tolist() + [-1]  # rank of the pair that starts here; -1: none, or the token is gone
    ids = queue.bytes[data].tolist()
    barrier = (~inside).tolist()
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    get, words, top, buckets, bit = ranks.get, queue.words, 0, {}, _BIT
    # Buckets of the first pairs: positions by rank.
    at = np.nonzero(first >= 0)[0]
    at = at[np.argsort(first[at], kind="stable")]
    for own in np.split(at, np.nonzero(np.diff(first[at]))[0] + 1) if len(at) else []:
        r = pair[own[0]]
        buckets[r] = own.tolist()
        words[r >> 8] |= bit[r & 255]
        top |= 1 << (r >> 8)
    while top:
        # Find-first-set on both levels gives the lowest rank; its bucket the leftmost position.
        w = (top & -top).bit_length() - 1
        word = words[w]
        low = word & -word
        rank = (w << 8) + low.bit_length() - 1
        words[w] = word = word ^ low
        if not word:
            top &= top - 1
        bucket = buckets.pop(rank)
        bucket.sort(reverse=True)  # leftmost last
        lowest = rank
        while bucket:
            i = bucket.pop()
            if pair[i] != rank:
                continue  # stale: its pair has changed since
            j = nxt[i]
            k = nxt[j]
            nxt[i] = k
            prv[k] = i
            ids[i] = rank  # a token's id is its rank
            pair[j] = -1
            if barrier[k]:
                pair[i] = -1
            else:
                r = get(buf[i:nxt[k]], -1)
                pair[i] = r
                if r >= 0:
                    if r == rank:
                        bucket.append(i)
                        bucket.sort(reverse=True)
                    elif r in buckets:
                        buckets[r].append(i)
                    else:
                        buckets[r] = [i]
                        words[r >> 8] |= bit[r & 255]
                        top |= 1 << (r >> 8)
                    if r < lowest:
                        lowest = r
            p = prv[i]
            if p >= 0 and not barrier[p]:
                r = get(buf[p:k], -1)
                pair[p] = r
                if r >= 0:
                    if r == rank:
                        bucket.append(p)
                        bucket.sort(reverse=True)
                    elif r in buckets:
                        buckets[r].append(p)
                    else:
                        buckets[r] = [p]
                        words[r >> 8] |= bit[r & 255]
                        top |= 1 << (r >> 8)
                    if r < lowest:
                        lowest = r
            if lowest < rank:
                # A lower rank has come up: the rest of this bucket waits for its turn.
                if bucket:
                    buckets[rank] = bucket
                    words[rank >> 8] |= bit[rank & 255]
                    top |= 1 << (rank >> 8)
                break
    out, i = [], 0
    own: list[int] = []
    while i < n:
        if barrier[i]:
            out.append(own)
            own = []
        else:
            own.append(ids[i])
        i = nxt[i]
    return out


class Encoder:
    """Ids of whole texts; recurring words and pre-tokens are kept."""

    def __init__(self, path: str = RANK_FILE, pattern: str = public_tokenizers.PATTERN):
        self.ranks = load_ranks(path)
        self.table = {i: t for t, i in self.ranks.items()}
        self.decimal = {i: str(i) for i in self.table}
        self.pattern = regex.compile(pattern)
        self.queue = RankQueue(self.ranks)
        #: Pre-tokens, and words that are several: number of ids, their decimal text, the bytes that they decode to.
        self.merged: dict[str, tuple[int, str, bytes]] = {}
        self.known: dict[str, tuple[int, str, bytes]] = {}

    def _join(self, found: list[str]) -> tuple[int, str, bytes]:
        counts, ids, decoded = zip(*map(self.merged.__getitem__, found))
        return sum(counts), " ".join(ids), b"".join(decoded)

    def _merge(self, todo: list[str]) -> None:
        """Encode pre-tokens, and decode their ids, once."""
        short, long = [], []
        get, merged = self.ranks.get, self.merged
        for p in todo:
            data = p.encode()
            own = get(data)
            if own is not None:
                merged[p] = (1, self.decimal[own], self.table[own])
            else:
                (short if len(data) <= SHORT else long).append((p, data))
        decimal, token = self.decimal.__getitem__, self.table.__getitem__
        for group, found in ((short, merge_short([d for _, d in short], self.queue)), (long, merge_all([d for _, d in long], self.ranks, self.queue))):
            for (p, _), ids in zip(group, found):
                merged[p] = (len(ids), " ".join(map(decimal, ids)), b"".join(map(token, ids)))

    def words(self, texts: list[str]) -> list[list[tuple[int, str, bytes]]]:
        """For each text, of consecutive parts: the number of ids, their
        decimal text and the bytes that they decode to. A recurring part is
        encoded and decoded once."""
        known, merged, find = self.known, self.merged, self.pattern.findall
        if len(known) > WORDS:
            known.clear()
        if len(merged) > WORDS:
            merged.clear()
        # Texts with runs of white space stay whole; in others a single space begins each part but the first.
        parts = [([], t) if _RUN.search(t) else (lambda first, *rest: (rest, first))(*t.split(" ")) for t in texts]
        new = set(chain.from_iterable(rest for rest, _ in parts)).difference(known)
        # Letters alone are one pre-token, with one full stop or comma behind them two; the pattern splits the rest.
        single = [w for w in new if w.isalpha()]
        several = {w: [" " + w[:-1], w[-1]] if w[-1:] in (".", ",") and w[:-1].isalpha() else find(" " + w) for w in new.difference(single)}
        heads = [find(first) for _, first in parts]
        wanted = {" " + w for w in single}
        wanted.update(chain.from_iterable(several.values()), chain.from_iterable(heads))
        self._merge(list(wanted.difference(merged)))
        for w in single:
            known[w] = merged[" " + w]
        for w, found in several.items():
            known[w] = self._join(found)
        return [[self._join(head), *map(known.__getitem__, rest)] if head else list(map(known.__getitem__, rest)) for head, (rest, _) in zip(heads, parts)]

    def encode(self, text: str) -> list[int]:
        return [int(i) for _, ids, _ in self.words([text])[0] for i in ids.split(" ")]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))


def _groups(texts: list[str]):
    """Runs of texts of about ``AT_ONCE`` characters (a longer text comes alone)."""
    own, size = [], 0
    for t in texts:
        if own and size + len(t) > AT_ONCE:
            yield own
            own, size = [], 0
        own.append(t)
        size += len(t)
    if own:
        yield own


def encode_documents(docs: DataFrame, path: str = RANK_FILE, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches):
        enc = kept_in_worker(f"bpe:{path}", lambda: Encoder(path))
        for b in batches:
            n, a, d, all_ids = [], [], [], []
            texts = b.column("text").to_pylist()
            for parts in chain.from_iterable(map(enc.words, _groups([t or "" for t in texts]))):
                counts, ids, decoded = zip(*parts) if parts else ((), (), ())
                ids = " ".join(ids)
                n.append(sum(counts))
                a.append(hashlib.sha256(ids.encode()).hexdigest())
                d.append(hashlib.sha256(b"".join(decoded)).hexdigest())
                if with_ids:
                    all_ids.append([int(i) for i in ids.split(" ")] if ids else [])
            cols = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(all_ids, pa.list_(pa.int32()))] * with_ids, names)

    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)


def op7_rank_queue_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))
