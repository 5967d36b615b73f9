"""SpotSigs fingerprints: content-word chains that follow common-word anchors.

A signature is an anchor with the next ``CHAIN`` content words behind it; a
fingerprint is the set of a text's signatures, as sorted 32-bit hashes. Two
fingerprints are compared by Jaccard likeness, pruned by the sets' lengths.
A text without any signature falls back to its words, then to itself as one
signature; an empty text has the empty set; two empty sets are alike (1).

The query deals documents into key ranges, with the first row of a range
also sent to the range before it, so that each row meets its successor in
one shuffle; a task streams over sorted rows and holds two at a time.

Rows: null texts are empty; null or repeated ids are put in (doc_id, text)
order, nulls first; a single row is its own successor; texts of any length
are read whole; other columns are not read, whatever their names; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabrail.llm.common import keyed, stage, table

#: Anchors: fixed lists of common words in the corpus' languages.
ANCHORS = frozenset((
    "a an the of to in on at by for from with and or is are was were be that this it as not but "
    "der die das des dem den ein eine einer und in zu von mit für auf ist im sich nicht als auch an "
    "le la les de des du un une et en est que qui dans pour par sur avec pas au "
    "el los las del y o en un una que se por con para su al no es").split())
CHAIN = 2
MOST_RANGES = 4096
_WORD = re.compile(r"\w+")


def signatures(text: str, chain: int = CHAIN) -> np.ndarray:
    """Sorted distinct 32-bit signatures of a text."""
    words = _WORD.findall(text.lower())
    out, crc = set(), zlib.crc32
    if chain == 2:
        one = two = ""
        for w in reversed(words):
            if w in ANCHORS:
                if two:
                    out.add(crc(f"{w} {one} {two}".encode()))
            else:
                two, one = one, w
    else:
        ahead: list[str] = []
        for w in reversed(words):
            if w not in ANCHORS:
                ahead = [w, *ahead[:chain - 1]]
            elif len(ahead) == chain:
                out.add(crc(" ".join([w, *ahead]).encode()))
    if not out:
        out = {crc(w.encode()) for w in words} or ({crc(text.encode())} if text else out)
    return np.sort(np.fromiter(out, np.uint32, len(out)))


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard likeness of two sorted sets; 0 at once if their lengths rule ``least`` out."""
    if not len(a) and not len(b):
        return 1.0
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def text_form(sigs: np.ndarray) -> str:
    return sigs.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, doc_id, n, sigs) of every row."""
    rows = keyed(docs, id_col, text_col)

    def run(batches):
        for b in batches:
            sigs = [signatures(t.as_py()).astype(np.int64) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("doc_id"), pa.array([len(s) for s in sigs], pa.int32()), pa.array(sigs, pa.list_(pa.int64()))],
                                             ["key", "doc_id", "n", "sigs"])

    return rows.mapInArrow(run, "key long, doc_id long, n int, sigs array<long>")


def near_pairs(docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Pairs of alike fingerprints, and who has which.

    Members: (doc_id, rep); equal fingerprints share a representative. Pairs:
    (a, b, likeness) of representatives. Sets are partitioned by length (a set
    meets its own and the next length class, so no pair over ``least`` is
    lost) and only the rarest signatures, which any alike pair must share one
    of, are joined.
    """
    fp = stage(fingerprints(docs, id_col, text_col), "spot").withColumn("same", F.sha2(F.concat_ws(",", F.col("sigs").cast("array<string>")), 256))
    reps = fp.where("n > 0").groupBy("same").agg(F.min("key").alias("rep"))
    members = fp.join(reps, "same", "left").select("doc_id", F.coalesce("rep", "key").alias("rep"))
    sets = fp.join(reps, F.col("key") == F.col("rep"), "left_semi").select("key", "n", "sigs")
    sig = sets.select("key", "n", F.explode("sigs").alias("sig"))
    freq = sig.groupBy("sig").agg(F.count(F.lit(1)).alias("df"))
    place = F.row_number().over(Window.partitionBy("key").orderBy("df", "sig"))
    prefix = sig.join(freq, "sig").withColumn("i", place).where((F.col("i") <= F.col("n") - F.ceil(F.col("n") * least) + 1) & (F.col("df") > 1))
    step = float(np.log(1 / least)) if least < 1 else 1e-6
    prefix = prefix.select("sig", "key", "n", F.floor(F.log(F.col("n").cast("double")) / step).alias("p"))
    left = prefix.withColumn("q", F.explode(F.array("p", F.col("p") + 1)))
    right = prefix.select("sig", F.col("p").alias("q"), F.col("key").alias("k2"), F.col("n").alias("n2"))
    cand = left.join(right, ["sig", "q"]).where(((F.col("n") < F.col("n2")) | ((F.col("n") == F.col("n2")) & (F.col("key") < F.col("k2")))) & (F.col("n") >= F.col("n2") * least)).select(F.col("key").alias("a"), F.col("k2").alias("b")).distinct()
    got = cand.join(sets.select(F.col("key").alias("a"), F.col("sigs").alias("x")), "a").join(sets.select(F.col("key").alias("b"), F.col("sigs").alias("y")), "b")
    both = F.size(F.array_intersect("x", "y"))
    pairs = got.select("a", "b", (both / (F.size("x") + F.size("y") - both)).alias("likeness")).where(F.col("likeness") >= least)
    return members, pairs


def with_successor(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """Rows (part, ahead, key, doc_id, text), sorted inside partitions so that a
    row's successor follows it; ``ahead`` marks the row that only closes a part."""
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    parts = max(1, min(MOST_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    probs = [i / parts for i in range(1, parts)]
    cuts = sorted(set(rows.agg(F.percentile_approx("key", probs, 10 * parts).alias("c")).collect()[0]["c"] or [])) if probs else []
    shared = spark.sparkContext.broadcast(np.array(cuts, np.int64))

    def part_only(batches):
        for b in batches:
            k = np.asarray(b.column("key"))
            yield pa.RecordBatch.from_pydict({"part": np.searchsorted(shared.value, k, "right").astype(np.int32), "key": k})

    # One row per part.
    heads = {r["part"]: r["head"] for r in rows.select("key").mapInArrow(part_only, "part int, key long").groupBy("part").agg(F.min("key").alias("head")).collect()}
    order = sorted(heads)
    before = {heads[p]: order[i - 1] for i, p in enumerate(order)}
    first = spark.sparkContext.broadcast(before)

    def deal(batches):
        for b in batches:
            k = np.asarray(b.column("key"))
            part = np.searchsorted(shared.value, k, "right").astype(np.int32)
            lead = [i for i, x in enumerate(k.tolist()) if x in first.value]
            take = np.concatenate([np.arange(len(k)), np.array(lead, np.int64)])
            to = np.concatenate([part, np.array([first.value[int(k[i])] for i in lead], np.int32)])
            ahead = np.arange(len(take)) >= len(k)
            t = b.take(pa.array(take))
            yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(ahead), t.column("key"), t.column("doc_id"), t.column("text")], ["part", "ahead", "key", "doc_id", "text"])

    dealt = rows.mapInArrow(deal, "part int, ahead boolean, key long, doc_id long, text string")
    return dealt.repartition(parts, "part").sortWithinPartitions("part", "ahead", "key"), parts


def _stream(batches):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    held = None  # part, doc_id, text, signatures of the row that waits for its successor
    for b in batches:
        out = []
        for part, ahead, doc, text in zip(b.column("part").to_pylist(), b.column("ahead").to_pylist(), b.column("doc_id").to_pylist(), b.column("text")):
            text = text.as_py()
            sigs = signatures(text)
            if held is not None and held[0] == part:
                _, own, t, s = held
                h = len(t) // 2
                edited = t[:len(t) - h] + text[:h]
                es = signatures(edited)
                out.append((own, len(t), hashlib.sha256(edited.encode()).hexdigest(), text_form(s), text_form(es), jaccard(s, es), jaccard(s, sigs)))
            held = None if ahead else (part, doc, text, sigs)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likenesses."""
    rows, _ = with_successor(docs)
    return rows.select("part", "ahead", "doc_id", "text").mapInArrow(
        _stream, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(table(spark, sf_dir, "documents"))
