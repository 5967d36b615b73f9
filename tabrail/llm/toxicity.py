"""Toxicity scores after noisy-channel deobfuscation.

A word that looks obfuscated (leetspeak, separators between letters, a letter
repeated three times or more, letters spelled apart) becomes a lattice of
what each character may stand for; Viterbi decoding under a character trigram
model of the whole corpus restores the likeliest spelling. Words, as they are
and restored, are scored by the log-odds of their spelling and of their first
letters in labelled texts; a logistic curve over the strongest evidence gives
the text's score.

Learning uses only labelled rows whose crc32(doc_id) mod 3 is not 1, at most
``TRAIN_ROWS`` of each label (a documented bound, chosen by hash); trigram
counts cover every text. lang, source and doc_id are never inputs of a score.

Rows: null and empty texts get the score of a text without evidence; null ids
are held in (their remainder is null); repeated rows score alike; texts of
any length are scored whole; other columns are not read (the pipeline stage
keeps them), whatever their names; an empty table gives an empty result;
without labels of both kinds every score is 0.
"""

from __future__ import annotations

import re
import zlib
from math import exp, log, log1p, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabrail.llm.common import lean, spans_of, stage, table, texts_of

TRAIN_ROWS = 8192
THRESHOLD = 0.7
#: Clean rows of the training folds that may reach the threshold; beyond it scores are lowered.
CLEAN_SHARE = 0.001
#: Buckets of hashed word features; texts of each label that must hold a feature.
BUCKETS, LEAST = 1 << 22, 3
WORDS = 200_000
#: Standard deviations that a word's log-odds are lowered by: of very many words some are lopsided by chance.
SURE = 1.64
#: Letters that may follow a word's first ones in an inflected form.
ENDING = 3
#: What a character may stand for (fixed values).
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¢": "c"}
SEPARATORS = ".-_*~'`·•/\\,:;"
EDGE = ".,;:?*&%#\"'()[]{}<>/\\|~`-_=…«»“”„!"
#: Channel costs (natural logs): a stand-in, a dropped separator, a dropped repeat, a dropped sign.
COST_LEET, COST_SEPARATOR, COST_REPEAT, COST_SIGN = 1.0, 0.5, 0.7, 3.0
#: Odd multipliers of the min-hashes by which near copies in the sample count once.
MARKS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)
#: Likeness (Jaccard) of the word triples from which two texts of one label are near copies.
ALIKE = 0.8
_LONG_RUN = re.compile(r"(.)\1\1")
_SPELLED = re.compile(r"(?<!\S)(?:[^\W_][ .\-_*]){2,}[^\W_](?!\S)")
#: Letter classes: 0 edge, 1-26 a-z, 27-58 other letters by code point.
CLASSES = 59


def letter_class(c: str) -> int:
    o = ord(c)
    return o - 96 if 97 <= o <= 122 else 27 + (o & 31)


def _class_table() -> np.ndarray:
    t = np.zeros(0x110000, np.uint8)
    for o in range(0x250):
        c = chr(o).lower()
        if len(c) == 1 and c.isalpha():
            t[o] = letter_class(c)
    rest = np.arange(0x250, 0x110000)
    t[0x250:] = 27 + (rest & 31)
    t[0x2000:0x2C00] = t[0x3000:0x3040] = 0  # punctuation and signs
    return t


def trigram_counts(docs: DataFrame, text_col: str = "text") -> dict[int, int]:
    """Counts of letter-class trigrams (at most CLASSES ** 3) over every text."""
    def count(batches):
        t, own = _class_table(), np.zeros(CLASSES ** 3, np.int64)
        for b in batches:
            data, off = texts_of(b, "text")
            for i, j in spans_of(off, 1 << 20):
                # Texts apart by an edge; two edges before the first letter of a word.
                s = " ".join([data[off[r]:off[r + 1]].tobytes().decode("utf-8", "replace") for r in range(i, j)])
                c = t[np.frombuffer(f"  {s}  ".encode("utf-32-le"), np.uint32)].astype(np.int32)
                keep = (c[2:] > 0) | (c[1:-1] > 0)
                before = np.where(c[1:-1] > 0, c[:-2], 0)
                own += np.bincount(((before * CLASSES + c[1:-1]) * CLASSES + c[2:])[keep], minlength=CLASSES ** 3)
        at = np.nonzero(own)[0]
        yield pa.RecordBatch.from_pydict({"gram": pa.array(at, pa.int32()), "n": pa.array(own[at], pa.int64())})

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(lean(count), "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return {r["gram"]: r["n"] for r in rows}


class Restorer:
    """Viterbi decoding of one word's lattice; states are the last two letters."""

    def __init__(self, counts: dict[int, int]):
        n = np.zeros(CLASSES ** 3)
        for g, c in counts.items():
            n[g] = c
        cube = n.reshape(CLASSES, CLASSES, CLASSES)
        pairs, ones = cube.sum(axis=0), cube.sum(axis=(0, 1))
        uni = (ones + 1) / (ones.sum() + CLASSES)
        bi = (pairs + 10 * uni) / (pairs.sum(axis=1, keepdims=True) + 10)
        tri = (cube + 10 * bi[None]) / (cube.sum(axis=2, keepdims=True) + 10)
        self.logp = np.log(tri).ravel().tolist()

    def lattice(self, word: str):
        """Per character: (letter or '' for none, cost) options."""
        out, last, n = [], "", len(word)
        for i, c in enumerate(word):
            options = []
            if c.isalpha():
                options.append((c, 0.0))
                if c == last:
                    options.append(("", COST_REPEAT))
            elif c in LEET:
                options += [(x, COST_LEET) for x in LEET[c]]
                # A digit always stands for a letter: dropped, it would save one.
                if not c.isdigit():
                    options.append(("", COST_SIGN if 0 < i < n - 1 else COST_SEPARATOR))
            else:
                options.append(("", COST_SEPARATOR if c in SEPARATORS else COST_SIGN))
            out.append(options)
            last = c
        return out

    def __call__(self, word: str) -> str:
        logp = self.logp
        states = {(0, 0): (0.0, None)}  # (last two classes) -> (score, back pointer)
        for options in self.lattice(word):
            new: dict = {}
            for (a, b), (score, back) in states.items():
                for letter, cost in options:
                    if letter:
                        c = letter_class(letter)
                        key, s, chain = (b, c), score - cost + logp[(a * CLASSES + b) * CLASSES + c], (letter, back)
                    else:
                        key, s, chain = (a, b), score - cost, back
                    if key not in new or s > new[key][0]:
                        new[key] = (s, chain)
            states = new
        best = max(states.items(), key=lambda x: x[1][0] + logp[(x[0][0] * CLASSES + x[0][1]) * CLASSES])[1][1]
        out = []
        while best:
            out.append(best[0])
            best = best[1]
        return "".join(reversed(out))


def looks_hidden(w: str) -> bool:
    return not w.isalpha() and any(c.isalpha() for c in w) or bool(_LONG_RUN.search(w))


class Words:
    """Restored spellings and hashed features of words; known words are kept per task."""

    def __init__(self, restorer: Restorer):
        self.restore = restorer

    def spellings(self, word: str) -> tuple[str, ...]:
        w = word.lower().strip(EDGE)
        if not w:
            return ()
        if not looks_hidden(w):
            return (w,)
        # Digits at an edge may be a number of its own beside the word.
        own = w.strip("0123456789")
        found = [self.restore(w), *([] if own == w or not own else [self.restore(own) if looks_hidden(own) else own])]
        return tuple(dict.fromkeys([w, *(r for r in found if r)]))

    def features(self, word: str) -> set[int]:
        out = set()
        for s in self.spellings(word):
            out.add(zlib.crc32(s.encode()) % BUCKETS)
            out.update(zlib.crc32(b"^" + s[:n].encode()) % BUCKETS for n in (4, 5, 6) if n <= len(s) <= n + ENDING)
        return out


def words_of(text: str) -> list[str]:
    """Distinct words, and letters that were spelled apart put together."""
    words = text.split()
    if sum(1 for w in words if len(w) == 1) > 2 or "." in text or "-" in text:
        spelled = [re.sub(r"[ .\-_*]", "", m) for m in _SPELLED.findall(text)] if any(len(w) == 1 or len(w) > 4 and w[1] in ".-_*" for w in words) else []
    else:
        spelled = []
    return list(dict.fromkeys(words + spelled))


def strongest(features, get) -> tuple[float, int]:
    """A word's strongest feature: (strength, feature)."""
    return max(((get(f, 0.0), f) for f in features), default=(0.0, 0))


def evidence(found) -> tuple[float, float, float]:
    """Strongest, second strongest, and (log) number of strong features; words
    that owe their strength to one feature (forms of a word) count once."""
    s = sorted({f: z for z, f in found if z > 0}.values(), reverse=True)
    return (s[0] if s else 0.0, s[1] if len(s) > 1 else 0.0, log1p(sum(1 for x in s if x > 2)))


def strengths_of(counts: np.ndarray, totals: tuple[int, int]) -> dict[int, float]:
    """Bucket -> lower bound of its log-odds, where positive."""
    out = {}
    n0, n1 = totals
    for bucket, d0, d1 in counts.tolist():
        if d1 >= LEAST:
            s = log((d1 + 0.5) / (n1 + 1)) - log((d0 + 0.5) / (n0 + 1)) - SURE * sqrt(1 / (d1 + 0.5) + 1 / (d0 + 0.5))
            if s > 0:
                out[int(bucket)] = s
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def at_threshold(w: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Lower the intercept until at most ``CLEAN_SHARE`` of the clean rows score ``THRESHOLD`` or more."""
    clean = np.sort(x[y == 0] @ w[:3] + w[3])
    spare = int(CLEAN_SHARE * len(clean))
    highest = clean[len(clean) - 1 - spare]
    w = w.copy()
    w[3] -= max(0.0, highest - log(THRESHOLD / (1 - THRESHOLD)) + 1e-9)
    return w


def _remainder(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


class Model:
    def __init__(self, restorer: Restorer, strengths: dict[int, float], weights):
        self.restorer, self.strengths, self.weights = restorer, strengths, weights

    def scorer(self):
        words, get, known, w = Words(self.restorer), self.strengths.get, {}, self.weights

        def score(text: str) -> float:
            if w is None:
                return 0.0
            found = words_of(text)
            zs = list(map(known.get, found))
            if None in zs:
                if len(known) > WORDS:
                    known.clear()
                for i, z in enumerate(zs):
                    if z is None:
                        zs[i] = known[found[i]] = strongest(words.features(found[i]), get)
            s = w[3] + sum(a * b for a, b in zip(w, evidence(zs)))
            return 1 / (1 + exp(-max(-30.0, min(30.0, s))))

        return score


def near_copies(texts: DataFrame) -> DataFrame:
    """Ids of the texts (id, y, m0, m1, m2, triples) that a text with a smaller id stands for.

    A shared mark only proposes a pair; the likeness of the triple sets decides,
    so texts that share a passage both stay. Three agreeing marks are looked at
    apart from single ones, where an unlike text may have the smallest id."""
    out = None
    for marks in (["m0", "m1", "m2"], ["m0"], ["m1"], ["m2"]):
        # The smallest id stands for its near copies, so that a fit repeats exactly.
        first = (texts.groupBy("y", *marks).agg(F.min_by(F.struct("id", "triples"), "id").alias("x"), F.count(F.lit(1)).alias("n")).where("n > 1")
                 .select("y", *marks, F.col("x.id").alias("first"), F.col("x.triples").alias("others")))
        both = F.size(F.array_intersect("triples", "others"))
        found = (texts.join(first, ["y", *marks]).where(F.col("id") != F.col("first"))
                 .where(both >= ALIKE * (F.size("triples") + F.size("others") - both)).select("id"))
        out = found if out is None else out.unionByName(found)
    return out.distinct()


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample of labelled rows; trigrams on every text of ``docs``."""
    spark = docs.sparkSession
    restorer = Restorer(trigram_counts(docs))
    own = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("y")).where("id is not null and y in (0, 1)")
    own = own.withColumn("fold", _remainder(F.col("id"))).where("fold != 1").distinct()
    # Hashes are spread evenly, so those under the cut hold the smallest TRAIN_ROWS of a label
    # (by six standard deviations), and no task sorts more than about that many.
    low = F.lit(False)
    for r in own.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect():
        share = min(1.0, (TRAIN_ROWS + 6 * sqrt(TRAIN_ROWS)) / r["n"])
        low = low | ((F.col("y") == r["y"]) & (F.xxhash64("id") <= F.lit(int(share * 2**64) - 2**63 - 1)))
    own = own.where(low)
    rank = F.row_number().over(Window.partitionBy("y").orderBy(F.xxhash64("id"), "id"))
    chosen = own.withColumn("i", rank).where(F.col("i") <= TRAIN_ROWS).select("id", "y", "fold")
    # 2 * TRAIN_ROWS rows at most, whatever the input's size.
    train = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "id")

    def features(batches):
        words = Words(restorer)
        known: dict[str, list[int]] = {}
        for b in batches:
            rows = []
            for key, y, fold, text in zip(b["id"], b["y"], b["fold"], b["text"]):
                found, feats = words_of(text), []
                for w in found:
                    f = known.get(w)
                    if f is None:
                        if len(known) > WORDS:
                            known.clear()
                        f = known[w] = list(words.features(w))
                    feats.append(f)
                # Min-hashes of word triples stand for a text and its near copies.
                crcs = np.array([zlib.crc32(" ".join(t).encode()) for t in zip(found, found[1:], found[2:])] or [zlib.crc32(text.encode())], np.uint64)
                crcs = np.unique(crcs)
                rows.append((key, y, fold, *(int((crcs * np.uint64(m) & np.uint64(0xFFFFFFFF)).min()) for m in MARKS), crcs.astype(np.int64), feats))
            yield pd.DataFrame(rows, columns=["id", "y", "fold", "m0", "m1", "m2", "triples", "feats"])

    texts = train.repartition(8).mapInPandas(lean(features), "id long, y int, fold long, m0 long, m1 long, m2 long, triples array<long>, feats array<array<int>>")
    texts = stage(texts, "train")
    texts = stage(texts.join(near_copies(texts.drop("fold", "feats")), "id", "left_anti").drop("triples"), "train")
    size = {(r["y"], r["fold"]): r["n"] for r in texts.groupBy("y", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not any(y == 0 for y, _ in size) or not any(y == 1 for y, _ in size):
        return Model(restorer, {}, None)
    each = texts.select("y", "fold", F.explode(F.array_distinct(F.flatten("feats"))).alias("f"))
    tally = lambda y, fold: F.count(F.when((F.col("y") == y) & (F.col("fold") == fold), 1))
    counts = each.groupBy("f").agg(*[tally(y, k).alias(f"n{y}{k}") for y in (0, 1) for k in (0, 2)]).where(F.col("n10") + F.col("n12") >= LEAST).toPandas()
    c = counts.to_numpy()  # at most BUCKETS rows: f, n00, n02, n10, n12
    n = {(y, k): size.get((y, k), 0) for y in (0, 1) for k in (0, 2)}
    # Evidence of one fold's texts is weighed by the other fold's counts, so that the curve is fit on honest evidence.
    by_fold = {0: strengths_of(c[:, [0, 2, 4]], (n[0, 2], n[1, 2])), 2: strengths_of(c[:, [0, 1, 3]], (n[0, 0], n[1, 0]))}
    shared = spark.sparkContext.broadcast(by_fold)

    def weigh(batches):
        for b in batches:
            ev = [evidence([strongest(w, shared.value[k].get) for w in feats]) for k, feats in zip(b["fold"], b["feats"])]
            yield pd.DataFrame({"y": b["y"], **{f"e{i}": [e[i] for e in ev] for i in range(3)}})

    fit = texts.mapInPandas(lean(weigh), "y int, e0 double, e1 double, e2 double").toPandas()
    weights = fit_logistic(fit[["e0", "e1", "e2"]].to_numpy(), fit["y"].to_numpy(float))
    weights = at_threshold(weights, fit[["e0", "e1", "e2"]].to_numpy(), fit["y"].to_numpy())
    whole = strengths_of(np.stack([c[:, 0], c[:, 1] + c[:, 2], c[:, 3] + c[:, 4]], axis=1), (n[0, 0] + n[0, 2], n[1, 0] + n[1, 2]))
    return Model(restorer, whole, weights.tolist())


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; one narrow pass."""
    rows = docs.select(F.col("doc_id"), (_remainder(F.col("doc_id")) == 1).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        score = shared.value.scorer()
        for b in batches:
            s = np.array([score(t.as_py()) for t in b.column("text")], float)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(lean(run), f"doc_id {kind}, held_out boolean, score double, predicted int").withColumn("held_out", F.coalesce("held_out", F.lit(False)))


def op5_noisy_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, learn(docs, table(spark, sf_dir, "labels")))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows whose text scores under the threshold stay, unchanged."""
    shared = spark.sparkContext.broadcast(learn(docs, table(spark, sf_dir, "labels")))

    def run(batches):
        score = shared.value.scorer()
        for b in batches:
            yield b.filter(pa.array([score(t.as_py() or "") < THRESHOLD for t in b.column("text")], pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)
