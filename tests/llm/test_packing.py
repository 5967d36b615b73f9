import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from tabrail.llm import packing as K


def test_ids_equal_the_tokenizers_library():
    t, count, r = Tokenizer.from_file(K.TOKENIZER), K.Counter(K.TOKENIZER), random.Random(2)
    t.encode_special_tokens = True
    texts = ["", "a", " a", "a  b", "x\n y", "é 12!"] + ["".join(r.choice("the nd abc.\n,é") for _ in range(80)) for _ in range(500)]
    for text, e in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(count(text), "<u4").tolist() == e.ids


def test_added_tokens_are_ids_of_their_own_as_in_the_library(spark):
    t, count, r = Tokenizer.from_file(K.TOKENIZER), K.Counter(K.TOKENIZER), random.Random(3)
    end = "<|endoftext|>"
    texts = ["see <|endoftext|> here", end, end + end, " " + end + "  " + end + "\n", "a" + end + "b", "<|endoftext|", "x <|<|endoftext|>|> y", "<|ENDOFTEXT|>"]
    texts += ["".join(r.choice([end, " ", "  ", "the", " nd", ",\n", "é", "<|"]) for _ in range(30)) for _ in range(300)]
    ids = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert ids[0] == [3826, 220, 50256, 994]
    assert [np.frombuffer(count(x), "<u4").tolist() for x in texts] == ids
    out = K.pack_documents(spark.createDataFrame([(1, texts[0])], "doc_id long, text string")).collect()
    assert [(x.length, x.ids_crc32) for x in out] == [(5, zlib.crc32(np.array(ids[0] + [K.END_ID], "<u4").tobytes()))]


def test_cut():
    assert K.cut(5, 4) == [(0, 1), (1, 4)] and K.cut(8, 4) == [(0, 4), (4, 4)] and K.cut(3, 4) == [(0, 3)]


def test_operators_keep_every_item_once():
    r = random.Random(4)
    lengths = [r.randrange(1, 100) for _ in range(500)]
    best = K.evolve(lengths, [], 1, 100)
    for bins, free in best:
        assert sorted(i for b in bins for i in b) == list(range(500))
        assert all(sum(lengths[i] for i in b) + f == 100 and f >= 0 for b, f in zip(bins, free))
    bins, free = [], []
    K.best_fit(sorted(range(500), key=lambda i: -lengths[i]), lengths, bins, free, 100)
    assert -(-sum(lengths) // 100) <= len(best[0][0]) <= len(bins)


def test_packing_of_rows(spark):
    r = random.Random(6)
    words = "the of and to in that is was for on".split()
    rows = [(i, " ".join(r.choice(words) for _ in range(r.choice([3, 40, 900, 2500]))), 1) for i in range(60)] + [(None, None, 1), (3, "", 1), (7, "dup", 1), (7, "dup", 1)]
    out = K.pack_documents(spark.createDataFrame(rows, "doc_id long, text string, tag int")).collect()
    count, by = K.Counter(K.TOKENIZER), {}
    for x in out:
        by.setdefault(x.sequence_id, []).append(x)
    for seq in by.values():
        at = 0
        for x in sorted(seq, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert at <= K.CAPACITY
    for i, text, _ in rows[:60]:
        ids = count(text) + np.array([2], "<u4").tobytes()
        mine = sorted((x.piece, x.start, x.length, x.ids_crc32) for x in out if x.doc_id == i and x.length != 2)
        want = [(k, s, n, zlib.crc32(ids[4 * s:4 * (s + n)])) for k, (s, n) in enumerate(K.cut(len(ids) // 4))]
        assert [w for w in want if w[2] != 2 and not (i == 7 or i == 3)] == [m for m in mine if not (i == 7 or i == 3)]
    total = sum(x.length for x in out)
    assert len(by) <= -(-total // K.CAPACITY) + 2
    assert K.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
