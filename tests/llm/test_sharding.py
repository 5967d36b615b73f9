import math
import struct
import zlib
from collections import Counter

import pytest
import xxhash

from tabrail.llm import sharding as S
from tabrail.llm.common import table

SF = "/root/testdata/sf0.01"


class Long(int):
    """A key column's value; node numbers are ints."""


def unit(*values):
    """The hash draw of sharding.py, by the xxhash library."""
    h = 42
    for v in values:
        if v is not None:
            data = v.encode() if isinstance(v, str) else struct.pack("<q" if isinstance(v, Long) else "<i", v)
            h = xxhash.xxh64_intdigest(data, seed=h)
    return ((h >> 11) + 0.5) * 2.0 ** -53


def plain(key, tree):
    key = None if key is None else Long(key)

    def draw(children, level, *path):
        return min((-math.log(unit(key, level, *path, i)) / w, i) for i, w in children)[1]

    r = draw([(i, tree.weight(i)) for i in range(len(tree.regions))], "region")
    k = draw([(i, tree.weight(r, i)) for i in range(len(tree.regions[r]))], "rack", r)
    return draw(list(tree.regions[r][k]), "shard", r, k)


def test_query_against_plain_descent(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = S.op2_weighted_hash_tree(spark, SF).collect()
    assert len(rows) == len(docs)
    old, new = S.Tree.grid(40), S.Tree.grid(41)
    slots = Counter()
    for r in rows:
        data = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 16, zlib.crc32(data), "key")
        assert (r.shard, r.grown_shard) == (plain(r.doc_id, old), plain(r.doc_id, new))
        # One more shard takes rows only into itself.
        assert r.grown_shard in (r.shard, 40)
        slots[r.shard] += 1
    assert set(slots) == set(range(40)) and any(r.grown_shard == 40 for r in rows)
    for s, n in slots.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))


def test_a_changed_weight_moves_rows_of_its_subtree_only(spark):
    tree = S.Tree(((((0, 1.0), (1, 3.0)), ((2, 1.0),)), (((3, 2.0), (4, 1.0)),)))
    heavy = S.Tree(((((0, 1.0), (1, 3.0)), ((2, 1.0),)), (((3, 2.0), (4, 4.0)),)))
    keys = spark.range(20_000).withColumnRenamed("id", "k")
    rows = S.place(S.place(keys, tree, "k", "a"), heavy, "k", "b").collect()
    region = {0: 0, 1: 0, 2: 0, 3: 1, 4: 1}
    for r in rows:
        if r.a != r.b:
            # Shard 4 and with it region 1 grew: rows come into region 1, and inside it into shard 4.
            assert region[r.b] == 1 and (region[r.a] == 0 or r.b == 4)
    share = Counter(r.a for r in rows)
    for shard, want in ((0, 5 / 8 * 4 / 5 * 1 / 4), (1, 5 / 8 * 4 / 5 * 3 / 4), (2, 5 / 8 * 1 / 5), (3, 3 / 8 * 2 / 3), (4, 3 / 8 * 1 / 3)):
        assert share[shard] / 20_000 == pytest.approx(want, abs=0.015)
    for r in rows[:300]:
        assert (r.a, r.b) == (plain(r.k, tree), plain(r.k, heavy))


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "SLOT_BLOCK", 4)
    rows = [(None, None, 1), (None, "x", 1), (7, "é" * 3, 1), (7, "é" * 3, 1), (8, "", 1)] + [(9, "same", 0)] * 40 + [(10, "y" * 3_000_000, 2)]
    out = S.shard_documents(spark.createDataFrame(rows, "doc_id long, text string, shard int").repartition(3)).collect()
    assert out[0].asDict().keys() == {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"} and len(out) == len(rows)
    by_key = {}
    for r in out:
        by_key.setdefault(r.doc_id, set()).add(r.shard)
        assert r.shard == plain(r.doc_id, S.Tree.grid(40))
    assert all(len(s) == 1 for s in by_key.values())
    assert sorted(r.size for r in out if r.doc_id is None) == [16, 17] and {r.size for r in out if r.doc_id == 7} == {22}
    for shard in {r.shard for r in out}:
        own = sorted(r.slot for r in out if r.shard == shard)
        assert own == list(range(len(own)))
    assert S.shard_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_python_in_the_plan(spark):
    plan = S.shard_documents(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
