"""Archives: exact round trips, responses and revisits, damaged payloads."""

import hashlib
import re

import pytest

from tabrail.llm import warc as W
from tabrail.llm.common import table

SCHEMA = "page_id long, url string, html string, key string"


def plain(rows):
    """page_id, bytes, sha1, type, refers_to as the contract states them."""
    last = {}
    for page, _, html, *_ in rows:
        last[html or ""] = max(last.get(html or "", -1), page)
    out = []
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        other = last[html or ""] if len(data) >= 1000 and last[html or ""] != page else None
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "response" if other is None else "revisit", other))
    return sorted(out)


@pytest.fixture(scope="module")
def pages():
    long = "<p>löng &amp; \r\n\r\n WARC/1.1\r\n</p>" * 60
    rows = [(i, f"http://a.b/{i}", long, "k") for i in range(40)]
    rows += [(100 + i, f"http://c.d/ {i}\r\nX-Page-ID: 9", "small", "k") for i in range(5)]
    rows += [(200, None, None, None), (201, "u", "", None), (202, "u", "x" * 999, None), (203, "u", "x" * 999, None),
             (204, "u", "y" * 1000, None), (205, "u", "y" * 1000, None), (206, "u", "é" * 500, None), (207, "u", "é" * 500, None),
             (300, "u", "<b>" + "z" * 3_000_000, None)]
    return rows


def test_query_is_the_contract(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, sf, "pages").select("page_id", "url", "html").collect()]
    assert sorted(tuple(r) for r in W.op12_content_archive(spark, sf).collect()) == plain(rows)


def test_round_trip(spark, pages, tmp_path):
    root = W.write_archive(spark.createDataFrame(pages, SCHEMA).repartition(5), str(tmp_path / "a"))
    got = W.read_pages(spark, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(tuple(r) for r in got) == plain(pages)
    # Every payload is stored once.
    assert spark.read.parquet(f"{root}/payloads").count() == len({p[2] or "" for p in pages})

    records = {bytes(r.record) for r in W.read_records(spark, root).collect()}
    assert len(records) == len(pages)
    by_id = {}
    for r in records:
        head, block = r.split(b"\r\n\r\n", 1)
        assert head.startswith(b"WARC/1.1\r\n")
        assert int(re.search(rb"\r\nContent-Length: (\d+)", head)[1]) == len(block)
        by_id[int(re.search(rb"\r\nX-Page-ID: (\d+)", head)[1])] = block.split(b"\r\n\r\n", 1)[1]
    kinds = {r.page_id: r.record_type for r in got}
    for page, _, html, _ in pages:
        assert by_id[page] == ((html or "").encode() if kinds[page] == "response" else b"")

    for how in ("gzip", "none"):
        out = W.export_warc(spark, root, str(tmp_path / how), records_per_file=7, compression=how)
        assert {bytes(r.record) for r in W.import_warc(spark, out).collect()} == records
    parsed = {r.page_id: r for r in W.parse_records(W.import_warc(spark, str(tmp_path / "gzip"))).collect()}
    assert parsed[100].url == "http://c.d/%200%0D%0AX-Page-ID:%209" and parsed[200].url is None
    assert parsed[0].record_type == "revisit" and parsed[0].refers_uri == parsed[39].record_id


def test_members_of_gzip_files():
    import gzip

    one = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc"
    two = b"WARC/1.1\r\ncontent-length: 0\r\n\r\n"
    assert list(W.split_warc(gzip.compress(one + b"\r\n\r\n") + gzip.compress(two + b"\r\n\r\n"))) == [one, two]
    with pytest.raises(ValueError):
        list(W.split_warc(one[:-1]))


def test_odd_ids(spark, tmp_path):
    same = "s" * 2000
    rows = [(None, "b", same, ""), (None, "a", same, ""), (5, "a", same, ""), (5, "a", same, ""), (3, "a", same, "")]
    root = W.write_archive(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "a"))
    got = W.read_pages(spark, root).collect()
    assert len(got) == 5 and [r.page_id for r in got if r.record_type == "response"] == [5]
    assert all(r.refers_to == 5 and r.payload_bytes == 2000 for r in got if r.record_type == "revisit")
    root = W.write_archive(spark.createDataFrame(rows[:2], SCHEMA), str(tmp_path / "n"))
    assert {(r.record_type, r.refers_to, r.payload_bytes) for r in W.read_pages(spark, root).collect()} == {("response", None, 2000), ("revisit", None, 2000)}


def test_empty_table(spark, tmp_path):
    root = W.write_archive(spark.createDataFrame([], SCHEMA), str(tmp_path / "a"))
    assert W.read_pages(spark, root).count() == 0


def test_damage_is_found(spark, pages, tmp_path):
    root = W.write_archive(spark.createDataFrame(pages, SCHEMA), str(tmp_path / "a"))
    stored = spark.read.parquet(f"{root}/payloads").collect()
    bad = [(r.key, r.length, bytes(r.payload[:-1]) + b"!" if r.length == 999 else bytes(r.payload)) for r in stored]
    spark.createDataFrame(bad, "key string, length long, payload binary").write.mode("overwrite").parquet(f"{root}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        W.read_records(spark, root).collect()
