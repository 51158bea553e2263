import glob
import gzip
import hashlib

import pytest
from conftest import SF_SMOKE, local_path
from sluice.llm import warc as W

SCHEMA = "page_id long, url string, html string"
BIG = "<p>" + "é" * 200


def pages(spark):
    return spark.createDataFrame([
        (5, "http://www.b.example.com/x?q=1", BIG), (2, "https://a.example.com:8443/", BIG),
        (9, "http://www.b.example.com/x?q=1", BIG), (3, None, None), (4, "not a url", ""),
        (6, "http://[bad", "tiny"), (7, "http://h/\r\nX: y", "tiny"), (None, "http://h/", BIG),
        (8, "http://h/" + "p" * 3000, "z" * 300_000), (8, "http://h/", "z" * 300_000)], SCHEMA)


def test_keys():
    assert W.surt("http://www.b.example.com/x?q=1") == "com,example,b,www)/x?q=1"
    assert W.surt("https://a.example.com:8443") == "com,example,a:8443)/"
    assert W.surt("http://H:80/p#top") == "h)/p" and W.surt(None) == ""


def test_members_round_trip_and_end_in_zero():
    data = [b"abc", b"", b"x" * 100_000, b"y" * (1 << 24)]
    packed = [W.member(d) for d in data]
    assert all(p[-1] == 0 for p in packed)
    whole = b"".join(packed)
    found = list(W.members(whole))
    assert [d for _, _, d in found] == [d for d in data if d]
    for at, size, d in found:
        assert gzip.decompress(whole[at:at + size]) == d
    with pytest.raises(ValueError):
        list(W.members(whole[:-30]))


def test_archive_rows(spark, scratch):
    df, path = pages(spark).selectExpr("*", "1 AS payload", "2 AS digest", "3 AS d"), scratch("warc")
    got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest)
           for r in W.archive(df, path).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    big, n = sha(BIG), len(BIG.encode())
    assert got == {(2, "response", None, n, big), (5, "revisit", 2, n, big),
                   (9, "revisit", 2, n, big), (None, "revisit", 2, n, big),
                   (3, "response", None, 0, sha("")), (4, "response", None, 0, sha("")),
                   (6, "response", None, 4, sha("tiny")), (7, "response", None, 4, sha("tiny")),
                   (8, "response", None, 300_000, sha("z" * 300_000))}
    assert W.captures(spark, f"{path}/index").count() == 10
    # the files are plain concatenated gzip
    text = b"".join(gzip.open(f).read() for f in glob.glob(local_path(path) + "/archives/part-*"))
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == 10
    urls = spark.createDataFrame([("http://www.b.example.com/x?q=1",), ("http://h/",),
                                  ("http://none/",), (None,)], "url string")
    hits = W.lookup(spark, f"{path}/index", urls)
    assert sorted((str(r.url), str(r.page_id)) for r in hits.collect()) == [
        ("None", "3"), ("http://h/", "8"), ("http://h/", "None"),
        ("http://www.b.example.com/x?q=1", "5"), ("http://www.b.example.com/x?q=1", "9")]
    body = {r.page_id: r.payload for r in W.fetch(hits, payload=True).collect()}
    assert bytes(body[8]) == b"z" * 300_000 and body[5] is None


def test_empty_table(spark):
    assert W.archive(spark.createDataFrame([], SCHEMA)).count() == 0


def test_lookup_over_many_blocks(spark, scratch):
    df, path = spark.read.parquet(f"{SF_SMOKE}/pages.parquet"), scratch("warc")
    same = df.selectExpr("page_id + 100000", "'http://hot.example.com/'", "html")
    W.write_archives(W.roles(df.union(same)), f"{path}/archives")
    W.build_index(spark, f"{path}/archives", f"{path}/index", block=7)
    hot = spark.createDataFrame([("http://hot.example.com/",)], "url string")
    assert W.lookup(spark, f"{path}/index", hot).count() == df.count()
    want = {(r.page_id, r.url) for r in df.collect()}
    hits = {(r.page_id, r.url) for r in W.lookup(spark, f"{path}/index", df).collect()}
    assert want <= hits
    key = {r.page_id: W.surt(r.url) for r in df.collect()}
    assert all(key[p] == W.surt(u) for p, u in hits)


def test_archive_reads_through_the_directory(spark, scratch, monkeypatch):
    rows = [(1, "http://h/é", "a"), (2, "http://h:80/é", "b"), (3, "http://h/%C3%A9", "c"),
            (4, None, "d"), (5, "", "e"), (6, "http://H/a b", "f"), (7, "http://h/\r\nX: y", "g")]
    df = spark.createDataFrame(rows * 40, SCHEMA)
    monkeypatch.setattr(W.build_index, "__defaults__", (7,))  # keys that span blocks
    monkeypatch.setattr(W, "captures", None)
    path = scratch("warc")
    got = W.archive(df, path)
    assert sorted(r.page_id for r in got.collect()) == sorted(r[0] for r in rows * 40)
    hits = W.lookup(spark, f"{path}/index", spark.createDataFrame([("http://h/é",)], "url string"))
    assert {r.page_id for r in hits.collect()} == {1, 2, 3} and hits.count() == 120


def test_addresses_of_one_key_are_looked_up_once(spark, scratch):
    path = scratch("warc-keys")
    df = spark.createDataFrame([(i, f"http{'s' * (i % 2)}://H.example.com/x#{i}", f"p{i}")
                                for i in range(60)] + [(99, "http://other/", "q")], SCHEMA)
    W.write_archives(W.roles(df, "page_id", "url", "html"), f"{path}/archives")
    W.build_index(spark, f"{path}/archives", f"{path}/index")
    blocks = W._blocks_of(spark, f"{path}/index", df, "url", by_key=True)
    found = W._captures_of(blocks).collect()
    assert sorted(r.page_id for r in found) == [*range(60), 99]
    got = {r.page_id: r.payload_digest for r in W.archive(df).collect()}
    assert got[99] == hashlib.sha256(b"q").hexdigest() and len(got) == 61
