"""WARC archives with a two-level capture index.

Writing: one gzip member per record, so every record can be read by a byte range. Archive
bytes go out through Spark's own text writer (any store Spark writes to, with its commit
protocol): a gzip member of less than 16 MiB ends in a zero byte (the high byte of its length),
so each row holds the member without that byte and the line separator is the zero byte.

Index: captures sorted by reversed-host URL key into compressed blocks of ``BLOCK`` lines
(level two, gzip members in files of their own), and a sparse directory with the first and last
key and the byte range of each block (level one), stored by shard of the key range. A lookup
binary-searches the shards' bounds, the shard's directory and the block, and reads only byte
ranges: one for the block, one for the record.
"""

from __future__ import annotations

import bisect
import functools
import gzip
import hashlib
import json
import re
import zlib
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.dataset
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import cut
from sluice.session import scratch_path

MIN_REVISIT = 100
BLOCK = 512
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
PLACE = "file string, offset long, length long"
RECORD = ("page_id long, record_type string, refers_to long, payload_bytes long, "
          "payload_digest string")


def surt(url: str | None) -> str:
    """Reversed-host key: ``http://a.example.com/p?q`` becomes ``com,example,a)/p?q``."""
    if not url:
        return ""
    try:
        parts = urlsplit(url if "//" in url else "//" + url)
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return url
    key = ",".join(reversed(host.split(".")))
    if port and (parts.scheme, port) not in {("http", 80), ("https", 443)}:
        key += f":{port}"
    return f"{key}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def roles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", min_bytes: int = MIN_REVISIT) -> DataFrame:
    """``page_id, url, payload, digest, refers_to`` for every row.

    Digests are counted without the payloads; only pages with a partner are looked up.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    first = (rows.filter(F.octet_length("payload") >= min_bytes)
             .groupBy(F.col("digest").alias("d")).agg(F.min("page_id").alias("first"),
                                                      F.count(F.lit(1)).alias("n"))
             .filter("n > 1").drop("n"))
    first = cut(first, "warc-first")
    out = rows.join(first, F.col("digest") == F.col("d"), "left")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return out.select("page_id", "url", "payload", "digest",
                      F.when(other, F.col("first")).alias("refers_to"))


def _record_id(page_id) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def _page_of(uri: str | None) -> int | None:
    m = re.fullmatch(r"<urn:x-page:(-?\d+)>", uri or "")
    return int(m[1]) if m else None


def target(url: str) -> str:
    """An address as records hold it."""
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~")


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record; a revisit holds the response's header only."""
    block = HTTP.format(len(payload)).encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + target(url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    else:
        block += payload
    head += [f"WARC-Payload-Digest: sha256:{digest}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member that ends in a zero byte (a longer one is followed by an empty member)."""
    packed = gzip.compress(data, level, mtime=0)
    return packed if packed[-1] == 0 else packed + gzip.compress(b"", mtime=0)


def write_members(rows: DataFrame, path: str) -> None:
    """Writes ``value`` (gzip members without their last byte, which is zero) one after the
    other, one file per partition."""
    rows.select(F.col("value").cast("string").alias("value")) \
        .write.option("lineSep", "\u0000").text(path)


def write_archives(rows: DataFrame, path: str, level: int = 6) -> None:
    """Rows of ``roles`` as archives of gzip records below ``path``, one file per partition."""

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 200):
                columns = [c.to_pylist() for c in b.slice(i, 200).columns]
                out = [member(record(*r), level)[:-1] for r in zip(*columns)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    write_members(rows.select("page_id", "url", "payload", "digest", "refers_to")
                  .mapInArrow(run, "value binary"), path)


def parse(data: bytes) -> dict:
    """Header fields, HTTP length and payload of one uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('warc-record-id')} is cut off")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    declared = int(re.search(rb"(?im)^Content-Length: (\d+)", http)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    refers = _page_of(fields.get("warc-refers-to"))
    if fields["warc-type"] == "response":
        if len(payload) != declared or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"record {fields['warc-record-id']}: payload does not match digest")
    return {"page_id": _page_of(fields["warc-record-id"]), "url": fields.get("warc-target-uri"),
            "record_type": fields["warc-type"], "refers_to": refers, "payload_bytes": declared,
            "payload_digest": digest, "payload": payload}


def members(content: bytes):
    """``(offset, length, bytes)`` of the non-empty gzip members of a file."""
    view, at = memoryview(content), 0
    while at < len(view):
        begin, out, unzip = at, [], zlib.decompressobj(31)
        while not unzip.eof:
            chunk = view[at:at + (1 << 15)]
            if not len(chunk):
                raise ValueError("the last member is cut off")
            out.append(unzip.decompress(chunk))
            at += len(chunk)
        at -= len(unzip.unused_data)
        if data := b"".join(out):
            yield begin, at - begin, data


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path) \
        .select("path", "content")


def _emit(rows: list[dict], names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names)


def scan(spark: SparkSession, archives: str) -> DataFrame:
    """One row per record of the archives: key, page and byte range."""
    names = ["surt", "page_id", "file", "offset", "length"]
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def run(batches):
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows = []
                for at, length, data in members(content):
                    r = parse(data)
                    rows.append({"surt": surt(r["url"]), "page_id": r["page_id"], "file": path,
                                 "offset": at, "length": length})
                if rows:
                    yield _emit(rows, names, types)

    return _files(spark, archives).mapInArrow(run, f"surt string, page_id long, {PLACE}")


def build_index(spark: SparkSession, archives: str, path: str, block: int = BLOCK) -> None:
    """Sorted compressed blocks below ``path/blocks`` and their directory by shard below
    ``path/directory``. Keys are dealt by range of (key, page, place), so a host or an address
    that holds many captures is spread over shards."""
    captures = cut(scan(spark, archives), "warc-captures")
    captures = captures.repartitionByRange("surt", "page_id", "file", "offset") \
        .sortWithinPartitions("surt", "page_id", "file", "offset")

    def pack(batches):
        lines: list[str] = []
        for b in batches:
            for key, *rest in zip(*(c.to_pylist() for c in b.columns)):
                lines.append(json.dumps([key, *rest]))
                if len(lines) == block:
                    yield _value(lines)
                    lines = []
        if lines:
            yield _value(lines)

    write_members(captures.mapInArrow(pack, "value binary"), f"{path}/blocks")

    def directory(batches):
        names = ["shard", "first_key", "last_key", "file", "offset", "length"]
        types = [pa.string()] * 4 + [pa.int64()] * 2
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                shard = re.search(r"part-(\d+)", name)[1]
                rows = []
                for at, length, data in members(content):
                    lines = data.decode().split("\n")
                    rows.append({"shard": shard, "first_key": json.loads(lines[0])[0],
                                 "last_key": json.loads(lines[-1])[0], "file": name,
                                 "offset": at, "length": length})
                if rows:
                    yield _emit(rows, names, types)

    _files(spark, f"{path}/blocks").mapInArrow(
        directory, f"shard string, first_key string, last_key string, {PLACE}") \
        .sortWithinPartitions("first_key", "offset") \
        .write.partitionBy("shard").parquet(f"{path}/directory")


def _value(lines: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([member("\n".join(lines).encode())[:-1]], pa.binary())], ["value"])


def _store(uri: str):
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


@functools.lru_cache(maxsize=16)
def _opened(uri: str):
    fs, path = _store(uri)
    return fs.open_input_file(path)


def read_range(uri: str, offset: int, length: int) -> bytes:
    """The uncompressed bytes of the member at a byte range."""
    f = _opened(uri)
    f.seek(offset)
    return gzip.decompress(f.read(length))


def captures(spark: SparkSession, index: str) -> DataFrame:
    """All captures of an index, decoded from its blocks."""
    names = ["surt", "page_id", "file", "offset", "length"]
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def run(batches):
        for b in batches:
            for content in b.column(1).to_pylist():
                for _, _, data in members(content):
                    rows = [dict(zip(names, json.loads(x))) for x in data.decode().split("\n")]
                    yield _emit(rows, names, types)

    return _files(spark, f"{index}/blocks").mapInArrow(run, f"surt string, page_id long, {PLACE}")


def fetch(rows: DataFrame, payload: bool = False) -> DataFrame:
    """The records at ``file, offset, length``, read by byte range and verified; ``payload``
    adds their payloads (null for revisits). Rows are dealt by stretch of file."""
    keys = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    if payload:
        keys, types = [*keys, "payload"], [*types, pa.binary()]

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 500):
                places = zip(*(c.to_pylist() for c in b.slice(i, 500).columns))
                out = [parse(read_range(*p)) for p in places]
                for r in out:
                    r["payload"] = r["payload"] if r["record_type"] == "response" else None
                yield _emit(out, keys, types)
        _opened.cache_clear()

    at = rows.select("file", "offset", "length") \
        .repartition(F.col("file"), F.floor(F.col("offset") / (1 << 22))) \
        .sortWithinPartitions("file", "offset")
    return at.mapInArrow(run, RECORD + (", payload binary" if payload else ""))


def lookup(spark: SparkSession, index: str, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """``url, page_id, file, offset, length`` of all captures of the given addresses.

    The bounds of the shards (as many as index files) go to every task; a task searches the
    directory of the shards its keys fall in. The blocks found are then dealt out, so each is
    read once, by its byte range, and searched for all keys that hit it.
    """
    return _captures_of(_blocks_of(spark, index, urls, url_col))


def _blocks_of(spark: SparkSession, index: str, urls: DataFrame, url_col: str,
               by_key: bool = False) -> DataFrame:
    """``url, surt, file, offset, length``: the blocks whose keys enclose an address's key. With
    ``by_key`` the addresses of one key are looked up once, ``url`` being the key."""
    shards = sorted((r["a"], r["b"], r["shard"]) for r in spark.read.schema(
        "shard string, first_key string, last_key string").parquet(f"{index}/directory")
        .groupBy("shard").agg(F.min("first_key").alias("a"), F.max("last_key").alias("b"))
        .collect())
    top = [s[1] for s in shards]

    def place(batches):
        for b in batches:
            rows = []
            for url in b.column(0).to_pylist():
                key = surt(url and target(url))  # as in the index
                for a, _, shard in shards[bisect.bisect_left(top, key):]:
                    if a > key:
                        break
                    rows.append({"url": url, "surt": key, "shard": shard})
            if rows:
                yield _emit(rows, ["url", "surt", "shard"], [pa.string()] * 3)

    def search(batches):
        names = ["url", "surt", "file", "offset", "length"]
        types = [pa.string()] * 3 + [pa.int64()] * 2
        held: tuple[str, list] = ("", [])
        for b in batches:
            rows = []
            for url, key, shard in zip(*(c.to_pylist() for c in b.columns)):
                if held[0] != shard:
                    fs, path = _store(f"{index}/directory/shard={shard}")
                    held = shard, sorted(pa.dataset.dataset(path, filesystem=fs, format="parquet")
                                         .to_table().to_pylist(),
                                         key=lambda r: (r["first_key"], r["last_key"], r["offset"]))
                blocks = held[1]
                at = bisect.bisect_left(blocks, key, key=lambda r: r["last_key"])
                while at < len(blocks) and blocks[at]["first_key"] <= key:
                    rows.append({**blocks[at], "url": url, "surt": key})
                    at += 1
                if len(rows) >= 4096:
                    yield _emit(rows, names, types)
                    rows = []
            if rows:
                yield _emit(rows, names, types)

    keys = urls.select(F.col(url_col).cast("string").alias("url")).distinct() \
        .mapInArrow(place, "url string, surt string, shard string")
    if by_key:
        keys = keys.select(F.col("surt").alias("url"), "surt", "shard").distinct()
    return keys.repartition(F.col("shard"), F.pmod(F.xxhash64("surt"), F.lit(8))) \
        .sortWithinPartitions("shard", "surt") \
        .mapInArrow(search, f"url string, surt string, {PLACE}")


def _captures_of(blocks: DataFrame) -> DataFrame:
    """The lines of each key in its blocks."""
    names = ["url", "page_id", "file", "offset", "length"]
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def run(batches):
        held: tuple[tuple, list] = ((), [])
        for b in batches:
            rows = []
            for url, key, *place in zip(*(c.to_pylist() for c in b.columns)):
                if held[0] != tuple(place):
                    held = tuple(place), [json.loads(v) for v in
                                          read_range(*place).decode().split("\n")]
                lines = held[1]
                i = bisect.bisect_left(lines, key, key=lambda v: v[0])
                while i < len(lines) and lines[i][0] == key:
                    rows.append(dict(zip(names, [url, *lines[i][1:]])))
                    i += 1
                if len(rows) >= 4096:
                    yield _emit(rows, names, types)
                    rows = []
            if rows:
                yield _emit(rows, names, types)
        _opened.cache_clear()

    return blocks.repartition("file", "offset").sortWithinPartitions("file", "offset", "surt") \
        .mapInArrow(run, f"url string, page_id long, {PLACE}")


def archive(pages: DataFrame, path: str | None = None, id_col: str = "page_id",
            url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes archives and index below ``path`` (default: a fresh shared folder) and returns
    ``page_id, record_type, refers_to, payload_bytes, payload_digest``: the addresses of all
    pages are looked up in the index, and the records found are read by byte range. Archive files are plain concatenated gzip records (named ``part-*`` by Spark).

    One record per row. Of equal payloads of at least ``MIN_REVISIT`` bytes the one with the
    smallest id is the response, the others revisit it (rows that share the smallest id are
    all responses; a null id never is one unless all are null). A null html is an empty
    payload, a null address leaves the target out and gets the empty key; an empty table
    gives an empty result; other columns are not read.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(roles(pages, id_col, url_col, html_col), f"{path}/archives")
    build_index(spark, f"{path}/archives", f"{path}/index")
    # addresses of one key find the same captures: each key is looked up once
    found = _captures_of(_blocks_of(spark, f"{path}/index", pages, url_col, by_key=True)) \
        .select("file", "offset", "length")
    return fetch(found).withColumnRenamed("page_id", id_col)
