"""WARC archives and revisit resolution.

Archives are written by the tasks, one gzip member per record, to the shared folder. Reading one back yields record headers and where
each record lies. For deduplication only headers are shuffled, by payload digest; of equal payloads the record with the smallest id
stays a response and the others become revisits that refer to it; the deduplicated archives are then written from the originals with
fresh headers: new record ids, WARC-Refers-To and the payload digest, without the payload for revisits.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cluster import own_path, settle

DATE = "1970-01-01T00:00:00Z"
SALTS = 16
HOT_SHARE = 1000  # a digest held by more than a thousandth of all records is salted; there are at most 1000 of them
ROTATE_BYTES = 64 << 20
LEVEL = 2


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri)


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(headers: list[tuple[str, str]], payload: bytes, level: int = LEVEL) -> bytes:
    """A WARC/1.1 record as one gzip member. Line ends in header values are replaced by spaces."""
    lines = "".join(f"{k}: {v.replace(chr(13), ' ').replace(chr(10), ' ')}\r\n" for k, v in headers)
    raw = f"WARC/1.1\r\n{lines}Content-Length: {len(payload)}\r\n\r\n".encode("utf-8", "surrogatepass") + payload + b"\r\n\r\n"
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def read_records(f: io.RawIOBase, chunk: int = 1 << 16) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, payload) of each record of an archive, streamed."""
    at, left = 0, b""
    while True:
        z, raw, used = zlib.decompressobj(31), [], 0
        while not z.eof:
            data = left or f.read(chunk)
            left = b""
            if not data:
                if used:
                    raise ValueError("the archive ends within a record")
                return
            raw.append(z.decompress(data))
            used += len(data) - len(z.unused_data)
        left = z.unused_data
        yield at, used, *split_record(b"".join(raw))
        at += used


def split_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    return headers, rest[: int(headers["Content-Length"])]


class Writer:
    """Archives of one task, begun anew after ROTATE_BYTES."""

    def __init__(self, folder: str) -> None:
        self.folder, self.made, self.out, self.size, self.n = folder, [], None, 0, 0

    def add(self, data: bytes) -> None:
        if self.out is None:
            disk, at = _open(f"{self.folder}/{uuid.uuid4().hex}.warc.gz")
            disk.create_dir(at.rpartition("/")[0], recursive=True)
            self.out, self.path, self.size, self.n = disk.open_output_stream(at, compression=None), at, 0, 0
        self.out.write(data)
        self.size, self.n = self.size + len(data), self.n + 1
        if self.size >= ROTATE_BYTES:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            scheme = self.folder.partition("://")[0] + "://" if "://" in self.folder else ""
            self.made.append((self.folder + "/" + self.path.rpartition("/")[2] if scheme else self.path, self.n, self.size))
            self.out = None

    def manifest(self) -> pa.RecordBatch:
        self.close()
        p, n, b = zip(*self.made) if self.made else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(p, pa.string()), pa.array(n, pa.int64()), pa.array(b, pa.int64())], ["path", "records", "bytes"])


MANIFEST = "path string, records long, bytes long"


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a response record per row under folder; returns the manifest of the archives. A task that is run again writes files of new names; only those of the manifest count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = Writer(folder)
        for batch in batches:
            for i, url, html in zip(*(batch.column(k).to_pylist() for k in range(3))):
                payload = (html or "").encode("utf-8", "surrogatepass")
                w.add(record([("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("WARC-Target-URI", url or ""), ("WARC-Payload-Digest", "sha1:" + payload_digest(payload)), ("Content-Type", "text/html"), ("Quire-Page", "" if i is None else str(i))], payload))
        yield w.manifest()

    return settle(pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string")).mapInArrow(run, MANIFEST), "warc-manifest", free=False)


HEADERS = "page_id long, url string, digest string, payload_bytes long, record_type string, record_id string, refers_to long, path string, offset long, length long"


def _spread(manifest: DataFrame) -> DataFrame:
    n = manifest.count()
    return manifest.select("path").repartition(max(1, min(n, 1 << 14)), "path")


def read_headers(manifest: DataFrame) -> DataFrame:
    """A row for each record of the archives: its headers, and where it lies. Digests and sizes of payloads that are there are computed from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                disk, at = _open(path)
                rows = []
                with disk.open_input_stream(at, compression=None) as f:
                    for offset, length, h, payload in read_records(f):
                        kind = h["WARC-Type"]
                        here = kind == "response"
                        digest = payload_digest(payload) if here else h["WARC-Payload-Digest"].partition(":")[2]
                        rows.append((int(h["Quire-Page"]) if h["Quire-Page"] else None, h["WARC-Target-URI"], digest, len(payload) if here else int(h["Quire-Payload-Length"]), kind, h["WARC-Record-ID"], int(h["Quire-Refers-To-Page"]) if h.get("Quire-Refers-To-Page") else None, path, offset, length))
                        if len(rows) == 10_000:
                            yield _rows(rows)
                            rows = []
                if rows:
                    yield _rows(rows)

    return _spread(manifest).mapInArrow(run, HEADERS)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    names = [x.split(" ") for x in HEADERS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), names)], [n for n, _ in names])


def resolve(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """headers with `original` (null for responses): the header struct that a revisit refers to.

    Of records with equal payloads of at least min_bytes bytes the one with the smallest page_id (nulls last; repeated ids by place)
    is the original. Only narrow headers are shuffled; hot digests, at most 1000, are salted.
    """
    h = headers.withColumn("me", F.struct(F.col("page_id").isNull().alias("none"), "page_id", "path", "offset", "record_id"))
    firsts = settle(h.where(F.col("payload_bytes") >= min_bytes).groupBy("digest").agg(F.min("me").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "warc-firsts", free=False)
    total = headers.count()
    hot = [r[0] for r in firsts.where(F.col("n") * HOT_SHARE > total).select("digest").collect()] if total > 100_000 else []
    is_hot = F.col("digest").isin(hot) if hot else F.lit(False)
    left = h.withColumn("salt", F.when(is_hot, F.pmod(F.xxhash64("path", "offset"), F.lit(SALTS)).cast("int")).otherwise(0))
    right = firsts.select("digest", "first", F.explode(F.when(is_hot, F.array(*(F.lit(i) for i in range(SALTS)))).otherwise(F.array(F.lit(0)))).alias("salt"))
    out = left.join(right, ["digest", "salt"], "left")
    revisit = F.col("first").isNotNull() & (F.col("payload_bytes") >= min_bytes) & ~F.col("first").eqNullSafe(F.col("me"))
    return out.withColumn("original", F.when(revisit, F.col("first"))).drop("first", "me", "salt")


def fresh_id(old: str) -> str:
    """The id of a record's copy in the deduplicated archives, which revisits refer to."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, old)}>"


def write_deduplicated(resolved: DataFrame, folder: str) -> DataFrame:
    """Write archives in which revisits carry no payload; returns their manifest. Each task reads the archives of its rows front to back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, name, f = Writer(folder), None, None
        for batch in batches:
            for r in batch.to_pylist():
                common = [("WARC-Date", DATE), ("WARC-Target-URI", r["url"]), ("WARC-Payload-Digest", "sha1:" + r["digest"]), ("Quire-Page", "" if r["page_id"] is None else str(r["page_id"]))]
                fresh = ("WARC-Record-ID", fresh_id(r["record_id"]))
                if r["original"] is not None:
                    o = r["original"]
                    w.add(record([("WARC-Type", "revisit"), fresh, *common, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", fresh_id(o["record_id"])), ("Quire-Refers-To-Page", "" if o["page_id"] is None else str(o["page_id"])), ("Quire-Payload-Length", str(r["payload_bytes"]))], b""))
                    continue
                if r["path"] != name:
                    if f is not None:
                        f.close()
                    disk, at = _open(r["path"])
                    name, f = r["path"], disk.open_input_file(at)
                f.seek(r["offset"])
                _, payload = split_record(zlib.decompress(f.read(r["length"]), 31))
                w.add(record([("WARC-Type", "response"), fresh, *common, ("Content-Type", "text/html")], payload))
        if f is not None:
            f.close()
        yield w.manifest()

    files = resolved.repartition("path").sortWithinPartitions("path", "offset")
    return settle(files.select("page_id", "url", "digest", "payload_bytes", "path", "offset", "length", "original", "record_id").mapInArrow(run, MANIFEST), "warc-manifest", free=False)


def deduplicate(pages: DataFrame, folder: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Archives of pages under folder/all, deduplicated ones under folder/kept, and the headers of the latter, read back.

    Null payloads are empty ones; an empty payload counts like any other (min_bytes 0); null urls are empty; null and repeated ids are
    allowed (see `resolve`); an empty table makes no archive and gives no rows; other columns are ignored.
    """
    headers = settle(read_headers(write_archives(pages, folder + "/all", id_col, url_col, html_col)), "warc-headers")
    return read_headers(write_deduplicated(resolve(headers, min_bytes), folder + "/kept"))


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, deduplicated and read back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    out = deduplicate(pages, own_path(spark, "warc"))
    return out.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


_BITS = "CASE {} " + " ".join(f"WHEN '{x:X}' THEN '{x:04b}'" for x in range(16)) + " END"
_B32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
OP5_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, upper(sha1(html)) AS hex FROM p),
b AS (SELECT *, array_to_string(list_transform(generate_series(1, 40), lambda i: {_BITS.format("substr(hex, i, 1)")}), '') AS bits FROM d),
g AS (SELECT *, array_to_string(list_transform(generate_series(0, 31), lambda i: substr({_B32}, 1 + list_reduce(list_transform(generate_series(1, 5), lambda j: CAST(substr(bits, 5 * i + j, 1) AS INTEGER)), lambda a, c: 2 * a + c), 1)), '') AS payload_digest FROM b),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM g)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM m
"""
