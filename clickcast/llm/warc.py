"""A deterministic sharded WARC writer, and the reader of its archives.

Pages are numbered in the order of their ids by a distributed sort, and every ``PAGES_PER_SHARD``-th id is a boundary, so
which shard a page belongs to depends on the ids alone, not on how Spark had split the table. A shard's pages go to one
task in order of their ids and are written as gzip members, one per record, with headers and digests made anew. A file is
closed once its compressed size reaches ``ROLL_BYTES``. It is written under a temporary name that no other attempt of the
task uses and then renamed; an attempt that is repeated writes the same bytes to the same names. The manifest lists the
files with their sizes, records and digests, is written last, and is what the reader goes by.

Of pages with equal payloads of at least ``LEAST_REVISIT`` bytes, the one with the largest id is a response and the others
are revisits of it, without a payload of their own. Only ids and digests are grouped for that, never the pages.

Defined results: a null html is an empty payload; a null url has no target header; line ends and blanks in urls are
percent-encoded; a null id sorts first, is written with an empty id, and is always a response; pages that share an id and
payload with the largest id are all responses; an empty table gives an empty manifest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickcast.llm.common import numbered, written

LEAST_REVISIT = 1000
PAGES_PER_SHARD = 5000
ROLL_BYTES = 16 << 20
DATE = "2000-01-01T00:00:00Z"
URN = "urn:x-page:"
# Fixed value: the profile of a revisit by payload digest.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, shard int, bytes long, records long, first string, last string, sha1 string"


def _digest(content: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(content).digest()).decode()


def record(page_id: str, url: str | None, payload: bytes, refers_to: str | None, date: str = DATE) -> bytes:
    """One WARC record, not compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{URN}{page_id}>"),
        ("WARC-Date", date),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    headers += [("WARC-Payload-Digest", _digest(payload)), ("WARC-Block-Digest", _digest(block))]
    if refers_to is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{URN}{refers_to}>")]
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _member(content: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(content) + packer.flush()


class _Shard:
    """The files of one shard."""

    def __init__(self, folder: str, shard: int, roll: int):
        self.store, self.folder = fs.FileSystem.from_uri(folder)
        self.shard, self.roll, self.number, self.out = shard, roll, 0, None

    def add(self, page_id: str, content: bytes) -> Iterator[dict]:
        if self.out is None:
            self.name = f"shard-{self.shard:07d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.folder}/_{self.name}.{uuid.uuid4().hex}"
            self.out = self.store.open_output_stream(self.temporary)
            self.bytes, self.records, self.first, self.sha1 = 0, 0, page_id, hashlib.sha1()
        packed = _member(content)
        self.out.write(packed)
        self.sha1.update(packed)
        self.bytes, self.records, self.last = self.bytes + len(packed), self.records + 1, page_id
        if self.bytes >= self.roll:
            yield self.close()

    def close(self) -> dict:
        self.out.close()
        self.out, self.number = None, self.number + 1
        try:
            self.store.move(self.temporary, f"{self.folder}/{self.name}")
        except OSError:
            # Where a store does not replace files: another attempt has written the same bytes under this name.
            if self.store.get_file_info(f"{self.folder}/{self.name}").size != self.bytes:
                raise
            self.store.delete_file(self.temporary)
        return {
            "file": self.name, "shard": self.shard, "bytes": self.bytes, "records": self.records,
            "first": self.first, "last": self.last, "sha1": self.sha1.hexdigest(),
        }


def _write_shards(folder: str, roll: int, date: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of shard, id and kind: the references of an id come before its pages."""
    schema = pa.schema([("file", pa.string()), ("shard", pa.int32()), ("bytes", pa.int64()), ("records", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("sha1", pa.string())])

    def rows() -> Iterator[dict]:
        files, at, references = None, None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                if files is None or files.shard != row["shard"]:
                    if files is not None and files.out is not None:
                        yield files.close()
                    files = _Shard(folder, row["shard"], roll)
                if row["id"] != at:
                    at, references = row["id"], {}
                if row["target"] is not None:
                    references[row["digest"]] = row["target"]
                    continue
                payload = (row["html"] or "").encode("utf-8", "surrogatepass")
                refers_to = references.get(hashlib.sha1(payload).hexdigest()) if references else None
                page_id = row["id"] or ""
                yield from files.add(page_id, record(page_id, row["url"], payload, refers_to, date))
        if files is not None and files.out is not None:
            yield files.close()

    for row in rows():
        yield pa.RecordBatch.from_pylist([row], schema)


def write_archives(
    pages: DataFrame, folder: str, *, id_col="page_id", url_col="url", html_col="html",
    least_revisit=LEAST_REVISIT, pages_per_shard=PAGES_PER_SHARD, roll_bytes=ROLL_BYTES, date=DATE,
) -> DataFrame:
    """Write the pages as archives into ``folder`` (empty or new, in a store that all executors reach) and return the manifest."""
    spark = pages.sparkSession
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path)
    html = F.coalesce(F.col(html_col), F.lit(""))
    known = written(
        pages.select(F.col(id_col).alias("id"), F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).alias("size")), "warc-ids"
    )
    alike = known.filter((F.col("size") >= least_revisit) & F.col("id").isNotNull())
    targets = alike.groupBy("digest").agg(F.max("id").alias("target"), F.min("id").alias("least")).filter("least < target")
    targets = written(targets.select("digest", "target"), "warc-targets")
    references = alike.join(targets, "digest").filter("id < target").select("id", "digest", "target").distinct()

    order = numbered(known.select("id"), [F.col("id").asc_nulls_first()], "number")
    starts = order.filter((F.col("number") % pages_per_shard == 0) & F.col("id").isNotNull()).select("id").distinct()
    # One id per shard.
    bounds = spark.sparkContext.broadcast(sorted(r["id"] for r in starts.collect()))

    def shard_of(ids: pd.Series) -> pd.Series:
        return ids.map(lambda i: bisect_right(bounds.value, i), na_action="ignore").fillna(0).astype("int32")

    text = F.lit(None).cast("string")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), text.alias("digest"), text.alias("target"), F.lit(1).alias("kind"))
    rows = rows.union(references.select("id", text, text, "digest", F.col("target").cast("string"), F.lit(0)))
    if dict(rows.dtypes)["id"] == "bigint":
        # Whole numbers stay exact where pandas has no nulls in them.
        shard = F.coalesce(F.pandas_udf(shard_of, "int")(F.coalesce("id", F.lit(-(2**63)))), F.lit(0))
    else:
        shard = F.pandas_udf(shard_of, "int")("id")
    # By range, not by hash: as many ranges as shards, so that shards do not meet by chance.
    rows = rows.withColumn("shard", shard).repartitionByRange(len(bounds.value) + 1, "shard")
    rows = rows.sortWithinPartitions("shard", F.col("id").asc_nulls_first(), "kind", "digest")
    rows = rows.select(F.col("id").cast("string").alias("id"), "url", "html", "digest", "target", "shard")
    manifest = rows.mapInArrow(lambda batches: _write_shards(folder, roll_bytes, date, batches), MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def parse(archive: bytes) -> Iterator[tuple[dict, bytes]]:
    """The headers and block of every record of a gzipped archive."""
    with gzip.GzipFile(fileobj=io.BytesIO(archive)) as stream:
        while (line := stream.readline()) != b"":
            if line != b"WARC/1.1\r\n":
                raise ValueError(f"no WARC record begins with {line[:20]!r}")
            headers = {}
            while (line := stream.readline()) != b"\r\n":
                name, _, value = line.decode().rstrip("\r\n").partition(": ")
                headers[name] = value
            block = stream.read(int(headers["Content-Length"]))
            if _digest(block) != headers["WARC-Block-Digest"] or stream.read(4) != b"\r\n\r\n":
                raise ValueError(f"record {headers['WARC-Record-ID']} is damaged")
            yield headers, block


def _page(urn: str | None) -> str | None:
    return urn.removeprefix(f"<{URN}").removesuffix(">") or None if urn else None


def _read_archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"]
    schema = pa.schema([(n, pa.int64() if n == "payload_bytes" else pa.string()) for n in names])
    for batch in batches:
        for i in range(batch.num_rows):
            made = []
            for headers, block in parse(batch.column(0)[i].as_py()):
                http, _, payload = block.partition(b"\r\n\r\n")
                length = int(http.rpartition(b"Content-Length: ")[2])
                digest = headers["WARC-Payload-Digest"]
                whole = headers["WARC-Type"] == "response"
                if whole and (_digest(payload) != digest or len(payload) != length):
                    raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
                made.append((
                    _page(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), length,
                    base64.b32decode(digest.removeprefix("sha1:")).hex(), headers["WARC-Type"], _page(headers.get("WARC-Refers-To")),
                    payload.decode("utf-8", "surrogatepass") if whole else None,
                ))
                if len(made) == 256:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, m)) for m in made], schema)
                    made = []
            yield pa.RecordBatch.from_pylist([dict(zip(names, m)) for m in made], schema)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record in the files that the manifest lists; ``html`` is null for revisits.

    Files are read whole, one at a time, so their size (see ``ROLL_BYTES``) bounds the memory.
    """
    listed = spark.read.parquet(f"{folder}/manifest").select(F.col("file").alias("listed"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    files = files.join(listed, F.element_at(F.split("path", "/"), -1) == F.col("listed"), "left_semi")
    schema = "id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, html string"
    return files.select("content").mapInArrow(_read_archives, schema)
