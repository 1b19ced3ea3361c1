"""WARC archives compressed record by record with a Zstandard dictionary.

Each archive starts with a skippable frame that holds the dictionary, so a
file can be read on its own; every record follows as one frame. Archives go to
the shared folder: a task writes a file under a name of its own and only files
named in the manifest count, so a repeated or lost task leaves nothing wrong
behind. The manifest is written as a table before anything is read back.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framequarry.llm._shared import fresh_path, marked, materialize, slices, table

#: Payloads below this many bytes are always written in full.
REVISIT_BYTES = 100
#: Records that the dictionary is trained on, those with the smallest digests, and how many of a payload's bytes count then.
SAMPLE_RECORDS = 400
SAMPLE_BYTES = 32_768
DICT_BYTES = 65_536
LEVEL = 3
#: Parts that the rows of one payload are joined in.
SALTS = 16
#: Bytes that are read from an archive at a time.
CHUNK = 1 << 16

#: Fixed values of the formats: the skippable frame's magic number that marks a dictionary, and the profile of revisits.
DICT_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def train(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A dictionary from archived records; where they are too few or too alike to train on, their own bytes are one."""
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes() if len(samples) >= 8 else b"".join(samples)[-size:]
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def render(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record's bytes before compression: a HTTP response with the payload, or its head alone in a revisit.

    Every record has an identifier of its own. Pages are named by headers of
    our own, as ids may be null or repeat; so is a url that can't stand in a
    header as it is.
    """
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = head + payload if refers_to is None else head
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>"]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if url and url.isascii() and url.isprintable() and url == url.strip():
        lines.append(f"WARC-Target-URI: {url}")
    elif url:
        raw = url.encode("utf-8", "surrogatepass")
        lines += [f"WARC-Target-URI: {quote(raw)}", f"X-Target-URI-Base64: {base64.b64encode(raw).decode()}"]
    lines += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"X-Refers-To-Page: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def payload_of(body: bytes) -> bytes:
    """What follows the HTTP head."""
    return body.partition(b"\r\n\r\n")[2]


def target_of(headers: dict[str, str]) -> str:
    """A record's url; empty where it has none."""
    own = headers.get("X-Target-URI-Base64")
    return headers.get("WARC-Target-URI", "") if own is None else base64.b64decode(own).decode("utf-8", "surrogatepass")


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body of one record's bytes."""
    head, _, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines)
    size = int(headers["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length doesn't match its header")
    return headers, rest[:size]


class Archive:
    """Writes records to a stream."""

    def __init__(self, sink, dictionary: bytes):
        self.sink = sink
        options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, write_checksum=True, **options)
        self.written = 0
        self._put(struct.pack("<II", DICT_MAGIC, len(dictionary)) + dictionary)

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.written += len(data)

    def add(self, record: bytes) -> None:
        self._put(self.compressor.compress(record))


def records(source) -> Iterator[bytes]:
    """Decompressed records of an archive, one at a time; ``source`` has ``read(n)``."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != DICT_MAGIC:
        raise ValueError("the archive doesn't start with a dictionary frame")
    dictionary = source.read(size)
    options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    opener = zstandard.ZstdDecompressor(**options)
    data = b""
    unit = None
    parts: list[bytes] = []
    while True:
        if not data:
            data = source.read(CHUNK)
            if not data:
                break
        unit = unit or opener.decompressobj()
        parts.append(unit.decompress(data))
        data = b""
        if unit.eof:
            data = unit.unused_data
            yield b"".join(parts)
            unit, parts = None, []
    if unit is not None:
        raise ValueError("the archive ends within a record")


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` as (page_id, url, payload, digest, refers_to).

    A filter of bounded size picks out the rows whose payload has at least
    ``REVISIT_BYTES`` and occurs more than once; only those are shuffled, to be
    joined with their first pages, each payload in ``SALTS`` parts. All other
    rows stay where they are.
    A null id cannot be referred to: such rows revisit the smallest id that
    is not null, and stay responses where there is none. A row that repeats
    the smallest id's row is a response again.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    firsts = rows.where(F.length("payload") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1 and first_id is not null")
    firsts = materialize(firsts.select("digest", "first_id"), "warc-firsts")
    key = F.when(F.length("payload") >= REVISIT_BYTES, F.xxhash64("digest"))
    rows = materialize(marked(rows.withColumn("salt", key), "salt", firsts.select(F.xxhash64("digest")), "repeated"), "warc-rows")
    alone = rows.where("not repeated or salt is null").select("page_id", "url", "payload", "digest", F.lit(None).cast("long").alias("refers_to"))
    parted = rows.where("repeated and salt is not null").withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)))
    firsts = firsts.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    joined = parted.join(firsts, ["digest", "salt"], "left")
    return alone.unionByName(joined.select("page_id", "url", "payload", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to")))


def write_archives(pages: DataFrame, folder: str, **columns: str) -> DataFrame:
    """Write ``pages`` as archives in ``folder``; returns the manifest (path, records, bytes), written as a table."""
    planned = plan_records(pages, **columns)
    # a bound on the digest leaves some four times as many as wanted, so that tasks don't all send their first to the driver
    bound = min(1 << 32, (4 * SAMPLE_RECORDS << 32) // max(1, pages.count()) + 1)
    some = planned.where("refers_to is null").where(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") < bound)
    sample = some.select("page_id", "url", F.substring("payload", 1, SAMPLE_BYTES).alias("payload"), "digest").orderBy("digest", "page_id").limit(SAMPLE_RECORDS).collect()
    dictionary = train([render(x.page_id, x.url, bytes(x.payload), x.digest, None) for x in sample])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = path = sink = archive = None
        count = 0
        for batch in slices(batches):
            if sink is None:
                store, root = fs.FileSystem.from_uri(folder)
                store.create_dir(root, recursive=True)
                path = f"{root}/{uuid.uuid4().hex}.warc.zst"
                sink = store.open_output_stream(path, compression=None)
                archive = Archive(sink, dictionary)
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                archive.add(render(page_id, url, payload, digest, refers_to))
                count += 1
        if sink is not None:
            sink.close()
            name = path.rsplit("/", 1)[1]
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([count], pa.int64()), pa.array([archive.written], pa.int64())], names=["path", "records", "bytes"])

    return materialize(planned.mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")


_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def read_archives(manifest: DataFrame) -> DataFrame:
    """Every record of the manifest's archives; a response's digest and length are taken anew from its payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        names = [x.split()[0] for x in _SCHEMA.split(", ")]
        for batch in batches:
            for path, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, place = fs.FileSystem.from_uri(path)
                out, count = [], 0
                with store.open_input_stream(place, compression=None) as source:
                    for record in records(source):
                        headers, body = parse(record)
                        kind, digest, size = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:"), int(headers["X-Payload-Length"])
                        if kind == "response" and (len(payload_of(body)) != size or hashlib.sha256(payload_of(body)).hexdigest() != digest):
                            raise ValueError(f"a record in {path} doesn't match its digest")
                        page_id, refers_to = (None if x is None else int(x) for x in (headers.get("X-Page-Id"), headers.get("X-Refers-To-Page")))
                        out.append((page_id, size, digest, kind, refers_to, target_of(headers)))
                        count += 1
                        if len(out) == 1024:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                            out = []
                if count != expected:
                    raise ValueError(f"{path} has {count} records, not {expected}")
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path", "records").repartition(parts).mapInArrow(run, _SCHEMA)


def archive_pages(pages: DataFrame, **columns: str) -> DataFrame:
    """Archive ``pages`` and read the archives back: one row per page.

    A null html counts as empty, a null url reads back as the empty string,
    an empty table gives an empty result, and other columns are not read.
    """
    return read_archives(write_archives(pages, fresh_path(pages.sparkSession, "warc"), **columns))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"))


#: Rows of ``op6_warc``.
OP6_SQL = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id IS NULL OR first_id IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to,
  coalesce(url, '') AS url
FROM p LEFT JOIN f USING (payload_digest)
"""
