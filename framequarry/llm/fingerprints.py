"""Document fingerprints: a sketch that keeps every shingle hash below a fixed fraction of the hash range.

A text's shingles are its distinct runs of ``WIDTH`` UTF-8 bytes (the whole
text where it is shorter). A sketch keeps the hashes below ``FRACTION`` of the
range, whatever the text's length, and nothing else. So the sketch of two
texts taken together is the merged sketch of theirs, and the share of one
sketch's hashes that another has estimates how much of the one text is in the
other, however unequal they are. A text of few shingles may have an empty
sketch; its fingerprint still names the text, by a digest of its own, and
likeness to it is then that of the digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framequarry.llm._shared import U, mix, odd_multipliers, slices, table

WIDTH = 12
FRACTION = 1 / 16


def shingle_hashes(data: bytes, width: int = WIDTH) -> np.ndarray:
    """64-bit hashes of all runs of ``width`` bytes, in text order."""
    if not data:
        return np.empty(0, U)
    raw = np.frombuffer(data, np.uint8)
    size = min(width, len(raw))
    count = len(raw) - size + 1
    total = np.zeros(count, U)
    weights = odd_multipliers(size, 99 + size)
    # eight bytes at a time: a run is read as little-endian words at fixed offsets
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    for k in range(0, size, 4):
        word = padded[k : k + count].astype(U)
        for j in range(1, min(4, size - k)):
            word |= padded[k + j : k + j + count].astype(U) << U(8 * j)
        total += (word + U(1)) * weights[k]
        total ^= total >> U(29)
    return mix(total)


def sketch(hashes: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """Sorted kept hashes of a text's shingle hashes, their leading 32 bits."""
    return np.unique((hashes[hashes < U(int(fraction * 2**64))] >> U(32)).astype(np.uint32))


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of two documents taken together, from their sketches alone."""
    return np.union1d(a, b)


def compare(a: np.ndarray, b: np.ndarray) -> tuple[float, float, float]:
    """(resemblance, containment of a in b, containment of b in a), each from 0 to 1; all 0 where a side is empty."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / max(1, len(a) + len(b) - shared), shared / max(1, len(a)), shared / max(1, len(b))


class Fingerprint:
    """A text's sketch, and a digest of its shingles that stands for it where a sketch is empty."""

    def __init__(self, data: bytes):
        hashes = shingle_hashes(data)
        self.sketch = sketch(hashes)
        self.digest = hashlib.sha256(data).hexdigest()[:16]

    def __str__(self) -> str:
        """The digest, and the sketch as big-endian hex, 8 digits a hash, in rising order."""
        return f"{self.digest}:{self.sketch.astype('>u4').tobytes().hex()}"

    def likeness(self, other: Fingerprint) -> tuple[float, float, float]:
        """As ``compare``; equal texts are alike in full, also where their sketches are empty."""
        return (1.0, 1.0, 1.0) if self.digest == other.digest else compare(self.sketch, other.sketch)


def decode(text: str) -> np.ndarray:
    """The sketch of a fingerprint's text."""
    return np.frombuffer(bytes.fromhex(text.partition(":")[2]), ">u4").astype(np.uint32)


_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, kept_in_edited double, kept_in_next double"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted; a row's next row in the same bucket is its next document."""
    held = None  # bucket, whether it is an extra row, id, text, sketch
    out: list[tuple] = []

    def full() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 4]
        names = [x.split()[0] for x in _SCHEMA.split(", ")]
        out_batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)
        out.clear()
        return out_batch

    for batch in slices(batches):
        for bucket, extra, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            kept = Fingerprint(text.encode("utf-8", "surrogatepass"))
            if held and held[0] == bucket and not held[1]:
                own_id, own, own_kept = held[2:]
                half = len(own) // 2
                edited = (own[: len(own) - half] + text[:half]).encode("utf-8", "surrogatepass")
                changed = Fingerprint(edited)
                to_edited, to_next = own_kept.likeness(changed), own_kept.likeness(kept)
                out.append((own_id, len(own), hashlib.sha256(edited).hexdigest(), str(own_kept), str(changed), to_edited[0], to_next[0], to_edited[1], to_next[1]))
                if len(out) >= 256:
                    yield full()
            held = (bucket, extra, doc, text, kept)
    if out:
        yield full()


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness (resemblance) and that of the next document.

    ``kept_in_edited`` and ``kept_in_next`` are the share of the text that the
    edited text and the next document have (containment).

    The next document is the following one by descending id, ties ordered by
    text; null ids come last; after the last row comes the first, so a lone
    row is its own next document. A null text counts as empty. Rows stay as
    many as they are; other columns are not read.

    Ids are cut at quantiles into ``buckets`` ranges (default: four a shuffle
    partition). The first row of each range is also dealt to the range before
    it, so a range holds the next document of all its rows: one shuffle, no
    global sort, and only a number of values as large as ``buckets`` reaches
    the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    want = buckets or 4 * parts
    found = rows.select(F.percentile_approx("doc_id", [k / want for k in range(1, want)] or [0.5], 10 * want).alias("q")).first().q
    rows = rows.withColumn("bucket", _bucket(F.col("doc_id"), sorted(set(found or []), reverse=True)))
    tops = {x.bucket: x.top for x in rows.groupBy("bucket").agg(F.max("doc_id").alias("top")).collect()}
    if not tops:
        return spark.createDataFrame([], _SCHEMA)
    order, last = sorted(tops), max(tops) + 1
    before = dict(zip(order, [order[-1], *order], strict=False))
    top_of = F.array(*(F.lit(tops.get(b)).cast("long") for b in range(last)))
    before_of = F.array(*(F.lit(before.get(b, -1)) for b in range(last)))
    own = F.struct(F.col("bucket").alias("b"), F.lit(0).alias("extra"))
    extra = F.struct(F.get(before_of, F.col("bucket")).alias("b"), F.lit(1).alias("extra"))
    first = F.col("doc_id").eqNullSafe(F.get(top_of, F.col("bucket")))
    dealt = rows.select("doc_id", "text", F.inline(F.when(first, F.array(own, extra)).otherwise(F.array(own))))
    placed = dealt.repartition(parts, "b").sortWithinPartitions(F.asc("b"), F.asc("extra"), F.desc_nulls_last("doc_id"), F.asc("text"))
    return placed.select("b", "extra", "doc_id", "text").mapInArrow(_scan, _SCHEMA)


def _bucket(value: Column, cuts: list[int]) -> Column:
    """How many of the falling ``cuts`` are at or above ``value``, by a search in two steps; all of them for null."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    at_least = lambda c: c >= value
    above = F.size(F.filter(F.lit(np.array(cuts[::step], np.int64)), at_least))
    within = F.size(F.filter(F.slice(F.lit(np.array(cuts, np.int64)), (above - 1) * step + 1, F.lit(step)), at_least))
    return F.when(value.isNull(), len(cuts)).when(above == 0, 0).otherwise((above - 1) * step + within)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))
