"""Helpers that several operators share: the shared folder, table reads, word hashes."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

#: Entries after which a worker's word cache is emptied, and the longest word that it remembers: some 8 MB at most.
CACHE_LIMIT = 50_000
CACHE_WORD = 32

#: Bits of the filter that picks out rows by a column, at most (16 MB).
FILTER_BITS = 1 << 27

U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the session's ``spark.checkpoint.dir``. Only where that is unset and
    the master is local, as in tests, a temporary folder takes its place for
    the session; on a cluster no folder of one machine would do.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="framequarry-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


#: The folder of the tables that are written only for the work at hand.
_SCRATCH: ContextVar[str] = ContextVar("scratch", default="")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialize`` writes in here go when the block ends, but for lasting ones."""
    path = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
    token = _SCRATCH.set(path)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs the tasks it ran, not the
    work of earlier stages.
    """
    spark = df.sparkSession
    path = f"{_SCRATCH.get()}/{name}-{uuid.uuid4().hex}" if _SCRATCH.get() and not lasting else fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def marked(frame: DataFrame, column: str, wanted: DataFrame, mark: str) -> DataFrame:
    """``frame`` with a column ``mark``: whether the long ``column`` is in the only column of ``wanted``; true for a few others, too.

    A bit filter of at most ``FILTER_BITS`` stands for the wanted values: its
    size is bounded whatever their number, and a wrong hit costs time only. So
    no row is shuffled for it, and no frequent value meets in one task.
    """
    spark = frame.sparkSession
    wanted = wanted.toDF("value").where("value is not null")
    count = wanted.agg(F.approx_count_distinct("value")).first()[0]
    bits = min(FILTER_BITS, 1 << max(10, (16 * count).bit_length()))
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    words = wanted.select(F.shiftright(bit("value"), 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(value), {bits}) & 63 as int))").alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    array = np.zeros(bits // 64, np.int64)
    found = words.toArrow()  # FILTER_BITS / 64 rows at most
    array[found.column("word").to_numpy()] = found.column("mask").to_numpy()
    sent = spark.sparkContext.broadcast(array)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = sent.value
        for batch in batches:
            bit = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            hit = (mask[bit >> 6] >> (bit & 63)) & 1 == 1
            yield batch.set_column(batch.num_columns - 1, mark, pa.array(hit, pa.bool_()))

    keyed = frame.select("*", F.when(F.col(column).isNotNull(), bit(F.col(column).cast("long"))).otherwise(0).alias(mark))
    schema = StructType([*frame.schema.fields, StructField(mark, BooleanType())])
    return keyed.mapInArrow(run, schema)


def picked(frame: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows of ``frame`` that ``marked`` marks."""
    return marked(frame.where(F.col(column).isNotNull()), column, wanted, "picked").where("picked").drop("picked")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of at most ``rows`` rows and about ``limit`` bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, min(rows, int(limit * batch.num_rows / max(1, batch.nbytes))))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def split_words(text: str | None) -> list[bytes]:
    """Words of a text: runs of anything but space and \\t-\\r, with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class WordHashes(dict):
    """Word -> 64-bit hash, remembered within a worker."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHE_WORD:
            if len(self) >= CACHE_LIMIT:
                self.clear()
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U, len(words))


WORD_HASHES = WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U(32))
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


def odd_multipliers(count: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed)) | U(1)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    A text with fewer than ``width`` words has its whole word sequence as its
    one shingle; a text without words has none.
    """
    words = split_words(text)
    if not words:
        return np.empty(0, U)
    hashes = WORD_HASHES.of(words)
    size = min(width, len(words))
    weights = odd_multipliers(size, 7 + size)
    count = len(words) - size + 1
    total = hashes[:count] * weights[0]
    for k in range(1, size):
        total += mix(hashes[k : k + count] + U(k)) * weights[k]
    return np.unique(mix(total))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of an id as text, modulo ``modulus``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, in_fold: Column, per_class: int, piece: int) -> tuple[list[str], np.ndarray, float]:
    """(texts, labels, share of label 1) to fit a classifier on.

    Of each class, the ``per_class`` labelled ids with the smallest hashes are
    taken. A text of more than ``piece`` characters is cut into pieces of up to
    so many, each with the text's label, and of a class's pieces those
    ``per_class`` with the smallest hashes stay. So what reaches the driver is
    bounded, and no text is left out for its length. The share is counted over
    all labels in the fold. ``docs`` has doc_id and text; an id with several
    labels counts as toxic or good where one of them says so.
    """
    kept = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(in_fold & F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    kept = kept.groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r.label: r["count"] for r in kept.groupBy("label").count().collect()}
    ids = None
    span = 1 << 40
    place = F.pmod(F.xxhash64("doc_id"), F.lit(span))
    for value in (0, 1):
        # a bound on the hash leaves some four times as many as wanted, so that tasks don't all send their first to the driver
        bound = min(span, 4 * span * per_class // max(1, counts.get(value, 0)) + 1)
        some = kept.where((F.col("label") == value) & (place < bound)).orderBy(place, "doc_id").limit(per_class)
        ids = some if ids is None else ids.unionByName(some)
    # 2 * per_class ids at most
    rows = docs.select("doc_id", "text").where("text <> ''").join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / piece).cast("int")), lambda k: F.substring(F.col("text"), k * piece + 1, F.lit(piece)))
    rows = rows.select("doc_id", "label", F.posexplode(pieces).alias("number", "text"))
    order = (F.when(F.col("number") == 0, place).otherwise(F.pmod(F.xxhash64("doc_id", "number"), F.lit(span))), "doc_id", "number")
    some = [rows.where(F.col("label") == value).orderBy(*order).limit(per_class) for value in (0, 1)]
    found = sorted(some[0].unionByName(some[1]).collect(), key=lambda r: (r.doc_id, r.number))
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    return [r.text for r in found], np.array([r.label for r in found], np.int64), share


def class_weights(labels: np.ndarray, share: float) -> np.ndarray:
    """Weights that give a sample of both classes the share of label 1 that the whole has; 1 on average."""
    ones = labels.mean() if len(labels) else 0.0
    if ones in (0.0, 1.0):
        return np.ones(len(labels))
    return np.where(labels == 1, share / ones, (1 - share) / (1 - ones))
