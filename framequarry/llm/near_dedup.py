"""Near-duplicate documents: MinHash signatures in an LSH forest, links confirmed on full shingle sets.

1. Every document's set of word shingles gives a signature of ``POSITIONS``
   16-bit values. Documents with equal sets are one class from here on.
2. The forest has ``TREES`` orders of the signatures, each with its own order
   of positions. Sorted so, documents that agree on a longer prefix lie closer
   together. Each document takes as candidates its ``NEIGHBOURS`` successors
   that share a prefix of ``MIN_DEPTH`` positions at least: in a sparse region
   those are all documents of the prefix, in a dense one only those that share
   a much deeper prefix, so the depth follows the density of the region.
   The orders are range-partitioned, so a large group is spread over tasks.
3. Candidates are confirmed on full sets in two rounds: each document with its
   two most similar candidates; then all candidates that still join different
   components. So a dense group costs few comparisons.
4. The bound on successors is made up for exactly: documents of a region (equal
   leading positions in a tree) with more members than that, and of more than
   one component, are joined on their rarest shingles. Linked sets share one of
   their first ``n - ceil(n * percent / 100) + 1`` shingles in any common order;
   here those that a sketch of counts finds rarest come first, so that shared
   passages lead nowhere. A shingle's documents meet in blocks, those outside
   its largest component with all, and only pairs whose remaining shingles can
   still suffice come out. No signature is asked, so nothing is lost here.
5. Components of the links, by alternating stars.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framequarry.llm._shared import U, marked, materialize, mix, odd_multipliers, picked, scratch, shingle_set, slices, table
from framequarry.llm.components import connected_components

POSITIONS = 48
MIN_DEPTH = 3
#: Each position leads one tree, so that the trees miss a pair independently.
TREES = POSITIONS // MIN_DEPTH
NEIGHBOURS = 8
#: Of a full set of successors, those that are taken at first.
DENSE = 3
#: How far below the threshold a signature's share of equal positions may lie, in standard deviations.
SLACK = 4.5
#: In the search of dense regions: a shingle's documents in a block, salts of a join on shingles, bits of the sketch of counts (1 MB).
BLOCK = 512
SALTS = 16
SKETCH_BITS = 20
#: Partners that a document's text is sent to its home for, at most; with more it has several homes.
PARTNERS = 64
_A = odd_multipliers(POSITIONS, 11)
_LEADS = np.random.default_rng(1000).permutation(POSITIONS).reshape(TREES, MIN_DEPTH)
_ORDERS = np.stack([np.append(lead, np.random.default_rng(1001 + t).permutation(np.setdiff1d(np.arange(POSITIONS), lead))) for t, lead in enumerate(_LEADS)])


def signature(hashes: np.ndarray) -> bytes:
    """MinHash signature of a set of 64-bit hashes: ``POSITIONS`` big-endian 16-bit values."""
    least = np.full(POSITIONS, U(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(hashes), 4096):
        least = np.minimum(least, (hashes[None, at : at + 4096] * _A[:, None]).min(axis=1))
    return (mix(least) >> U(48)).astype(">u2").tobytes()


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets' resemblance is ``percent`` at least, in whole numbers."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def least_equal(percent: int) -> int:
    """Equal positions below which a pair isn't looked at: true links have fewer once in some 100,000."""
    p = percent / 100
    return max(MIN_DEPTH, int(POSITIONS * p - SLACK * (POSITIONS * p * (1 - p)) ** 0.5))


def sign(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, signature) of (doc_id, text); key and signature are null where there are no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, keys, signatures = [], [], []
            for text in batch.column(1).to_pylist():
                hashes = shingle_set(text, width)
                sizes.append(len(hashes))
                keys.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                signatures.append(signature(hashes) if len(hashes) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())], names=["doc_id", "n_shingles", "set_key", "signature"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, signature binary")


def _forest(classes: DataFrame) -> DataFrame:
    """A row per class and tree, its signature in the tree's order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=1024):
            n = batch.num_rows
            values = np.frombuffer(b"".join(batch.column(2).to_pylist()), ">u2").reshape(n, POSITIONS)
            for t, order in enumerate(_ORDERS):
                data = np.ascontiguousarray(values[:, order]).tobytes()
                step = 2 * POSITIONS
                keys = [data[k : k + step] for k in range(0, len(data), step)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, t, np.int32)), pa.array(keys, pa.binary()), batch.column(0), batch.column(1)], names=["tree", "key", "id", "n"])

    return classes.select("id", "n", "signature").mapInArrow(run, "tree int, key binary, id long, n long")


def _region(tree: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """A number for each row's tree and leading positions."""
    out = tree.astype(np.int64)
    for p in range(MIN_DEPTH):
        out = (out << 16) | keys[:, p]
    return out


def _dense(rows: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(regions, ids) of the sorted rows that lie among more than ``NEIGHBOURS`` rows of one region."""
    region = _region(rows[0], rows[1])
    hit = np.zeros(len(region) + NEIGHBOURS, np.int64)
    start = np.flatnonzero(region[:-NEIGHBOURS] == region[NEIGHBOURS:])
    for offset in range(NEIGHBOURS + 1):
        hit[start + offset] = 1
    at = np.flatnonzero(hit[: len(region)])
    return region[at], rows[2][at]


def _pairs(rows: tuple[np.ndarray, ...], allowed, percent: int):
    """Candidates among sorted rows (tree, keys, ids, sizes): (u, v, equal positions) with u the earlier row.

    ``allowed(a, b)`` says for two slices of rows which pairs are asked for.
    """
    tree, keys, ids, sizes = rows
    enough = least_equal(percent)
    found = []
    for offset in range(1, min(NEIGHBOURS, len(ids) - 1) + 1):
        a, b = slice(None, -offset), slice(offset, None)
        near = allowed(a, b) & (keys[a, :MIN_DEPTH] == keys[b, :MIN_DEPTH]).all(axis=1) & (tree[a] == tree[b]) & (ids[a] != ids[b])
        near &= 100 * np.minimum(sizes[a], sizes[b]) >= percent * np.maximum(sizes[a], sizes[b])
        at = np.flatnonzero(near)
        equal = (keys[at] == keys[at + offset]).sum(axis=1)
        good = equal >= enough
        found.append((at[good], at[good] + offset, equal[good]))
    if not found:
        return
    first, second, equal = (np.concatenate(x) for x in zip(*found, strict=True))
    # a row with no room for more successors lies in a dense region, which is searched once more anyway: its best do for now
    order = np.lexsort((second, -equal, first))
    first, second, equal = first[order], second[order], equal[order]
    starts = np.flatnonzero(np.append(True, first[1:] != first[:-1])) if len(first) else np.empty(0, np.int64)
    sizes = np.diff(np.append(starts, len(first)))
    place = np.arange(len(first)) - np.repeat(starts, sizes)
    good = (np.repeat(sizes, sizes) < NEIGHBOURS) | (place < DENSE)
    if good.any():
        yield ids[first[good]], ids[second[good]], equal[good]


def _neighbours(rows: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Candidates (u, v, equal) of the sorted forest, each pair once, and the members (region, id) of its dense regions.

    Rows near a partition's ends are returned too, and their pairs across
    partitions found in a second step over those few rows.
    """

    def arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        n = batch.num_rows
        keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u2").reshape(n, POSITIONS)
        return batch.column(0).to_numpy(), keys, batch.column(2).to_numpy(), batch.column(3).to_numpy()

    def out(u, v, equal, tree=None, key=None, n=None, part=None, order=None) -> pa.RecordBatch:
        size = len(u)
        columns = [pa.array(u, pa.int64()), pa.array(v, pa.int64()) if v is not None else pa.nulls(size, pa.int64()), pa.array(equal, pa.int32()) if equal is not None else pa.nulls(size, pa.int32())]
        columns += [pa.array(x, t) if x is not None else pa.nulls(size, t) for x, t in ((tree, pa.int32()), (key, pa.binary()), (n, pa.int64()), (part, pa.int32()), (order, pa.int32()))]
        return pa.RecordBatch.from_arrays(columns, names=["u", "v", "equal", "tree", "key", "n", "part", "place"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        kept = None  # the last rows, to go on from
        seen = 0
        for batch in slices(batches, rows=4096):
            now = arrays(batch)
            if kept is not None:
                now = tuple(np.concatenate([k, x]) for k, x in zip(kept, now, strict=True))
            held = 0 if kept is None else len(kept[0])
            if seen < NEIGHBOURS:  # the partition's first rows
                head = slice(held, min(len(now[0]), held + NEIGHBOURS - seen))
                count = head.stop - head.start
                yield out(now[2][head], None, None, now[0][head], [k.tobytes() for k in now[1][head]], now[3][head], np.full(count, part), np.arange(seen, seen + count))
            fresh = np.arange(len(now[0])) >= held  # pairs within the kept rows were found before
            for u, v, equal in _pairs(now, lambda a, b, fresh=fresh: fresh[b], percent):
                yield out(u, v, equal)
            region, ids = _dense(now)
            if len(ids):
                yield out(ids, None, None, n=region)
            seen += batch.num_rows
            kept = tuple(x[-NEIGHBOURS:] for x in now)
        if seen > NEIGHBOURS:
            count = min(NEIGHBOURS, seen - NEIGHBOURS)
            tail = slice(len(kept[0]) - count, None)
            yield out(kept[2][tail], None, None, kept[0][tail], [k.tobytes() for k in kept[1][tail]], kept[3][tail], np.full(count, part), np.arange(NEIGHBOURS, NEIGHBOURS + count))

    schema = "u long, v long, equal int, tree int, key binary, n long, part int, place int"
    found = materialize(rows.mapInArrow(scan, schema), "forest")
    ends = found.where("part is not null").select("tree", "key", F.col("u").alias("id"), "n", "part", "place")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [b for b in batches if b.num_rows]
        if not blocks:
            return
        batch = pa.Table.from_batches(blocks).combine_chunks().to_batches()[0]
        part = batch.column(4).to_numpy()
        for u, v, equal in _pairs(arrays(batch), lambda a, b: part[a] != part[b], percent):
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(equal, pa.int32()), pa.nulls(len(u), pa.int64())], names=["u", "v", "equal", "n"])
        region, ids = _dense(arrays(batch))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.nulls(len(ids), pa.int64()), pa.nulls(len(ids), pa.int32()), pa.array(region, pa.int64())], names=["u", "v", "equal", "n"])

    # as many rows as 2 * NEIGHBOURS a partition, whatever the input's size
    crossing = ends.repartition(1).sortWithinPartitions("part", "place").select("tree", "key", "id", "n", "part").mapInArrow(across, "u long, v long, equal int, n long")
    both = found.where("part is null").select("u", "v", "equal", "n").unionByName(materialize(crossing, "crossing"))
    pairs = both.where("v is not null").groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).agg(F.max("equal").alias("equal"))
    return pairs, both.where("v is null").select(F.col("n").alias("region"), F.col("u").alias("id")).distinct()


def confirm(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (u, v) whose full sets are linked.

    Partners meet at a home of u: its text is sent there once and the texts of
    up to ``PARTNERS`` partners. A document with more partners has several
    homes, in several tasks.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last, held = None, 0  # the last row's u, and how many rows of it were seen
        for batch in batches:
            if not batch.num_rows:
                continue
            u, v = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            starts = np.flatnonzero(np.append(True, u[1:] != u[:-1]))
            sizes = np.diff(np.append(starts, len(u)))
            place = np.arange(len(u)) - np.repeat(starts, sizes)
            if u[0] == last:
                place[: sizes[0]] += held
            last, held = u[-1], place[-1] + 1
            home = mix(mix(u.astype(U)) + U(part << 32) + (place // PARTNERS).astype(U)).astype(np.int64)
            own = np.flatnonzero(place % PARTNERS == 0)
            columns = (np.concatenate([home, home[own]]), np.concatenate([u, u[own]]), np.concatenate([v, u[own]]))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["home", "u", "doc_id"])

    wanted = pairs.select("u", "v").repartitionByRange(parts, "u", "v").sortWithinPartitions("u", "v").mapInArrow(deal, "home long, u long, doc_id long")
    wanted = materialize(wanted, "homes")
    rows = picked(docs, "doc_id", wanted.select("doc_id")).join(wanted, "doc_id").select("home", "u", "doc_id", "text")
    rows = rows.repartition(parts, "home").sortWithinPartitions(F.asc("home"), F.asc("u"), F.asc(F.col("u") != F.col("doc_id")), F.asc("doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, own, out = None, [], []
        for batch in slices(batches):
            for at, u, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (at, u) != home:
                    home, own = (at, u), []
                hashes = shingle_set(text, width)
                if doc == u:
                    own.append(hashes)
                elif any(linked(x, hashes, percent) for x in own):
                    out.append((u, doc))
            if out:
                u, v = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
                out = []

    return rows.mapInArrow(run, "u long, v long")


def _label(frame: DataFrame, name: str, parts: DataFrame, out: str) -> DataFrame:
    """``frame`` with the component of column ``name``: its own value where it is in none."""
    return frame.join(parts.select(F.col("id").alias(name), F.col("component_id").alias(out)), name, "left").withColumn(out, F.coalesce(out, name))


def _counts(texts: DataFrame, width: int) -> DataFrame:
    """(bucket, count) of the shingles of ``texts``, by the leading bits of their hashes: parts of the sums, a bucket once for each core at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                np.add.at(counts, (shingle_set(text, width) >> U(64 - SKETCH_BITS)).astype(np.int64), 1)
        at = np.flatnonzero(counts)
        for k in range(0, len(at), 1 << 16):
            part = at[k : k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(counts[part], pa.int64())], names=["bucket", "count"])

    # one task a core adds up all that the core reads: of many small tasks each would return the region's common shingles again
    return texts.select("text").coalesce(texts.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, "bucket long, count long")


def _rarity(texts: DataFrame, width: int) -> np.ndarray:
    """Levels of how often shingles occur in ``texts``, by the leading bits of their hashes: 1 byte each, whatever the input.

    The levels only order the shingles; any levels give the same links.
    """
    # 2 ** SKETCH_BITS rows at most
    found = _counts(texts, width).groupBy("bucket").agg(F.sum("count").alias("count")).toArrow()
    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    out[found.column("bucket").to_numpy()] = (4 * np.log2(found.column("count").to_numpy())).astype(np.uint8)
    return out


def rarest(hashes: np.ndarray, levels: np.ndarray, percent: int) -> np.ndarray:
    """The leading shingles of a set, rarest first: any set linked with it shares one of them with its own."""
    n = len(hashes)
    order = np.lexsort((hashes, levels[(hashes >> U(64 - SKETCH_BITS)).astype(np.int64)]))
    return hashes[order[: n - (percent * n + 99) // 100 + 1]] if n else hashes


def _dense_pairs(dense: DataFrame, texts: DataFrame, classes: DataFrame, parts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (u, v) of different components, both in a dense region (region, id), that may be linked by their rarest shingles."""
    members = materialize(_label(dense, "id", parts, "component"), "regions")
    mixed = members.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    inside = picked(members, "region", mixed.select("region")).select("id", "component").distinct()
    inside = materialize(inside.join(classes.select("id", "n").groupBy("id").agg(F.max("n").alias("n")), "id"), "dense")
    texts = materialize(picked(texts, "doc_id", inside.select("id")).join(inside.withColumnRenamed("id", "doc_id"), "doc_id"), "texts")
    levels = texts.sparkSession.sparkContext.broadcast(_rarity(texts, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=64):
            for doc, component, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes = shingle_set(text, width)
                first = rarest(hashes, levels.value, percent)
                size = len(first)
                columns = (pa.array(first.astype(np.int64)), pa.array(np.arange(size)), *(pa.array(np.full(size, x, np.int64)) for x in (len(hashes), doc, component)))
                yield pa.RecordBatch.from_arrays(list(columns), names=["token", "place", "n", "id", "component"])

    tokens = materialize(texts.select("doc_id", "component", "text").mapInArrow(run, "token long, place long, n long, id long, component long"), "tokens")
    levels.unpersist()
    shares = tokens.groupBy("token", "component").agg(F.count(F.lit(1)).alias("k"))
    stats = shares.groupBy("token").agg(F.max_by("component", F.struct("k", -F.col("component"))).alias("main"), F.sum("k").alias("k"), F.max("k").alias("largest")).where("k > largest")
    stats = materialize(stats.select("token", "main", F.ceil(F.col("k") / BLOCK).alias("blocks"), F.ceil((F.col("k") - F.col("largest")) / BLOCK).alias("few_blocks")), "stats")
    tokens = picked(tokens, "token", stats.select("token"))
    # a frequent shingle's rows are joined to its figures in SALTS parts
    stats = stats.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    tokens = materialize(tokens.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(stats, ["token", "salt"]), "tokens")
    number = F.xxhash64(F.lit(1), "id")
    cells = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))
    few = tokens.where("component <> main").withColumn("few_block", F.pmod(number, F.col("few_blocks"))).withColumn("block", cells("blocks"))
    every = tokens.withColumn("block", F.pmod(number, F.col("blocks"))).withColumn("few_block", cells("few_blocks"))
    few = few.select("token", "few_block", "block", "main", F.col("id").alias("u"), F.col("component").alias("cu"), F.col("n").alias("nu"), (F.col("n") - F.col("place")).alias("ru"))
    every = every.select("token", "few_block", "block", F.col("id").alias("v"), F.col("component").alias("cv"), F.col("n").alias("nv"), (F.col("n") - F.col("place")).alias("rv"))
    met = few.join(every, ["token", "few_block", "block"])
    # two documents outside the main component meet twice; what follows the shared shingle must suffice
    met = met.where("cu <> cv and (cv = main or u < v)").where(f"100 * least(nu, nv) >= {percent} * greatest(nu, nv) and 100 * least(ru, rv) >= {percent} * (nu + nv - least(ru, rv))")
    return met.groupBy("u", "v").agg(F.first("cv").alias("cv"), F.count(F.lit(1)).alias("k"))


def _rest(dense: DataFrame, texts: DataFrame, classes: DataFrame, parts: DataFrame, width: int, percent: int) -> DataFrame:
    """``parts`` after the links that the bound on successors may have passed over."""
    pairs = materialize(_dense_pairs(dense, texts, classes, parts, width, percent), "pairs")
    # a document's likeliest partner in each other component first, then what still lies between components
    first = pairs.groupBy("u", "cv").agg(F.max_by("v", F.struct("k", "v")).alias("v")).select("u", "v")
    parts = _merged(parts, materialize(confirm(first, texts, width, percent), "pairs"))
    left = _label(_label(pairs.select("u", "v"), "u", parts, "cu"), "v", parts, "cv").where("cu <> cv").select("u", "v").join(first, ["u", "v"], "left_anti")
    return _merged(parts, materialize(confirm(left, texts, width, percent), "pairs"))


def _merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``parts`` (id, component_id) after more links (u, v) between its components; ids in no component are their own."""
    links = _label(_label(links, "u", parts, "cu"), "v", parts, "cv").select(F.col("cu").alias("u"), F.col("cv").alias("v"))
    joined = connected_components(links)
    old = parts.join(joined.select(F.col("id").alias("component_id"), F.col("component_id").alias("now")), "component_id", "left").select("id", F.coalesce("now", "component_id").alias("component_id"))
    fresh = joined.join(parts, "id", "left_anti").select("id", "component_id")
    return materialize(old.unionByName(fresh), "components")


def components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_shingles, component_id), one row a row.

    Ids are meant to be unique; rows that repeat one with another text are
    grouped by their own texts. A null id can't name a component: such a row
    gets none and links nothing. Texts that are null or without words have no
    shingles and stand alone.
    """
    with scratch(docs.sparkSession):
        return materialize(_components(docs, width, percent), "components", lasting=True)


def _components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    signed = materialize(sign(docs, width), "signatures")
    live = signed.where("doc_id is not null and set_key is not null")
    classes = materialize(live.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature")), "classes")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    forest = _forest(classes).repartitionByRange(parts, "tree", "key", "id").sortWithinPartitions("tree", "key", "id")
    candidates, dense = _neighbours(forest, percent)
    candidates, dense = materialize(candidates, "candidates"), materialize(dense, "dense")

    either = candidates.select("u", "v", "equal", F.col("u").alias("at")).unionByName(candidates.select("u", "v", "equal", F.col("v").alias("at")))
    best = Window.partitionBy("at").orderBy(F.desc("equal"), "u", "v")
    first = materialize(either.withColumn("k", F.row_number().over(best)).where("k <= 2").select("u", "v").distinct(), "pairs")
    texts = materialize(picked(docs, "doc_id", candidates.select(F.explode(F.array("u", "v"))).unionByName(dense.select(F.col("id").alias("col")))), "texts")
    grouped = connected_components(confirm(first, texts, width, percent))
    left = _label(_label(candidates.select("u", "v").join(first, ["u", "v"], "left_anti"), "u", grouped, "cu"), "v", grouped, "cv").where("cu <> cv")
    grouped = _merged(grouped, confirm(materialize(left.select("u", "v"), "pairs"), texts, width, percent))
    grouped = _rest(dense, texts, classes, grouped, width, percent)

    rows = signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key"))
    rows = rows.join(classes.select("set_key", "id"), "set_key", "left")
    return rows.join(grouped, "id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "id", "doc_id").alias("component_id"))


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept (whether the row names its component).

    A null doc_id has a null component and is kept; repeated rows repeat.
    """
    found = components(_narrow(docs, id_col, text_col), width, percent)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that another stands for.

    Of each group the rows with the smallest id stay; where several rows have
    that id, one of them does. Rows without an id stay.
    """
    found = materialize(near_duplicates(docs, width, percent, id_col, text_col), "near-duplicates")
    key = F.col(id_col).cast("long")
    name = f"id_{uuid.uuid4().hex}"  # no column of ``docs``
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct()
    repeated = materialize(found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(name)), "repeated")
    # rows that surely stay aren't shuffled
    split = marked(docs, id_col, gone.unionByName(repeated), f"{name}_mark")
    stay, asked = (split.where(c).drop(f"{name}_mark") for c in (~F.col(f"{name}_mark"), F.col(f"{name}_mark")))
    stay = stay.unionByName(asked.join(gone.unionByName(repeated), key == F.col(name), "left_anti"))
    if repeated.isEmpty():
        return stay
    return stay.unionByName(asked.join(repeated, key == F.col(name), "left_semi").dropDuplicates([id_col]))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


#: Rows of ``op2_near_dedup``.
OP2_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS sh FROM d
), e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), r(a, b) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, len(sh) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c ON doc_id = a
"""
