"""Benchmark decontamination by the q-gram lemma.

Texts are compared in a plain form: A-Z lower-cased, each run of ASCII
characters other than letters and digits one space. Every benchmark item is
cut into overlapping windows of ``WINDOW`` characters (code points of the
plain form), the last one flush with the item's end; a shorter item is one
window. A document holds an item if some stretch of it is within the window's
edit budget of one of the item's windows. An item of fewer than ``Q``
characters has no q-gram and no budget: a document holds it if its words stand
there one after another. An item without letters or digits is held by none.

A stretch within e edits of a window of n characters shares n - q + 1 - q e
q-grams with it at least, on diagonals that lie e apart at most. So shared
q-grams are counted by document, window and diagonal band; the bands overlap,
so that any such stretch falls wholly into one of them. Bands that meet the
bound are verified by alignment within the band, many at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framequarry.llm._shared import U, mix, odd_multipliers, slices, table

Q = 12
WINDOW = 80
STEP = 20
#: Edits allowed in a window, as a share of its length.
RATE = 1 / 16
BAND = 16
#: Characters of the benchmark that are sent to the workers at a time, some 25 bytes each in a worker; a larger benchmark is searched block by block.
BLOCK_CHARS = 2_000_000
#: Zeros between documents; more than any budget, so that no stretch spans two.
GAP = 64

_PLAIN = np.full(128, 32, np.uint32)
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _PLAIN[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _PLAIN[_c] = _c + 32
_WEIGHTS = odd_multipliers(Q // 4, 5)


def plain(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a text's plain form, and where each lies in the text."""
    raw = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    raw = np.where(raw < 128, _PLAIN[np.minimum(raw, 127)], raw)
    blank = raw == 32
    keep = ~(blank & np.append(True, blank[:-1])) if len(raw) else np.empty(0, bool)
    at = np.flatnonzero(keep)
    return raw[at], at


def folded(data: np.ndarray) -> np.ndarray:
    """A byte for each code point: itself below 128, one of 128 classes above. Equal characters stay equal; the alignment tells others apart."""
    return np.where(data < 128, data, 128 | ((data * np.uint32(0x9E3779B1)) >> np.uint32(25))).astype(np.uint8)


def trimmed(data: np.ndarray) -> np.ndarray:
    """A plain form without a space at either end."""
    return data[data[:1].tolist() == [32] : len(data) - (data[-1:].tolist() == [32])]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the q-gram at each position (q = 12: three words of four bytes)."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.empty(0, U)
    word = data[: len(data) - 3].astype(U)
    for k in (1, 2, 3):
        word |= data[k : len(data) - 3 + k].astype(U) << U(8 * k)
    total = word[:n] * _WEIGHTS[0]
    total += mix(word[4 : n + 4]) * _WEIGHTS[1]
    total += mix(word[8 : n + 8] + U(3)) * _WEIGHTS[2]
    return total ^ (total >> U(31))


def budget(size: int) -> int:
    """Edits allowed in a window: a share of its length, but never so many that no shared q-gram is certain."""
    return max(0, min(int(size * RATE), (size - Q) // Q))


def _spread(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value once for every number from its low up to its high, and those numbers."""
    low, count = low.astype(np.int64), (high - low).astype(np.int64)
    return np.repeat(values, count), np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


class Index:
    """Windows of benchmark items and where their q-grams lie.

    All items stand one after another in ``chars``, each q-gram's place is
    kept once, and of equal windows only the first is searched: ``items_of``
    names all items that have it. So a passage that many items share costs
    what one costs.
    """

    def __init__(self, items: list[tuple[int, str]]):
        self.short: dict[tuple[bytes, ...], list[int]] = {}
        parts, starts, sizes, self.items_of = [], [], [], []
        known: dict[bytes, int] = {}
        at = 0
        for item, text in items:
            data = trimmed(plain(text)[0])
            if len(data) < Q:
                if len(data):
                    self.short.setdefault(tuple(data.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").split(" ")), []).append(item)
                continue
            size = min(WINDOW, len(data))
            for start in sorted({*range(0, len(data) - size, STEP), len(data) - size}):
                window = known.setdefault(data[start : start + size].tobytes(), len(starts))
                if window == len(starts):
                    starts.append(at + start)
                    sizes.append(size)
                    self.items_of.append([])
                if item not in self.items_of[window][-1:]:
                    self.items_of[window].append(item)
            parts.append(data)
            at += len(data)
        self.chars = np.concatenate(parts) if parts else np.empty(0, np.uint32)
        self.starts, self.sizes = np.array(starts, np.int64), np.array(sizes, np.int64)
        self.budgets = np.array([budget(n) for n in self.sizes], np.int64)
        self.needed = np.maximum(1, self.sizes - Q + 1 - Q * self.budgets)
        hashes = gram_hashes(folded(self.chars))
        change = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(change, self.starts, 1)
        np.add.at(change, self.starts + self.sizes - Q + 1, -1)
        used = np.flatnonzero(np.cumsum(change[:-1]) > 0) if len(hashes) else np.empty(0, np.int64)
        order = np.argsort(hashes[used], kind="stable")
        self.places = used[order].astype(np.int32)
        self.keys, first = np.unique(hashes[used][order], return_index=True)
        self.first = np.append(first, len(used)).astype(np.int32)
        self.shift = 64 - min(24, max(10, (16 * len(self.keys)).bit_length()))
        self.seen = np.zeros(1 << (64 - self.shift), bool)
        self.seen[self.keys >> U(self.shift)] = True

    def _short(self, number: int, form: np.ndarray, places: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
        """Short items that a text holds, word for word; each where it first stands."""
        spaces = np.flatnonzero(form == 32)
        starts, ends = np.append(0, spaces + 1), np.append(spaces, len(form))
        words = form.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").split(" ")
        found: dict[int, tuple[int, int]] = {}
        for count in sorted({len(x) for x in self.short}):
            for k in range(len(words) - count + 1):
                for item in self.short.get(tuple(words[k : k + count]), ()):
                    found.setdefault(item, (int(places[starts[k]]), int(places[ends[k + count - 1] - 1]) + 1))
        return [(number, item, *span, 1, 0) for item, span in found.items()]

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int, int]]:
        """(text's number, item, start, end, windows found, fewest edits) of each item that a text holds.

        Start and end are in code points of the text and span all windows found.
        """
        forms = [plain(t) for t in texts]
        rows = [x for k, form in enumerate(forms) for x in self._short(k, *form)] if self.short else []
        return sorted(rows + self._windows(forms))

    def _windows(self, forms: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int, int, int, int, int]]:
        if not len(self.keys):
            return []
        starts, parts, at = [], [], GAP
        for data, _ in forms:
            starts.append(at)
            parts += [np.zeros(GAP, np.uint32), data]
            at += len(data) + GAP
        flat = np.concatenate([*parts, np.zeros(GAP + WINDOW + 2 * BAND, np.uint32)])
        hashes = gram_hashes(folded(flat))
        hit = np.flatnonzero(self.seen[hashes >> U(self.shift)])
        slot = np.minimum(np.searchsorted(self.keys, hashes[hit]), len(self.keys) - 1)
        same = self.keys[slot] == hashes[hit]
        hit, slot = hit[same], slot[same]
        if not len(hit):
            return []
        # from a gram to its places in the items, from a place to the windows around it
        hit, place = _spread(hit, self.first[slot], self.first[slot + 1])
        place = self.places[place].astype(np.int64)
        low, high = np.searchsorted(self.starts, place - (WINDOW - Q)), np.searchsorted(self.starts, place, "right")
        place = np.repeat(place, high - low)
        hit, window = _spread(hit, low, high)
        place = place - self.starts[window]
        inside = place + Q <= self.sizes[window]
        hit, window, place = hit[inside], window[inside], place[inside]
        at = hit - place  # where the window would start
        # windows with too few hits in all are out before the bands are counted
        doc = np.searchsorted(np.array(starts), hit, "right") - 1
        pair = doc * len(self.sizes) + window
        _, inverse, total = np.unique(pair, return_inverse=True, return_counts=True)
        likely = total[inverse] >= self.needed[window]
        pair, at, place = pair[likely], at[likely], place[likely]
        if not len(pair):
            return []
        # band b covers starts from b * BAND / 2 on; each start lies in two bands
        half = BAND // 2
        band = np.concatenate([at // half, at // half - 1]) + 1 + GAP
        pair, place = np.concatenate([pair, pair]), np.concatenate([place, place])
        bands = len(flat) // half + 2 * GAP
        key = np.unique((pair * bands + band) * WINDOW + place) // WINDOW
        found, shared = np.unique(key, return_counts=True)
        pair, band = found // bands, found % bands
        window = pair % len(self.sizes)
        good = shared >= self.needed[window]
        pair, band, window = pair[good], band[good] - 1 - GAP, window[good]
        out: dict[tuple[int, int], list] = {}
        for size in np.unique(self.sizes[window]):
            own = np.flatnonzero(self.sizes[window] == size)
            for block in np.array_split(own, max(1, len(own) // 2048)):
                edits, end = self.align(flat, band[block] * half, window[block])
                for k in np.flatnonzero(edits <= self.budgets[window[block]]):
                    doc, number = int(pair[block[k]] // len(self.sizes)), int(window[block[k]])
                    a, b = max(int(end[k]) - int(size), starts[doc]), min(int(end[k]), starts[doc] + len(forms[doc][0]))
                    old = out.setdefault((doc, number), [a, b, int(edits[k])])
                    old[:] = min(a, old[0]), max(b, old[1]), min(int(edits[k]), old[2])
        held: dict[tuple[int, int], list] = {}
        for (doc, number), (a, b, edits) in out.items():
            for item in self.items_of[number]:
                old = held.setdefault((doc, item), [a, b, 0, edits])
                old[:] = min(a, old[0]), max(b, old[1]), old[2] + 1, min(edits, old[3])
        return [(doc, item, int(forms[doc][1][a - starts[doc]]), int(forms[doc][1][b - starts[doc] - 1]) + 1, windows, edits) for (doc, item), (a, b, windows, edits) in held.items()]

    def align(self, flat: np.ndarray, low: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fewest edits, and the stretch's end, of windows of one size against stretches that start from ``low`` on within the band."""
        text = self.chars[self.starts[window][:, None] + np.arange(self.sizes[window[0]])]
        slack = int(self.budgets[window].max())
        width = BAND + 2 * slack
        base = low - slack
        steps = np.arange(width)
        now = np.zeros((len(window), width), np.int32)
        for t in range(text.shape[1]):
            at = np.clip(base[:, None] + t + steps, 0, len(flat) - 1)
            best = now + (flat[at] != text[:, t : t + 1])
            best[:, :-1] = np.minimum(best[:, :-1], now[:, 1:] + 1)
            now = np.minimum.accumulate(best - steps, axis=1) + steps
        place = now.argmin(axis=1)
        return now[np.arange(len(window)), place], base + text.shape[1] + place


def _indexes(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator:
    """Broadcast indexes of the benchmark, each of about ``BLOCK_CHARS`` characters at most."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).where("item_id is not null and text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_CHARS))
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        yield spark.sparkContext.broadcast(Index(sorted((r.item_id, r.text) for r in rows)))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """A row per document and benchmark item that it holds: doc_id, item_id, start, end (code points), n_windows, edits.

    Documents without a leak have no row; null texts and items hold nothing;
    repeated rows of ``docs`` repeat, null ids stay null. Items that share an
    id count as one. An empty table on either side gives no rows. Texts of any
    length are searched whole, a few at a time.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, item_id long, start long, end long, n_windows long, edits long"
    names = [x.split()[0] for x in schema.split(", ")]
    out = None
    for sent in _indexes(benchmark, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for batch in slices(batches, limit=1 << 20):
                ids = batch.column(0).to_pylist()
                rows = [(ids[k], *rest) for k, *rest in index.search(batch.column(1).to_pylist())]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

        part = narrow.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; no shuffle, one pass a benchmark block.

    Rows go by their text alone: null ids and repeated rows stay or go like
    any, null texts stay, an empty benchmark leaves all.
    """
    at = docs.columns.index(text_col)
    out = docs
    for sent in _indexes(benchmark, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for batch in slices(batches, limit=1 << 20):
                keep = np.ones(batch.num_rows, bool)
                keep[[row[0] for row in index.search(batch.column(at).to_pylist())]] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(run, docs.schema)
    return out


def op9_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
