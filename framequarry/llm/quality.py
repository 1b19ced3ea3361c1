"""Quality by a byte-level convolutional network, in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it.
Each byte has a learned vector; learned filters run over the chunk, and the
greatest response of each filter, over all places, describes the chunk. A
small layer turns that into the chunk's evidence. The greatest and the mean
evidence of all chunks, combined, give one probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framequarry.llm._shared import class_weights, labelled_sample, remainder, slices, table

CHUNK = 512
OVERLAP = 64
KERNEL = 8
STRIDE = 2
DIM = 6
FILTERS = 32
HIDDEN = 16
#: Labelled texts of each class that the network is fitted on, at most; a longer one counts as several texts of up to so many characters.
PER_CLASS = 800
PIECE = 12_000
EPOCHS = 14
BATCH = 32
RATE = 4e-3
#: Share of texts, good and bad alike, that a short piece stands for in an epoch.
SHORT = 0.15
THRESHOLD = 0.3
#: Chunks that are convolved at a time.
BLOCK = 64

_PLACES = (CHUNK - KERNEL) // STRIDE + 1


def chunks(text: str | None) -> np.ndarray:
    """Overlapping chunks of a text's bytes, the last one flush with the end; a shorter text is one chunk, padded with zeros."""
    return _chunks((text or "").encode("utf-8", "surrogatepass"))


def _chunks(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8)
    if len(data) <= CHUNK:
        return np.concatenate([data, np.zeros(CHUNK - len(data), np.uint8)])[None]
    starts = [*range(0, len(data) - CHUNK, CHUNK - OVERLAP), len(data) - CHUNK]
    return np.lib.stride_tricks.sliding_window_view(data, CHUNK)[starts]


def _fill(data: np.ndarray) -> np.ndarray:
    """How much of each chunk is text."""
    return ((data != 0).mean(axis=1, dtype=np.float32))[:, None]


def _patches(vectors: np.ndarray) -> np.ndarray:
    """(chunks, CHUNK, DIM) -> (chunks, places, KERNEL * DIM)."""
    n, (a, b, c) = len(vectors), vectors.strides
    return np.lib.stride_tricks.as_strided(vectors, (n, _PLACES, KERNEL * DIM), (a, b * STRIDE, c), writeable=False)


class Network:
    """Parameters: byte vectors, filters, hidden layer, evidence, and how evidence is combined."""

    NAMES = ("vectors", "filters", "filter_bias", "hidden", "hidden_bias", "out", "combine")

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.vectors = draw(256, DIM, scale=0.5)
        self.filters = draw(KERNEL * DIM, FILTERS, scale=(KERNEL * DIM) ** -0.5)
        self.filter_bias = np.zeros(FILTERS, np.float32)
        self.hidden = draw(FILTERS + 1, HIDDEN, scale=FILTERS**-0.5)
        self.hidden_bias = np.zeros(HIDDEN, np.float32)
        self.out = draw(HIDDEN, scale=HIDDEN**-0.5)
        self.combine = np.array([0.7, 0.7, 0.0], np.float32)  # greatest, mean, bias

    def pooled(self, data: np.ndarray, places: bool = False):
        """Greatest response of each filter in each chunk (and where it lies)."""
        best = np.empty((len(data), FILTERS), np.float32)
        where = np.empty((len(data), FILTERS), np.int64) if places else None
        for at in range(0, len(data), BLOCK):
            patch = _patches(np.ascontiguousarray(self.vectors[data[at : at + BLOCK]]))
            response = np.matmul(patch.reshape(-1, KERNEL * DIM), self.filters).reshape(patch.shape[0], _PLACES, FILTERS)
            best[at : at + BLOCK] = response.max(axis=1)
            if places:
                where[at : at + BLOCK] = response.argmax(axis=1)
        return (best, where) if places else best

    def evidence(self, best: np.ndarray, fill: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pooled responses with the chunk's fill, hidden layer, and evidence for label 0."""
        a = np.hstack([np.maximum(best + self.filter_bias, 0), fill])
        h = np.maximum(a @ self.hidden + self.hidden_bias, 0)
        return a, h, h @ self.out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of label 1 of each whole text."""
        parts = [chunks(t) for t in texts]
        ends = np.cumsum([len(p) for p in parts])
        # a text's chunks go through the network by themselves: equal texts get equal scores whatever stands beside them
        evidence = np.concatenate([self.evidence(self.pooled(p), _fill(p))[2] for p in parts])
        starts = np.append(0, ends[:-1])
        z = self.combine[0] * np.maximum.reduceat(evidence, starts) + self.combine[1] * np.add.reduceat(evidence, starts) / np.diff(np.append(starts, ends[-1])) + self.combine[2]
        return 1 / (1 + np.exp(np.clip(z.astype(float), -50, 50)))

    def gradients(self, parts: list[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
        """Slopes of the weighted log loss, in the order of ``NAMES``; evidence speaks for label 0."""
        data, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
        starts = np.append(0, np.cumsum(sizes)[:-1])
        best, where = self.pooled(data, True)
        a, h, s = self.evidence(best, _fill(data))
        top = np.array([x + s[x : x + n].argmax() for x, n in zip(starts, sizes, strict=True)])
        mean = np.add.reduceat(s, starts) / sizes
        z = self.combine[0] * s[top] + self.combine[1] * mean + self.combine[2]
        dz = ((1 / (1 + np.exp(-np.clip(z, -50, 50))) - (1 - labels)) * weights / len(parts)).astype(np.float32)
        d_combine = np.array([dz @ s[top], dz @ mean, dz.sum()], np.float32)
        ds = np.repeat(self.combine[1] * dz / sizes, sizes).astype(np.float32)
        ds[top] += self.combine[0] * dz
        d_out = h.T @ ds
        dh = (ds[:, None] * self.out) * (h > 0)
        d_hidden, d_hidden_bias = a.T @ dh, dh.sum(axis=0)
        da = (dh @ self.hidden[:FILTERS].T) * (best + self.filter_bias > 0)
        d_filter_bias = da.sum(axis=0)
        d_filters = np.empty_like(self.filters)
        d_vectors = np.zeros_like(self.vectors)
        rows = np.arange(len(data))[:, None]
        steps = np.arange(KERNEL)
        for f in range(FILTERS):  # only the places of the greatest responses carry a slope
            seen = data[rows, where[:, f : f + 1] * STRIDE + steps]
            d_filters[:, f] = (self.vectors[seen].reshape(len(data), -1) * da[:, f : f + 1]).sum(axis=0)
            back = da[:, f, None, None] * self.filters[:, f].reshape(1, KERNEL, DIM)
            flat = back.reshape(-1, DIM)
            for d in range(DIM):
                d_vectors[:, d] += np.bincount(seen.ravel(), weights=flat[:, d], minlength=256).astype(np.float32)
        return [d_vectors, d_filters, d_filter_bias, d_hidden, d_hidden_bias, d_out, d_combine]


def fit(texts: list[str], labels: np.ndarray, share: float, epochs: int = EPOCHS, seed: int = 0) -> Network:
    """Fit by Adam over shuffled batches; without both classes the network only knows the share."""
    net = Network(seed)
    if not len(texts) or labels.min() == labels.max():
        p = min(max(share, 1e-3), 1 - 1e-3)
        net.combine[:] = 0, 0, np.log((1 - p) / p)
        return net
    weights = class_weights(labels, min(max(share, 0.3), 0.7))
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    parts = [_chunks(x) for x in raw]
    rng = np.random.default_rng(seed)
    first, second = ([np.zeros_like(getattr(net, k)) for k in net.NAMES] for _ in range(2))
    step, total = 0, epochs * -(-len(texts) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            step += 1
            rate = RATE * (1 - step / (total + 1))
            # some texts stand for their own short pieces, as few labelled texts are short
            batch = [_chunks(raw[i][(c := int(rng.integers(max(1, len(raw[i]) - 20)))) : c + int(rng.integers(12, 160))]) if rng.random() < SHORT else parts[i] for i in own]
            for k, g, m, v in zip(net.NAMES, net.gradients(batch, labels[own], weights[own]), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                getattr(net, k)[...] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def train(docs: DataFrame, labels: DataFrame, in_fold=None) -> Network:
    """A network from ``docs`` (doc_id, text) and the ``quality`` column of ``labels`` (doc_id, quality)."""
    fold = remainder(F.col("doc_id"), 5) != 0 if in_fold is None else in_fold
    return fit(*labelled_sample(docs, labels, "quality", fold, PER_CLASS, PIECE))


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def score_documents(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every row of ``docs``; whole texts count, a null text as an empty one."""
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sent.value.scores(batch.column(1).to_pylist()), pa.float64())], names=["doc_id", "score"])

    return _narrow(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, train(_narrow(docs, "doc_id", "text"), table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
