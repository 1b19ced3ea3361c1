"""Pixel kernels: resizing, patches, a background model with motion masks, preprocessing of images and frames.

Images travel as rows (height, width, channels, data), ``data`` being the
bytes row by row, channels innermost. The kernels are numpy over one image at
a time; only the background model goes from a frame to the next, over frames
sorted within partitions, so that a clip is never held whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the background model: components, share of the weight that is background, starting, least and greatest variance, complexity charge, factor for a component's own pixels.
COMPONENTS, BACKGROUND, VARIANCE, LEAST, MOST, CHARGE, OWN = 5, 0.9, 15.0, 4.0, 75.0, 0.05, 9.0
#: The ellipse of 5 x 5 that masks are opened and closed with, by its rows' half widths.
ELLIPSE = (0, 2, 2, 2, 0)


def resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear between pixel centres, without smoothing: float32 from 0 to 1. Bytes are rounded to whole values first, half to even."""
    values = image.astype(np.float64)
    for axis, size in ((0, height), (1, width)):
        n = values.shape[axis]
        at = np.clip((np.arange(size) + 0.5) * (n / size) - 0.5, 0, n - 1)
        low = np.floor(at).astype(int)
        share = (at - low).reshape([-1 if k == axis else 1 for k in range(values.ndim)])
        values = values.take(low, axis) * (1 - share) + values.take(np.minimum(low + 1, n - 1), axis) * share
    if image.dtype == np.uint8:
        return (np.clip(np.rint(values), 0, 255) / 255).astype(np.float32)
    return np.clip(values, 0, 1).astype(np.float32)


def patches(image: np.ndarray, size: int) -> np.ndarray:
    """(patches, size * size * channels): squares in reading order, each by its rows; what is left at the right and below is cut off."""
    rows, columns = image.shape[0] // size, image.shape[1] // size
    whole = image[: rows * size, : columns * size].reshape(rows, size, columns, size, -1)
    return whole.swapaxes(1, 2).reshape(rows * columns, -1)


class BackgroundModel:
    """A mixture of Gaussians for each pixel, with as many components as the pixel needs.

    As published by Zivkovic (2004) and Zivkovic and van der Heijden (2006).
    Shadows aren't told from other foreground: both count as motion.
    """

    def __init__(self, pixels: int, channels: int, history: int = 500, threshold: float = 16.0):
        self.history, self.threshold, self.frames = history, threshold, 0
        self.weight = np.zeros((COMPONENTS, pixels), np.float32)
        self.variance = np.zeros((COMPONENTS, pixels), np.float32)
        self.mean = np.zeros((COMPONENTS, pixels, channels), np.float32)
        self.count = np.zeros(pixels, np.int64)

    def _rise(self, at: np.ndarray, place: np.ndarray) -> None:
        """Move the component at ``place`` of the pixels ``at`` up past all lighter ones."""
        while len(at):
            up = place > 0
            at, place = at[up], place[up]
            up = self.weight[place, at] >= self.weight[place - 1, at]
            at, place = at[up], place[up]
            for state in (self.weight, self.variance, self.mean):
                state[place, at], state[place - 1, at] = state[place - 1, at].copy(), state[place, at].copy()
            place = place - 1

    def apply(self, frame: np.ndarray) -> np.ndarray:
        """Whether each pixel of ``frame`` (pixels, channels) is foreground; the frame is learnt."""
        self.frames += 1
        rate = 1 / min(2 * self.frames, self.history)
        charge = rate * CHARGE
        values = frame.astype(np.float32)
        pixels = np.arange(len(values))
        fitted, background = np.zeros(len(values), bool), np.zeros(len(values), bool)
        total = np.zeros(len(values), np.float32)
        count = self.count.copy()
        for k in range(COMPONENTS):
            at = pixels[k < count]
            if not len(at):
                break
            self.weight[k, at] = (1 - rate) * self.weight[k, at] - charge
            ask = at[~fitted[at]]
            gap = self.mean[k, ask] - values[ask]
            distance = (gap * gap).sum(axis=1)
            background[ask] |= (total[ask] < BACKGROUND) & (distance < self.threshold * self.variance[k, ask])
            own = distance < OWN * self.variance[k, ask]
            ask, gap, distance = ask[own], gap[own], distance[own]
            self.weight[k, ask] += rate
            step = rate / self.weight[k, ask]
            self.mean[k, ask] -= step[:, None] * gap
            self.variance[k, ask] = np.clip(self.variance[k, ask] + step * (distance - self.variance[k, ask]), LEAST, MOST)
            fitted[ask] = True
            light = at[self.weight[k, at] < charge]
            self.weight[k, light] = 0
            self.count[light] -= 1
            total[at] += self.weight[k, at]
            self._rise(ask, np.full(len(ask), k))
        self.weight *= np.divide(1, total, out=np.zeros_like(total), where=total > np.finfo(np.float32).eps)
        new = pixels[~fitted]
        if not len(new):
            return ~background
        place = np.minimum(self.count[new], COMPONENTS - 1)
        self.count[new] = place + 1
        alone = place == 0
        for k in range(COMPONENTS):
            older = new[k < place]
            self.weight[k, older] *= 1 - rate
        self.weight[place, new] = np.where(alone, 1, rate)
        self.mean[place, new], self.variance[place, new] = values[new], VARIANCE
        self._rise(new, place)
        return ~background


def _spread(mask: np.ndarray) -> np.ndarray:
    """Each pixel with any pixel of the ellipse around it set; nothing lies beyond the edges."""
    reach = len(ELLIPSE) // 2
    height, width = mask.shape
    padded = np.pad(mask, reach)
    # each row of the ellipse is a run, so the masks of runs are made once and shared by rows of one width
    runs = {half: np.logical_or.reduce([padded[:, reach + k : reach + k + width] for k in range(-half, half + 1)]) for half in set(ELLIPSE)}
    return np.logical_or.reduce([runs[half][row : row + height] for row, half in enumerate(ELLIPSE)])


def smoothed(mask: np.ndarray) -> np.ndarray:
    """A mask opened, then closed: specks go, then gaps."""
    shrink = lambda m: ~_spread(~m)
    return shrink(_spread(_spread(shrink(mask))))


def motion_percent(frames: DataFrame, history: int = 500, threshold: float = 16.0) -> DataFrame:
    """(clip, frame_idx, motion): share of moving pixels in percent, of frames (clip, frame_idx, height, width, channels, data).

    One exchange by clip; a task holds the model of one clip and one frame at
    a time. A clip whose frames change size starts anew there. A clip's frames
    depend on those before, so one clip is one task's work.
    """
    parts = int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model = None
        for batch in batches:
            out = []
            for clip, index, height, width, channels, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if known != (clip, height, width, channels):
                    known, model = (clip, height, width, channels), BackgroundModel(height * width, channels, history, threshold)
                mask = model.apply(np.frombuffer(data, np.uint8).reshape(-1, channels)).reshape(height, width)
                out.append(float(np.count_nonzero(smoothed(mask)) / (height * width) * 100))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], names=["clip", "frame_idx", "motion"])

    rows = frames.select(F.col("clip").cast("string"), F.col("frame_idx").cast("long"), F.col("height").cast("int"), F.col("width").cast("int"), F.col("channels").cast("int"), "data")
    return rows.repartition(parts, "clip").sortWithinPartitions("clip", "frame_idx").mapInArrow(run, "clip string, frame_idx long, motion double")


def image_patches(images: DataFrame, height: int, width: int, size: int, id_col: str = "image") -> DataFrame:
    """(id, patch, pixels): every image resized and cut into patches, a row a patch, pixels from 0 to 1."""
    kind = images.select(F.col(id_col)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, (h, w, c, data) in enumerate(zip(*(x.to_pylist() for x in batch.columns[1:]), strict=True)):
                found = patches(resize(np.frombuffer(data, np.uint8).reshape(h, w, c), height, width), size)
                ids = batch.column(0).take(pa.array(np.full(len(found), row)))
                offsets = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.arange(len(found)), pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(found.ravel(), pa.float32()))], names=[id_col, "patch", "pixels"])

    return images.select(id_col, "height", "width", "channels", "data").mapInArrow(run, f"{id_col} {kind}, patch int, pixels array<float>")
