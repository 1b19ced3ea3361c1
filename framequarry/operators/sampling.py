"""Which frames or times of a clip to sample, and which frame a time falls into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: frames per second that sampling never exceeds by default.
MAX_FPS = 8


def _empty() -> Column:
    return F.array().cast("array<bigint>")


def _upto(n: Column) -> Column:
    """0 .. n - 1 as an array of longs; empty for n <= 0."""
    return F.when(n > 0, F.sequence(F.lit(0).cast("long"), F.greatest(n, F.lit(1)).cast("long") - 1)).otherwise(_empty())


def linspace(last: Column, n: Column) -> Column:
    """n evenly spaced values from 0 to ``last``, both included: multiples of one step, the last pinned; [0] for n = 1."""
    step = last / F.greatest(n - 1, F.lit(1))
    return F.transform(_upto(n), lambda k: F.when((k == n - 1) & (n > 1), last.cast("double")).otherwise(k * step))


def arange(stop: Column, step: Column) -> Column:
    """0, step, 2 step ... below ``stop``."""
    return F.transform(_upto(F.ceil(stop / step)), lambda k: k * step)


def candidate_fps(video_fps: Column, sampling_fps: Column, max_fps: int = MAX_FPS) -> Column:
    """Multiples of ``sampling_fps`` up to ``max_fps`` that divide ``video_fps``, all cut to whole numbers first.

    Raises where a rate isn't positive, or ``sampling_fps`` doesn't divide ``video_fps``.
    """
    v, s = video_fps.cast("int"), sampling_fps.cast("int")
    top = F.least(v, F.lit(max_fps))
    found = F.when(top >= s, F.filter(F.sequence(s, F.greatest(top, s), s), lambda c: v % c == 0)).otherwise(F.array().cast("array<int>"))
    bad = F.raise_error(F.concat(F.lit("sampling_fps must be positive and divide video_fps (got "), s.cast("string"), F.lit(", "), v.cast("string"), F.lit(")"))).cast("array<double>")
    return F.when((v <= 0) | (s <= 0) | (F.try_mod(v, s) != 0), bad).otherwise(found.cast("array<double>"))


def fps_step(video_fps: Column, target: Column) -> Column:
    """Frames from one sample to the next at a target rate, one at least."""
    return F.greatest((video_fps / target).cast("int"), F.lit(1))


def target_fps(video_fps: Column, max_frames: Column, total_frames: Column, candidates: Column) -> Column:
    """The candidate that samples most frames without exceeding ``max_frames``.

    The first candidate is taken in any case, as is each later one while none
    of those before yields a frame. Null without candidates.
    """
    frames_at = lambda c: (total_frames / fps_step(video_fps, c)).cast("int")
    state = F.struct(F.lit(0).alias("n"), F.lit(None).cast("double").alias("fps"))

    def choose(best: Column, c: Column) -> Column:
        n = frames_at(c)
        better = (best["n"] == 0) | ((n <= max_frames) & (n > best["n"]))
        return F.struct(F.when(better, n).otherwise(best["n"]).alias("n"), F.when(better, c).otherwise(best["fps"]).alias("fps"))

    return F.aggregate(candidates, state, choose, lambda best: best["fps"])


def frames_at_fps(target: Column, total_frames: Column, max_frames: Column, video_fps: Column) -> Column:
    """Frame numbers at a target rate, the first ``max_frames`` of them; evenly spaced without the end where the target is null."""
    total = total_frames.cast("long")
    spread = F.transform(_upto(max_frames), lambda k: (k * (total / max_frames)).cast("long"))
    step = fps_step(video_fps, F.coalesce(target, F.lit(1.0)))
    stepped = F.transform(_upto(F.ceil(total / step)), lambda k: k * step)
    return F.slice(F.when(target.isNull(), spread).otherwise(stepped), F.lit(1), max_frames.cast("int"))


def sample_frames_fps(video_fps: Column, total_frames: Column, num_frames: Column, sampling_fps: Column) -> Column:
    """Frame numbers in mode "fps"."""
    chosen = target_fps(video_fps, num_frames, total_frames, candidate_fps(video_fps, sampling_fps))
    return frames_at_fps(chosen, total_frames, num_frames, video_fps)


def sample_frames_uniform(total_frames: Column, fps: Column, num_frames: Column, max_fps: float | None = None) -> Column:
    """Frame numbers in mode "uniform_last_frame": evenly spaced with both ends, or every so many seconds plus the last."""
    n = total_frames.cast("long")
    even = F.transform(linspace((n - 1).cast("double"), F.least(num_frames.cast("long"), n)), lambda x: x.cast("long"))
    if max_fps is None:
        return F.when(n <= 0, _empty()).otherwise(even)
    stepped = F.transform(arange((n - 1).cast("double"), fps / max_fps), lambda x: F.bround(x).cast("long"))
    closed = F.when(F.try_element_at(stepped, F.lit(-1)) != n - 1, F.concat(stepped, F.array(n - 1))).otherwise(stepped)
    return F.when(n <= 2, _upto(n)).when(n / fps > (num_frames - 1) / F.lit(float(max_fps)), even).otherwise(closed)


def sample_times(duration: Column, fps: Column, num_frames: Column, mode: str = "uniform_last_frame", max_fps: float | None = None, sampling_fps: Column | None = None) -> Column:
    """Times to sample, in seconds."""
    if mode == "fps":
        options = candidate_fps(fps, sampling_fps)
        start = F.struct(F.element_at(options, 1).alias("fps"), F.lit(True).alias("open"))

        def widen(best: Column, c: Column) -> Column:
            fits = best["open"] & (num_frames / c >= duration)
            return F.struct(F.when(fits, c).otherwise(best["fps"]).alias("fps"), fits.alias("open"))

        chosen = F.aggregate(F.slice(options, F.lit(2), F.greatest(F.size(options) - 1, F.lit(0))), start, widen, lambda best: best["fps"])
        return F.filter(F.transform(_upto(num_frames), lambda k: k / chosen), lambda t: t < duration)
    if mode != "uniform_last_frame":
        raise NotImplementedError(mode)
    even = linspace(duration, num_frames.cast("long"))
    if max_fps is None:
        return even
    spaced = F.concat(arange(duration, F.lit(1 / max_fps)), F.array(duration))
    return F.when((num_frames - 1) / F.lit(float(max_fps)) < duration, even).otherwise(spaced)


def clamp(value: Column, low: Column, high: Column, pad: float = 1e-6) -> Column:
    """A time kept within a stream's begin and end, shortly inside both."""
    return F.greatest(low, F.least(high - pad, value)) if not pad else F.greatest(low + pad, F.least(high - pad, value))


def times_to_frames(targets: DataFrame, frames: DataFrame) -> DataFrame:
    """The frame of each target time: the first whose end lies after it, or the clip's last.

    ``targets`` has clip, t; ``frames`` has clip, frame_idx, end. Both are
    merged into one ordered series per clip, so that there is one exchange by
    clip and no join of all pairs; a target takes the next frame's number.
    """
    marks = frames.select("clip", F.col("end").alias("at"), F.lit(1).alias("is_frame"), F.col("frame_idx"), F.lit(None).cast("double").alias("t"))
    asks = targets.select("clip", F.col("t").alias("at"), F.lit(0).alias("is_frame"), F.lit(None).cast("long").alias("frame_idx"), F.col("t").cast("double").alias("t"))
    # among equal times a frame comes first, as its end must lie after the target
    ordered = Window.partitionBy("clip").orderBy(F.asc("at"), F.desc("is_frame"), F.asc("frame_idx"))
    following = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    last = Window.partitionBy("clip")
    both = marks.unionByName(asks)
    placed = both.withColumn("next", F.first("frame_idx", ignorenulls=True).over(following)).withColumn("last", F.max_by("frame_idx", F.when(F.col("is_frame") == 1, F.struct("at", "frame_idx"))).over(last))
    return placed.where("is_frame = 0").select("clip", "t", F.coalesce("next", "last").alias("frame_idx"))
