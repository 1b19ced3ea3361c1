"""Motion segments of frame series: runs, buffering, least duration, merging of close segments, clip names.

A series has one row per frame: clip, frame_idx (long, from 0 without gaps)
and motion (double, per cent of moving pixels). All windows and groupings are
by clip, so one exchange serves the whole chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _frames(seconds: float, fps: Column) -> Column:
    """Whole frames in so many seconds, cut towards zero."""
    return (F.lit(float(seconds)) * fps).cast("long")


def motion_percent(masks: DataFrame, keys: list[str], pixel: str = "px") -> DataFrame:
    """Per cent of non-zero pixels by ``keys``, from one row per pixel."""
    return masks.groupBy(*keys).agg((F.count_if(F.col(pixel) != 0) / F.count(F.lit(1)) * 100).alias("motion"))


def mask_percent(mask: Column) -> Column:
    """Per cent of non-zero values in an array of pixels; null for an empty one."""
    return F.try_divide(F.size(F.filter(mask, lambda p: p != 0)) * F.lit(100.0), F.size(mask))


def motion_runs(frames: DataFrame, fps: float | str, threshold: float = 0.5, min_duration: float = 1.0, buffer: float = 1.0) -> DataFrame:
    """Segments before merging: clip, start_frame, end_frame, avg_motion, fps.

    A run is a longest stretch of frames at or above ``threshold``. It ends
    ``buffer`` seconds after the first frame below (within the clip), or at
    the clip's last frame if none follows. Runs with fewer frames from start
    to end than ``min_duration`` holds are dropped. ``fps`` is a number or a
    column's name.
    """
    rate = F.col(fps).cast("double") if isinstance(fps, str) else F.lit(float(fps))
    whole, ordered = Window.partitionBy("clip"), Window.partitionBy("clip").orderBy("frame_idx")
    moving = (
        frames.select("clip", "frame_idx", "motion", rate.alias("fps"), F.count(F.lit(1)).over(whole).alias("n"))
        .where(F.col("motion") >= threshold)
        .withColumn("island", F.col("frame_idx") - F.row_number().over(ordered))
    )
    runs = moving.groupBy("clip", "island").agg(F.min("frame_idx").alias("start_frame"), (F.max("frame_idx") + 1).alias("below"), F.avg("motion").alias("avg_motion"), F.first("n").alias("n"), F.first("fps").alias("fps"))
    end = F.when(F.col("below") == F.col("n"), F.col("n") - 1).otherwise(F.least(F.col("n") - 1, F.col("below") + _frames(buffer, F.col("fps"))))
    return runs.withColumn("end_frame", end).where(F.col("end_frame") - F.col("start_frame") >= _frames(min_duration, F.col("fps"))).select("clip", "start_frame", "end_frame", "avg_motion", "fps")


def merge_segments(runs: DataFrame, gap: float = 30.0) -> DataFrame:
    """Join segments whose starts lie ``gap`` seconds or less after the end before; averages are folded pairwise in order.

    With k segments in a group the fold's weights are 2^-(k-1) for the first
    and 2^-(k-j+1) for the j-th, so a sum over the group replaces the loop.
    """
    ordered = Window.partitionBy("clip").orderBy("start_frame")
    group = Window.partitionBy("clip", "segment_group")
    flagged = runs.withColumn("opens", F.coalesce(F.col("start_frame") - F.lag("end_frame").over(ordered) > _frames(gap, F.col("fps")), F.lit(True)).cast("int"))
    grouped = flagged.withColumn("segment_group", F.sum("opens").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    weighted = grouped.withColumn("last", F.row_number().over(group.orderBy(F.desc("start_frame")))).withColumn("share", F.col("avg_motion") * F.pow(F.lit(2.0), -(F.col("last") - F.col("opens"))))
    out = weighted.groupBy("clip", "segment_group").agg(F.min("start_frame").alias("start_frame"), F.max("end_frame").alias("end_frame"), F.sum("share").alias("avg_motion"), F.count(F.lit(1)).alias("n_runs"), F.first("fps").alias("fps"))
    return out.select("clip", "start_frame", "end_frame", (F.col("start_frame") / F.col("fps")).alias("start_time"), (F.col("end_frame") / F.col("fps")).alias("end_time"), "avg_motion", "n_runs")


def motion_segments(frames: DataFrame, fps: float | str, threshold: float = 0.5, min_duration: float = 1.0, buffer: float = 1.0, gap: float = 30.0) -> DataFrame:
    """Merged motion segments of every clip."""
    return merge_segments(motion_runs(frames, fps, threshold, min_duration, buffer), gap)


def clip_manifest(segments: DataFrame) -> DataFrame:
    """``segments`` with their number in the clip, file name ``<clip>_motion_NNN.mp4`` and duration."""
    number = F.row_number().over(Window.partitionBy("clip").orderBy("start_frame"))
    named = segments.withColumn("segment_no", number)
    name = F.concat(F.col("clip").cast("string"), F.lit("_motion_"), F.when(F.col("segment_no") < 1000, F.lpad(F.col("segment_no").cast("string"), 3, "0")).otherwise(F.col("segment_no").cast("string")), F.lit(".mp4"))
    return named.withColumn("file_name", name).withColumn("duration", F.col("end_time") - F.col("start_time"))


def frames_in_segments(frames: DataFrame, segments: DataFrame) -> DataFrame:
    """Frames with the segment they lie in, both ends included; the clip is the join's key and the range its rest."""
    s = segments.select("clip", F.col("start_frame").alias("s"), F.col("end_frame").alias("e"), *[c for c in segments.columns if c not in ("clip", "start_frame", "end_frame")])
    return frames.join(s, (frames["clip"] == s["clip"]) & frames["frame_idx"].between(s["s"], s["e"])).drop(s["clip"]).withColumnsRenamed({"s": "start_frame", "e": "end_frame"})
