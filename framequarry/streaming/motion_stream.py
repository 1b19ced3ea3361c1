"""Motion segments of a stream of frames, emitted as soon as they can't change any more."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame


class SegmentTracker:
    """Motion segments of one clip, frame by frame in order; its state is a small JSON text.

    ``push`` takes a frame's motion and returns the segments that no later
    frame can touch; ``finish`` marks the clip's end and returns the rest.
    """

    def __init__(self, fps: float, threshold: float, min_duration: float, buffer: float, gap: float, state: str | None = None):
        self.threshold = threshold
        self.buffer, self.least, self.gap = (int(x * fps) for x in (buffer, min_duration, gap))
        kept = json.loads(state) if state else {}
        self.frame: int = kept.get("frame", 0)  # frames seen
        self.run: list | None = kept.get("run")  # start, sum, frames of the open run
        self.waiting: list = kept.get("waiting", [])  # closed runs whose end may lie beyond the clip's
        self.merged: list | None = kept.get("merged")  # start, end, average of the segment being merged

    def state(self) -> str:
        return json.dumps({"frame": self.frame, "run": self.run, "waiting": self.waiting, "merged": self.merged})

    def _merge(self, run: list, out: list) -> None:
        start, end, mean = run
        if end - start < self.least:
            return
        if self.merged and start - self.merged[1] <= self.gap:
            self.merged = [self.merged[0], max(self.merged[1], end), (self.merged[2] + mean) / 2]
            return
        if self.merged:
            out.append(self.merged)
        self.merged = [start, end, mean]

    def push(self, motion: float) -> list:
        out: list = []
        f = self.frame
        if motion >= self.threshold:
            start, total, n = self.run or [f, 0.0, 0]
            self.run = [start, total + motion, n + 1]
        elif self.run:
            start, total, n = self.run
            self.waiting.append([start, f + self.buffer, total / n])
            self.run = None
        while self.waiting and self.waiting[0][1] <= f:
            self._merge(self.waiting.pop(0), out)
        self.frame += 1
        # a run that may still join starts no earlier than the open or waiting one, or the next frame
        start = self.waiting[0][0] if self.waiting else self.run[0] if self.run else self.frame
        if self.merged and start - self.merged[1] > self.gap:
            out.append(self.merged)
            self.merged = None
        return out

    def finish(self) -> list:
        out: list = []
        last = self.frame - 1
        for start, end, mean in self.waiting:
            self._merge([start, min(last, end), mean], out)
        if self.run:
            start, total, n = self.run
            self._merge([start, last, total / n], out)
        if self.merged:
            out.append(self.merged)
        self.run, self.waiting, self.merged = None, [], None
        return out


OUTPUT = "clip string, start_frame long, end_frame long, start_time double, end_time double, avg_motion double"


def stream_segments(frames: DataFrame, fps: float, threshold: float = 0.5, min_duration: float = 1.0, buffer: float = 1.0, gap: float = 30.0) -> DataFrame:
    """Streaming counterpart of the merged motion segments.

    ``frames`` streams clip (string), frame_idx, motion and is_end; a clip's
    frames must arrive in order across micro-batches, and a row with is_end
    (its motion isn't read) closes the clip and frees its state.
    """
    setting = (fps, threshold, min_duration, buffer, gap)

    def run(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        tracker = SegmentTracker(*setting, state.get[0] if state.exists else None)
        rows = pd.concat(list(batches)).sort_values(["is_end", "frame_idx"])
        found: list = []
        ended = False
        for motion, is_end in zip(rows["motion"], rows["is_end"], strict=True):
            if is_end:
                found += tracker.finish()
                ended = True
            else:
                found += tracker.push(motion)
        if ended:
            state.remove()
        else:
            state.update((tracker.state(),))
        yield pd.DataFrame([(key[0], s, e, s / fps, e / fps, m) for s, e, m in found], columns=["clip", "start_frame", "end_frame", "start_time", "end_time", "avg_motion"])

    return frames.groupBy("clip").applyInPandasWithState(run, OUTPUT, "state string", "append", "NoTimeout")


def session_activity(frames: DataFrame, gap: str, ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Sessions of moving frames by clip: an approximation of merged segments without buffer and least duration.

    Rows at most ``gap`` apart are one session; rows later than ``delay`` are left out.
    """
    from pyspark.sql import functions as F

    moving = frames.withWatermark(ts, delay)
    found = moving.groupBy("clip", F.session_window(ts, gap).alias("session")).agg(F.count("*").alias("n_frames"), F.avg("motion").alias("avg_motion"))
    return found.select("clip", F.col("session.start").alias("start_ts"), F.col("session.end").alias("end_ts"), "n_frames", "avg_motion")
