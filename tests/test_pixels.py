"""Pixel kernels against plain loops."""

import importlib
import random

import numpy as np
import pytest

from framequarry.operators import detect, dialogue, pixels


class OnePixel:
    """The background model of one pixel as lists of [weight, variance, mean], heaviest first."""

    def __init__(self, history):
        self.history, self.frames, self.parts = history, 0, []

    def apply(self, value):
        self.frames += 1
        rate = 1 / min(2 * self.frames, self.history)
        background = fitted = False
        total = 0.0
        k = 0
        while k < len(self.parts):
            part = self.parts[k]
            part[0] = (1 - rate) * part[0] - rate * 0.05
            place = k
            if not fitted:
                gap = part[2] - value
                distance = float(gap @ gap)
                background = background or (total < 0.9 and distance < 16 * part[1])
                if distance < 9 * part[1]:
                    fitted = True
                    part[0] += rate
                    step = rate / part[0]
                    part[2] = part[2] - step * gap
                    part[1] = min(max(part[1] + step * (distance - part[1]), 4.0), 75.0)
                    while place and part[0] >= self.parts[place - 1][0]:
                        self.parts[place - 1], self.parts[place] = self.parts[place], self.parts[place - 1]
                        place -= 1
            if part[0] < rate * 0.05:
                self.parts.remove(part)
                continue
            total += part[0]
            k += 1
        for part in self.parts:
            part[0] /= total
        if not fitted:
            if len(self.parts) == 5:
                self.parts.pop()
            for part in self.parts:
                part[0] *= 1 - rate
            self.parts.append([rate if self.parts else 1.0, 15.0, np.array(value, float)])
            place = len(self.parts) - 1
            while place and self.parts[place][0] >= self.parts[place - 1][0]:
                self.parts[place - 1], self.parts[place] = self.parts[place], self.parts[place - 1]
                place -= 1
        return not background


@pytest.mark.parametrize("channels", [1, 3])
def test_background_model(channels):
    rng = np.random.default_rng(channels)
    size, history = 40, 30
    model, plain = pixels.BackgroundModel(size, channels, history), [OnePixel(history) for _ in range(size)]
    base = rng.integers(20, 220, (size, channels))
    moving = wrong = 0
    for t in range(120):
        frame = np.clip(base + rng.integers(-6, 7, base.shape), 0, 255)
        if t % 11 > 7:
            frame[t % size : t % size + 8] = rng.integers(0, 256, frame[t % size : t % size + 8].shape)
        got, want = model.apply(frame.astype(np.uint8)), np.array([p.apply(v.astype(float)) for p, v in zip(plain, frame)])
        moving += want.sum()
        wrong += (got != want).sum()
    assert moving > 100 and wrong <= 0.002 * 120 * size  # single against double precision


def test_still_scene_settles(spark):
    rng = random.Random(1)
    rows = []
    for k in range(40):
        frame = np.full((20, 30), 90, np.uint8) + np.array([[rng.randint(0, 2) for _ in range(30)] for _ in range(20)], np.uint8)
        if k >= 30:
            frame[5:15, 10:22] = 230
        rows += [("a", k, 20, 30, 1, frame.tobytes()), ("b", k, 20, 30, 1, np.full((20, 30), 7, np.uint8).tobytes())]
    got = {(r.clip, r.frame_idx): r.motion for r in pixels.motion_percent(spark.createDataFrame(rows, "clip string, frame_idx int, height int, width int, channels int, data binary")).collect()}
    assert len(got) == 80 and got["a", 0] == 100.0 and max(got["a", k] for k in range(3, 30)) == 0
    assert 15 < got["a", 30] <= 20 and all(got["b", k] == 0 for k in range(1, 40))


def test_opening_and_closing():
    rng = np.random.default_rng(3)
    around = [(y, x) for y, half in zip(range(-2, 3), (0, 2, 2, 2, 0)) for x in range(-half, half + 1)]

    def each(mask, any_or_all):
        h, w = mask.shape
        return np.array([[any_or_all(mask[y + a, x + b] for a, b in around if 0 <= y + a < h and 0 <= x + b < w) for x in range(w)] for y in range(h)])

    for share in (0.2, 0.6, 0.9):
        mask = rng.random((17, 23)) < share
        opened = each(each(mask, all), any)
        assert (pixels.smoothed(mask) == each(each(opened, any), all)).all()


def test_resize_and_patches():
    rng = np.random.default_rng(4)
    image = rng.integers(0, 256, (9, 7, 3)).astype(np.uint8)
    got = pixels.resize(image, 5, 11)
    for i in range(5):
        for j in range(11):
            y, x = (min(max((k + 0.5) * n / m - 0.5, 0), n - 1) for k, n, m in ((i, 9, 5), (j, 7, 11)))
            a, b = int(y), int(x)
            c, d = min(a + 1, 8), min(b + 1, 6)
            want = (image[a, b] * (1 - (y - a)) + image[c, b] * (y - a)) * (1 - (x - b)) + (image[a, d] * (1 - (y - a)) + image[c, d] * (y - a)) * (x - b)
            assert np.abs(got[i, j] * 255 - want).max() <= 0.5 + 1e-4
    assert (pixels.resize(image, 9, 7) == (image / 255).astype(np.float32)).all()
    cut = pixels.patches(image, 3)
    assert cut.shape == (6, 27) and (cut[3] == image[3:6, 3:6].ravel()).all()
    assert (pixels.patches(image[..., 0], 3)[5] == image[6:9, 3:6, 0].ravel()).all()
    assert pixels.resize(np.array([[0.0, 2.0]]), 1, 2).tolist() == [[0.0, 1.0]]


def test_label_text_rounds_exact_values(spark):
    rows = spark.createDataFrame([("cat", 0.125), ("cat", 0.375), ("dog", 0.875), (None, 0.5)], "category string, score double")
    assert [r[0] for r in rows.select(detect.label_text("category", "score")).collect()] == ["cat: 0.12", "cat: 0.38", "dog: 0.88", None]


def test_media_by_key(spark):
    content = "array<struct<type:string,text:string,style:string,image:string,image_url:string,video:string>>"
    rows = spark.createDataFrame([(1, 1, "user", [(None, None, None, "a.png", None, None), ("image", None, None, None, None, None), (None, None, None, None, "http://x", None), ("video", None, None, None, None, "v"), ("text", "hi", None, None, None, None)])], f"conv int, pos int, role string, content {content}")
    prompt = dialogue.render(rows).first().prompt
    assert prompt.startswith("Image 1<|image|>Image 2<|image|>Image 3<|image|><|video|><|im_start|>user\nhi")


def test_only_absent_parts_are_left_out(monkeypatch):
    import __spark_entry__

    assert __spark_entry__._optional("framequarry.llm.nothing_there") is None
    real = importlib.import_module

    def broken(name):
        raise ModuleNotFoundError("No module named 'zstandard'", name="zstandard")

    monkeypatch.setattr(importlib, "import_module", broken)
    with pytest.raises(ModuleNotFoundError):
        __spark_entry__._optional("framequarry.llm.registry")
    monkeypatch.setattr(importlib, "import_module", real)


def test_mask_pixels_and_clamp(spark):
    from pyspark.sql import functions as F

    from framequarry.operators import sampling

    rows = spark.createDataFrame([(0,), (1,), (255,), (None,)], "px int")
    assert detect.mask_pixels(rows).count() == 2
    times = spark.createDataFrame([(-1.0,), (0.5,), (9.0,)], "t double").select(sampling.clamp(F.col("t"), F.lit(0.0), F.lit(2.0), 0.1).alias("t"))
    assert [round(r.t, 6) for r in times.collect()] == [0.1, 0.5, 1.9]
