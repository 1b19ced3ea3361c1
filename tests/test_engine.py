"""Operators against independent sequential models, goldens and boundary cases."""

import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from framequarry.functions import answers
from framequarry.operators import batching, detect, dialogue, motion, sampling, tiling
from framequarry.sources import media
from framequarry.streaming.motion_stream import SegmentTracker, stream_segments


def model_segments(series, fps, threshold, least, buffer, gap):
    """A plain loop over one clip's motions: (start, end, average) after merging."""
    found, start, held = [], None, []
    n = len(series)
    for k, m in enumerate(series):
        if m >= threshold:
            start = k if start is None else start
            held.append(m)
        elif start is not None:
            found.append((start, min(n - 1, k + int(buffer * fps)), sum(held) / len(held)))
            start, held = None, []
    if start is not None:
        found.append((start, n - 1, sum(held) / len(held)))
    merged = []
    for s, e, a in found:
        if e - s < int(least * fps):
            continue
        if merged and s - merged[-1][1] <= int(gap * fps):
            merged[-1] = (merged[-1][0], max(e, merged[-1][1]), (merged[-1][2] + a) / 2)
        else:
            merged.append((s, e, a))
    return merged


def random_clips(seed):
    rng = random.Random(seed)
    clips = {f"c{k}": [rng.choice([0.0, 0.2, 0.5, 0.9]) for _ in range(rng.choice([1, 2, 7, 40, 150]))] for k in range(12)}
    return clips | {"above": [1.0] * 9, "below": [0.0] * 9, "one": [0.5]}


@pytest.mark.parametrize("fps,least,buffer,gap", [(1.0, 2.0, 1.0, 2.0), (10.0, 0.2, 0.3, 0.5), (29.97, 0.1, 0.1, 0.2)])
def test_motion_segments(spark, fps, least, buffer, gap):
    clips = random_clips(int(fps))
    rows = [(c, k, m) for c, series in clips.items() for k, m in enumerate(series)]
    random.Random(1).shuffle(rows)
    got = {}
    for r in motion.motion_segments(spark.createDataFrame(rows, "clip string, frame_idx long, motion double"), fps, 0.5, least, buffer, gap).collect():
        got.setdefault(r.clip, []).append((r.start_frame, r.end_frame, r.avg_motion))
        assert r.start_time == r.start_frame / fps
    for clip, series in clips.items():
        want = model_segments(series, fps, 0.5, least, buffer, gap)
        assert [x[:2] for x in sorted(got.get(clip, []))] == [x[:2] for x in want]
        assert np.allclose([x[2] for x in sorted(got.get(clip, []))], [x[2] for x in want])
        tracker = SegmentTracker(fps, 0.5, least, buffer, gap)
        seen = []
        for m in series:
            seen += tracker.push(m)
            tracker = SegmentTracker(fps, 0.5, least, buffer, gap, tracker.state())
        seen += tracker.finish()
        assert [tuple(x[:2]) for x in seen] == [x[:2] for x in want]
        assert np.allclose([x[2] for x in seen], [x[2] for x in want])


def test_one_exchange_by_clip(spark):
    frames = spark.range(100).select((F.col("id") % 3).cast("string").alias("clip"), F.col("id").alias("frame_idx"), F.lit(1.0).alias("motion"))
    plan = motion.motion_segments(frames, 1.0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_stream_equals_batch(spark, tmp_path):
    clips = random_clips(3)
    for part in range(3):
        rows = [(c, k, m, False) for c, series in clips.items() for k, m in enumerate(series) if k % 3 >= 0 and k * 3 // len(series) == part]
        rows += [(c, len(series), 0.0, True) for c, series in clips.items()] if part == 2 else []
        spark.createDataFrame(rows, "clip string, frame_idx long, motion double, is_end boolean").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("clip string, frame_idx long, motion double, is_end boolean").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = stream_segments(stream, 1.0, 0.5, 2.0, 1.0, 2.0).writeStream.format("memory").queryName("segments").outputMode("append").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = sorted((r.clip, r.start_frame, r.end_frame) for r in spark.table("segments").collect())
    assert got == sorted((c, s, e) for c, series in clips.items() for s, e, _ in model_segments(series, 1.0, 0.5, 2.0, 1.0, 2.0))


def test_manifest_and_frames(spark):
    segments = spark.createDataFrame([("a", 2, 4, 2.0, 4.0), ("a", 9, 9, 9.0, 9.0)], "clip string, start_frame long, end_frame long, start_time double, end_time double")
    rows = motion.clip_manifest(segments).orderBy("segment_no").collect()
    assert [r.file_name for r in rows] == ["a_motion_001.mp4", "a_motion_002.mp4"] and rows[0].duration == 2.0
    frames = spark.range(12).select(F.lit("a").alias("clip"), F.col("id").alias("frame_idx"))
    assert sorted(r.frame_idx for r in motion.frames_in_segments(frames, segments).collect()) == [2, 3, 4, 9]


def test_motion_percent(spark):
    rows = spark.createDataFrame([("a", [0, 1, 2, 0]), ("b", [])], "clip string, mask array<int>")
    assert {r.clip: r.p for r in rows.select("clip", motion.mask_percent(F.col("mask")).alias("p")).collect()} == {"a": 50.0, "b": None}


def test_detections(spark):
    images = spark.createDataFrame([("a.b.jpg", [[0.0, 0.0, 10.0, 20.0], [5.0, 5.0, 6.0, 9.0]], [2, 9], [0.4, 0.9]), ("none.png", [], [], [])], "image string, xyxy array<array<double>>, class_id array<int>, score array<double>")
    rows = detect.explode_detections(images)
    assert rows.count() == 2 and [r.class_id for r in detect.filter_detections(rows, 0.4, detect.TRAFFIC_CLASSES).collect()] == [2]
    classes = spark.createDataFrame([(9,)], "class_id int")
    assert [r.class_id for r in detect.filter_detections(rows, 0.4, classes).collect()] == [9]
    assert detect.filter_detections(rows, 0.5).count() == 1
    labels = detect.label_files(rows.select("image", "det_ix", "class_id", *(c.alias(k) for k, c in detect.normalized_box(F.lit(80), F.lit(3)).items()))).collect()
    assert len(labels) == 1 and labels[0].file_name == "a.b.txt"
    assert labels[0].text == "\n".join("%d %.6f %.6f %.6f %.6f" % x for x in [(2, 5 / 80, 10 / 3, 10 / 80, 20 / 3), (9, 5.5 / 80, 7 / 3, 1 / 80, 4 / 3)])
    one = spark.range(1)
    assert [one.select(detect.size_hint(F.lit(p))).first()[0] for p in ("x-m-l", "x-n-m", "x", "y-m")] == ["l", "n", "s", "m"]
    assert [one.select(detect.label_name(F.lit(p))).first()[0] for p in ("a.jpg", ".hidden", "x.tar.gz", "plain")] == ["a.txt", ".hidden.txt", "x.tar.txt", "plain.txt"]
    named = detect.ontology_lookup(spark.createDataFrame([("p",), ("q",), (None,)], "prompt string"), {"p": "person"})
    assert [r.class_name for r in named.collect()] == ["person", None, None]


def test_detector_plug_in(spark):
    def factory():
        return lambda image, content, conf: None if image == "bad" else ([[0, 0, 1, 1], [0, 0, 2, 2]], [1, 2], [0.3, 0.8])

    rows = detect.predict(spark.createDataFrame([("a", bytearray(b"1")), ("bad", bytearray(b"2"))], "image string, content binary"), factory, 0.4)
    assert [(r.image, r.det_ix, r.class_id) for r in rows.collect()] == [("a", 1, 2)]


def test_answers(spark):
    texts = ['<point x="10.5" y="20">', "x=1", 'max="5" y=7', "x= y=", "", None, "y=3 x=4."]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(answers.parse_point(F.col("t")).alias("p")).collect()
    assert [(r.p.found, r.p.coordinates and tuple(r.p.coordinates)) for r in rows] == [(True, (10.5, 20.0)), (False, None), (True, (5.0, 7.0)), (False, None), (False, None), (False, None), (True, (4.0, 3.0))]
    counts = spark.createDataFrame([("1,200",), ("none",), ("-7 and 8",), ("9" * 30,)], "t string").select(answers.parse_count(F.col("t")).alias("n")).collect()
    assert [r.n for r in counts] == [1, None, 7, None]
    prompts = spark.createDataFrame([("point",), ("ocr",), ("what",)], "t string").select(answers.task_prompt(F.col("t"), F.lit("bus")).alias("p")).collect()
    assert [r.p for r in prompts] == ["Point to the bus in the image.", "Read all text visible in this image.", None]


def model_tracks(text, w, h):
    for tag in re.finditer(answers.COORDS_PATTERN, text):
        for group in re.finditer(answers.FRAME_PATTERN, tag.group(1)):
            for idx, x, y in re.findall(answers.POINT_PATTERN, group.group(2)):
                x, y = int(x) / 1000 * w, int(y) / 1000 * h
                if 0 <= x <= w and 0 <= y <= h:
                    yield float(group.group(1)), idx, x, y


def test_tracks(spark):
    texts = ['<points coords="1.5 1 100 200 2 1000 1000;2 1 050 12"/> x <tracks id=3 coords="7 4 999 1001 5 123 456">', "nothing", '<points coords="1 1 10 20">']
    rows = answers.parse_tracks(spark.createDataFrame([(k, t, 640, 480) for k, t in enumerate(texts)], "id int, text string, image_w int, image_h int")).orderBy("id", "tag_no", "group_no", "point_no").collect()
    for k, text in enumerate(texts):
        assert np.allclose([(r.t, r.x, r.y) for r in rows if r.id == k] or np.empty((0, 3)), [(t, x, y) for t, _, x, y in model_tracks(text, 640, 480)] or np.empty((0, 3)))
    several = spark.createDataFrame([(0, '<points coords="2 1 500 500">', [10, 20], [30, 40])], "id int, text string, image_w array<int>, image_h array<int>")
    assert [(r.t, r.x, r.y) for r in answers.parse_tracks(several).collect()] == [(2, 10.0, 20.0)]


def model_frames(total, fps, num, max_fps):
    if max_fps is not None and total <= 2:
        return np.arange(total).astype(int)
    if max_fps is None or total / fps > (num - 1) / max_fps:
        return np.linspace(0, total - 1, num=min(num, total)).astype(int)
    at = np.arange(0.0, total - 1, fps / max_fps)
    return np.round(np.append(at, total - 1) if np.round(at[-1]) != total - 1 else at).astype(int)


def test_uniform_frames(spark):
    rng = random.Random(5)
    cases = [(rng.randint(1, 4000), rng.choice([10.0, 25.0, 29.97, 59.94]), rng.choice([1, 2, 8, 64])) for _ in range(150)] + [(1, 25.0, 8), (2, 25.0, 8), (3, 25.0, 8)]
    rows = spark.createDataFrame(cases, "n int, fps double, num int")
    for max_fps in (2.0, None):
        for r in rows.select("*", sampling.sample_frames_uniform(F.col("n"), F.col("fps"), F.col("num"), max_fps).alias("x")).collect():
            assert r.x == model_frames(r.n, r.fps, r.num, max_fps).tolist(), (r.n, r.fps, r.num, max_fps)


def test_fps_sampling(spark):
    one = spark.range(1)
    options = lambda v, s: one.select(sampling.candidate_fps(F.lit(v), F.lit(s))).first()[0]
    assert options(6, 2) == [2.0, 6.0] and options(5, 1) == [1.0, 5.0] and options(2, 2) == [2.0]
    for bad in ((5, 2), (0, 1), (29.97, 2)):
        with pytest.raises(Exception, match="sampling_fps"):
            options(*bad)
    frames = lambda fps, total, num, s: one.select(sampling.sample_frames_fps(F.lit(fps), F.lit(total), F.lit(num), F.lit(s))).first()[0]
    assert frames(24.0, 100, 16, 2.0) == list(range(0, 100, 6))[:16]
    assert frames(24.0, 1000, 16, 2.0) == list(range(0, 1000, 12))[:16]  # the tail is lost
    times = lambda d, num, **x: one.select(sampling.sample_times(F.lit(d), F.lit(24.0), F.lit(num), **x)).first()[0]
    assert np.allclose(times(10.0, 5), np.linspace(0, 10, 5)) and np.allclose(times(2.0, 9, max_fps=2.0), [0, 0.5, 1, 1.5, 2])
    assert np.allclose(times(3.0, 10, mode="fps", sampling_fps=F.lit(2.0)), np.arange(10)[:6] / 2)
    with pytest.raises(NotImplementedError):
        times(1.0, 2, mode="other")


def test_times_to_frames(spark):
    ends = {"a": [0.5, 1.0, 1.5, 2.0], "b": [3.0]}
    asks = {"a": [0.0, 0.5, 0.99, 1.99, 2.0, 9.0], "b": [0.0, 3.0]}
    frames = spark.createDataFrame([(c, k, e) for c, x in ends.items() for k, e in enumerate(x)], "clip string, frame_idx long, end double")
    rows = sampling.times_to_frames(spark.createDataFrame([(c, t) for c, x in asks.items() for t in x], "clip string, t double"), frames).collect()
    want = {(c, t): min(int(np.searchsorted(ends[c], t, "right")), len(ends[c]) - 1) for c, x in asks.items() for t in x}
    assert {(r.clip, r.t): r.frame_idx for r in rows} == want


def model_tiling(h, w, window=266, crops=8):
    options = sorted(((i, j) for i in range(1, 9) for j in range(1, 9) if i * j <= crops), key=lambda x: (x[0] * x[1], x[0]))
    with np.errstate(divide="ignore"):
        scale = (np.array(options, np.int32) * window).astype(np.float32) / np.array([h, w], np.float32)
    scale = scale.min(axis=1)
    return options[int(scale.argmax() if (scale < 1).all() else np.where(scale < 1, np.float32(1e10), scale).argmin())]


def test_tiling(spark):
    rng = random.Random(2)
    sizes = [(rng.randint(20, 4000), rng.randint(20, 4000)) for _ in range(300)] + [(720, 1280), (1280, 720), (480, 640), (378, 378), (300, 2400), (112, 112), (112, 500), (60, 900), (60, 60)]
    rows = spark.createDataFrame(sizes, "h int, w int").select("*", tiling.select_tiling(F.col("h"), F.col("w")).alias("t")).select("*", tiling.image_grid(F.col("t")).alias("g"))
    found = {(r.h, r.w): r for r in rows.select("*", tiling.token_count(F.col("g")).alias("n"), tiling.patch_tokens(F.col("g")).alias("p")).collect()}
    for h, w in sizes:
        assert tuple(found[h, w].t) == model_tiling(h - 112, w - 112)
    golden = {(720, 1280): ((2, 4), (23, 42), 1203, 1162), (1280, 720): ((4, 2), (42, 23), 1222, 1162), (480, 640): ((2, 2), (23, 23), 766, 725), (378, 378): ((1, 1), (14, 14), 424, 392), (300, 2400): ((1, 8), (14, 80), 1348, 1316)}
    for size, (t, g, n, p) in golden.items():
        r = found[size]
        assert (tuple(r.t), (r.g.h, r.g.w), r.n, r.p) == (t, g, n, p)


def model_pooling(rows, cols):
    """Patch numbers laid out crop by crop, overlaps cut, then pooled two by two."""
    image = np.full((rows * 19 + 8, cols * 19 + 8), -1)
    for i in range(rows):
        for j in range(cols):
            own = np.arange(729).reshape(27, 27) + (i * cols + j) * 729
            top, left, bottom, right = 4 * (i > 0), 4 * (j > 0), 27 - 4 * (i < rows - 1), 27 - 4 * (j < cols - 1)
            image[i * 19 + top : i * 19 + bottom, j * 19 + left : j * 19 + right] = own[top:bottom, left:right]
    assert (image >= 0).all()
    out = []
    for grid in (np.arange(729).reshape(27, 27), image + 729):
        h, w = (-(-n // 2) * 2 for n in grid.shape)
        padded = np.full((h, w), -1)
        padded[(h - grid.shape[0]) // 2 :, (w - grid.shape[1]) // 2 :][: grid.shape[0], : grid.shape[1]] = grid
        out += padded.reshape(h // 2, 2, w // 2, 2).transpose(0, 2, 1, 3).reshape(-1, 4).tolist()
    return out


def test_pooling_and_strings(spark):
    tilings = [(1, 1), (2, 3), (4, 2)]
    rows = spark.createDataFrame([((r, c),) for r, c in tilings], "t struct<rows:int,cols:int>")
    for r in rows.select("t", tiling.image_pooling(F.col("t")).alias("p"), tiling.image_tokens(tiling.image_grid(F.col("t"))).alias("s"), tiling.crop_rectangles(F.col("t")).alias("c")).collect():
        assert r.p == model_pooling(*r.t)
        assert r.s.count("<im_patch>") == len(r.p) and r.s.startswith("<low_res_im_start><im_patch>") and len(r.c) == r.t[0] * r.t[1]
    video = spark.range(1).select(tiling.video_string(F.array(F.lit(0.0), F.lit(0.25), F.lit(0.35)), F.lit(1), F.lit(2))).first()[0]
    assert video == " ".join(f"{t:.1f} <frame_start><im_patch><im_patch><frame_end>" for t in (0.0, 0.25, 0.35))


def test_dialogue(spark):
    text = lambda t, style=None: {"type": "text", "text": t, "style": style}
    talks = {
        1: [("user", [{"type": "image", "text": None, "style": None}, text("What?", "user_qa")]), ("assistant", [text("A bus.")]), ("USER", [text("Sure?", "odd"), text("Yes")])],
        2: [("subtitle", [text("subs")]), ("user", [{"type": "image", "text": None, "style": None}] * 2 + [text("Hi")])],
        3: [("system", [text("x")]), ("user", [text("y")])],
        4: [("user", [{"type": "video", "text": None, "style": None}, text("v")]), ("user", [text("again")])],
    }
    rows = [(c, k, role, content) for c, turns in talks.items() for k, (role, content) in enumerate(turns)]
    frame = spark.createDataFrame(rows, "conv int, pos int, role string, content array<struct<type:string,text:string,style:string>>")
    got = {r.conv: (r.prompt, r.valid) for r in dialogue.render(frame).collect()}
    assert got[1] == ("<|image|><|im_start|>user\nWhat?<|im_end|>\n <|im_start|>assistant\nA bus.<|im_end|>\n<|im_start|>user\nodd: Sure? Yes<|im_end|>\n", True)
    assert got[2] == ("Image 1<|image|>Image 2<|image|>subs<|im_start|>user\nHi<|im_end|>\n", True)
    assert got[3] == (None, False) and got[4] == (None, False)
    with pytest.raises(Exception, match="alternate"):
        dialogue.render(frame, strict=True).collect()


def test_batching(spark):
    images = spark.createDataFrame([(0, 0, 2), (0, 1, 5), (1, 0, 1)], "example int, image_ix int, num_crops int")
    assert [(r.example, r.patch_offset) for r in batching.image_offsets(images, 10).orderBy("example", "image_ix").collect()] == [(0, 0), (0, 20), (1, 0)]
    totals = batching.with_padding(batching.example_totals(images, F.lit(3)), "n_crops").orderBy("example").collect()
    assert [(r.n_images, r.n_crops, r.n_pooled, r.padded_to, r.padding) for r in totals] == [(2, 7, 6, 7, 0), (1, 1, 3, 7, 6)]
    assert batching.repeat_rows(spark.createDataFrame([(1, 2), (2, 0)], "k int, n int"), "n").count() == 2
    patches = spark.createDataFrame([(0, [1.0, 3.0]), (1, [3.0, 5.0])], "patch int, features array<double>")
    pools = spark.createDataFrame([(0, [0, 1, -1]), (1, [-1, -1, -1])], "token int, idx array<int>")
    means = lambda masked: {(r.token, r.pos): r.value for r in batching.pool_features(pools, patches, masked=masked).collect()}
    assert means(True) == {(0, 0): 2.0, (0, 1): 4.0, (1, 0): 0.0, (1, 1): 0.0}
    assert means(False) == {(0, 0): 4 / 3, (0, 1): 8 / 3, (1, 0): 0.0, (1, 1): 0.0}
    one = spark.range(1)
    assert one.select(batching.merge_kind(F.lit(2), F.lit(0))).first()[0] == "image"
    with pytest.raises(Exception, match="same time"):
        one.select(batching.merge_kind(F.lit(2), F.lit(1))).collect()


def test_scatter_and_bos(spark):
    tokens = spark.createDataFrame([(0, 0, 7, 1.0), (0, 1, 9, 1.0), (0, 2, 9, 1.0)], "sequence int, pos int, id int, value double")
    features = spark.createDataFrame([(0, 0, 10.0), (0, 1, 20.0)], "sequence int, ordinal long, value double")
    assert [r.value for r in batching.scatter_add(tokens, features, 9).orderBy("pos").collect()] == [1.0, 11.0, 21.0]
    with pytest.raises(Exception, match="differ"):
        batching.scatter_add(tokens, features.limit(1), 9).collect()
    rows = [("x", [0, 5, 6], [0, 1, 1]), ("x", [1, 5, 6], [1, 1, 1]), ("y", [0, 1, 6], [0, 1, 1]), ("z", [], [])]
    got = batching.insert_bos(spark.createDataFrame(rows, "batch string, input_ids array<int>, attention_mask array<int>"), 1, 0).orderBy("batch", "input_ids").collect()
    assert [(r.input_ids, r.attention_mask) for r in got] == [([0, 1, 5, 6], [0, 1, 1, 1]), ([1, 1, 5, 6], [1, 1, 1, 1]), ([0, 1, 6], [0, 1, 1]), ([1], [1])]
    texts = spark.createDataFrame([(1, "a<|image|>b<|image|>c"), (2, "none")], "example int, text string")
    grids = spark.createDataFrame([(1, 0, "[0]")], "example int, ordinal int, tokens string")
    assert [r.text for r in batching.expand_placeholders(texts, grids, "<|image|>").orderBy("example").collect()] == ["a[0]b<|image|>c", "none"]
    with pytest.raises(Exception, match="placeholders"):
        batching.expand_placeholders(texts, spark.createDataFrame([(2, 0, "[0]")], "example int, ordinal int, tokens string"), "<|image|>").collect()


def fake_frames(path):
    if "bad" in path:
        raise OSError(path)
    yield from ((2, 2, bytes([k])) for k in range(3))


def test_media(spark, tmp_path):
    for name in ("a.JPG", "b.png", "c.txt"):
        (tmp_path / name).write_bytes(name.encode())
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "d.png").write_bytes(b"d")
    files = media.list_media(spark, str(tmp_path), with_content=True)
    assert sorted(r.path.rsplit("/", 1)[1] for r in files.collect()) == ["a.JPG", "b.png"]
    decoded = media.decode_images(files, lambda: lambda data: (1, len(data), 3, data) if data != b"b.png" else None).collect()
    assert [(r.height, r.width) for r in decoded] == [(1, 5)]
    spark.dataSource.register(media.FrameSource)
    read = lambda *paths: spark.read.format("frames").option("paths", json.dumps(paths)).option("decoder", "no_such_module:f,tests.test_engine:fake_frames").load()
    assert [(r.clip, r.frame_idx) for r in read("x").orderBy("frame_idx").collect()] == [("x", 0), ("x", 1), ("x", 2)]
    headers = media.video_header(spark.createDataFrame([(0.0, 10), (25.0, 50)], "fps double, total_frames int")).collect()
    assert [r.duration for r in headers] == [0.0, 2.0]
    routes = spark.createDataFrame([("https://youtu.be/x",), ("http://h/v.mp4",), ("/a/b.mp4",), (None,)], "v string").select(media.video_route(F.col("v")).alias("r")).collect()
    assert [r.r for r in routes] == ["youtube", "http", "file", None]
    one = spark.range(1)
    assert one.select(media.model_id(F.lit("s"), {"s": "small"}), media.model_id(F.lit("z"), {"s": "small"})).first()[:] == ("small", "z")
    path = lambda kind, name=None: one.select(media.model_path(F.lit(kind), F.lit(name).cast("string"), {"det": "/m/d", "vlm": "/m/v"}, {"det": "base.pt", "vlm": None})).first()[0]
    assert (path("det"), path("det", "x.pt"), path("vlm")) == ("/m/d/base.pt", "/m/d/x.pt", "/m/v")
    with pytest.raises(Exception, match="unknown model type"):
        path("other")
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "name string")
    assert media.all_present(names("a", "b"), names("a")).first()[0] is False and media.all_present(names("a"), names("a", "a")).first()[0] is True
    assert [r.name for r in media.missing_models(names("a", "b"), names("a")).collect()] == ["b"]
    written = media.write_text_files(spark.createDataFrame([("x.txt", "hello")], "file_name string, text string"), f"file://{tmp_path}/out").collect()
    assert (tmp_path / "out" / "x.txt").read_text() == "hello" and written[0].bytes == 5
    frames = spark.createDataFrame([("c.mp4", 1, bytearray(b"b")), ("c.mp4", 0, bytearray(b"a"))], "file_name string, frame_idx long, data binary")
    done = media.write_clips(frames, lambda x: b"".join(map(bytes, x)), f"file://{tmp_path}/clips").collect()
    assert (tmp_path / "clips" / "c.mp4").read_bytes() == b"ab" and done[0].n_frames == 2
