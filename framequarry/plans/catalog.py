"""Registered queries of the engine over the given tables, with DuckDB counterparts.

The tables hold no media, so they stand in for them: ``events`` by user are
clips of frames, ``lineitem`` by order are detections of an image, ``part``
gives image sizes, ``conversations`` dialogues, ``documents`` answers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framequarry.functions import answers
from framequarry.operators import batching, detect, dialogue, motion, pixels, sampling, tiling
from framequarry.sources import media

Query = Callable[[SparkSession, str], DataFrame]

#: Parameters of the motion queries.
FPS, THRESHOLD, LEAST, BUFFER, GAP = 1.0, 60.0, 2.0, 1.0, 2.0
#: The lookup that prompts go through, the classes kept, and the registry.
ONTOLOGY = {"view": "person", "click": "vehicle", "purchase": "aircraft"}
KEPT_EVENTS = ("view", "click", "purchase")
REGISTRY = {"Supplier#000000001": "detector-small", "Supplier#000000002": "detector-large", "Supplier#000000003": "segmenter"}
END_TOKEN = 7


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return _table(spark, sf_dir, "events").select(F.col("user_id").alias("clip"), (F.row_number().over(order) - 1).cast("long").alias("frame_idx"), F.col("value").alias("motion"))


FRAMES_SQL = "f AS (SELECT user_id AS clip, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_idx, value AS motion FROM events)"
RUNS_SQL = f"""{FRAMES_SQL},
n AS (SELECT *, count(*) OVER (PARTITION BY clip) AS n FROM f),
m AS (SELECT *, frame_idx - row_number() OVER (PARTITION BY clip ORDER BY frame_idx) AS island FROM n WHERE motion >= {THRESHOLD}),
i AS (SELECT clip, island, min(frame_idx) AS s, max(frame_idx) + 1 AS b, avg(motion) AS a, any_value(n) AS n FROM m GROUP BY clip, island),
r AS (SELECT clip, s, CASE WHEN b = n THEN n - 1 ELSE least(n - 1, b + {int(BUFFER * FPS)}) END AS e, a FROM i),
runs AS (SELECT * FROM r WHERE e - s >= {int(LEAST * FPS)})"""
SEGMENTS_SQL = f"""{RUNS_SQL},
o AS (SELECT *, CASE WHEN s - lag(e) OVER (PARTITION BY clip ORDER BY s) <= {int(GAP * FPS)} THEN 0 ELSE 1 END AS opens FROM runs),
g AS (SELECT *, sum(opens) OVER (PARTITION BY clip ORDER BY s) AS grp FROM o),
seg AS (SELECT clip, min(s) AS s, max(e) AS e, list_reduce(list(a ORDER BY s), lambda x, y: (x + y) / 2) AS a, count(*) AS k FROM g GROUP BY clip, grp)"""


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return motion.motion_runs(_frames(spark, sf_dir), FPS, THRESHOLD, LEAST, BUFFER)


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return motion.merge_segments(_runs(spark, sf_dir), GAP)


def q01_motion_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir).withColumn("avg_motion", F.col("avg_motion").cast("float"))


def q02_motion_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs(spark, sf_dir).select("clip", "start_frame", "end_frame", F.round("avg_motion", 6).alias("avg_motion"))


def q03_detection_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return detect.filter_detections(events, 40.0, KEPT_EVENTS, "value", "event_type").select("event_id", "user_id", "event_type", "value")


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    x1, y1 = F.col("l_quantity") * 10, F.col("l_tax") * 1000
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("image"),
        F.col("l_linenumber").alias("class_id"),
        x1.alias("x1"),
        y1.alias("y1"),
        (x1 + F.col("l_linenumber") * 8).alias("x2"),
        (y1 + F.col("l_discount") * 500).alias("y2"),
        (1 - F.col("l_discount") * 8).alias("score"),
    )


BOXES_SQL = "b AS (SELECT l_orderkey AS image, l_linenumber AS class_id, l_quantity * 10 AS x1, l_tax * 1000 AS y1, l_quantity * 10 + l_linenumber * 8 AS x2, l_tax * 1000 + l_discount * 500 AS y2, 1 - l_discount * 8 AS score FROM lineitem)"


def q04_bbox_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = detect.normalized_box(F.lit(1280), F.lit(720))
    return _boxes(spark, sf_dir).select("image", "class_id", *(F.round(c, 9).alias(k) for k, c in box.items()))


def q05_motion_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = _table(spark, sf_dir, "events").select("user_id", (F.col("value") >= 50).cast("int").alias("px"))
    return motion.motion_percent(pixels, ["user_id"]).withColumn("motion", F.round("motion", 6))


def q06_detections_per_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.detections_per_image(detect.filter_detections(_boxes(spark, sf_dir), 0.4, detect.TRAFFIC_CLASSES))


def q07_ontology_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("prompt"))
    return detect.ontology_lookup(events, ONTOLOGY)


def _clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("clip")).agg(F.count(F.lit(1)).alias("n"))


def _exploded(rows: DataFrame, values: Column, name: str) -> DataFrame:
    return rows.select("clip", F.posexplode(values).alias("ordinal", name))


def q08_sample_uniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exploded(_clips(spark, sf_dir), sampling.sample_frames_uniform(F.col("n"), F.lit(29.97), F.lit(32), 8.0), "frame_idx")


def q09_sample_fps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exploded(_clips(spark, sf_dir), sampling.sample_frames_fps(F.lit(24.0), F.col("n"), F.lit(16), F.lit(2.0)), "frame_idx")


def q10_time_to_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    origin = F.unix_seconds(F.lit("2024-01-01").cast("timestamp"))
    ends = _table(spark, sf_dir, "events").select(F.col("user_id").alias("clip"), (F.row_number().over(order) - 1).cast("long").alias("frame_idx"), (F.unix_seconds(F.col("ts").cast("timestamp")) - origin).cast("double").alias("end"))
    clips = ends.groupBy("clip").agg(F.max("end").alias("duration"))
    times = clips.select("clip", F.explode(sampling.sample_times(F.col("duration"), F.lit(1.0), F.lit(9))).alias("t"))
    return sampling.times_to_frames(times, ends).withColumn("t", F.round("t", 3))


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    h = F.when(size == 1, 112).when(size == 2, 60).when(size == 3, 378).otherwise(size * 37 + F.col("p_partkey") % 113)
    w = F.when(size == 1, 500).when(size == 2, 900).when(size == 3, 378).otherwise((51 - size) * 41 + F.col("p_partkey") % 97)
    return _table(spark, sf_dir, "part").select("p_partkey", h.cast("int").alias("h"), w.cast("int").alias("w"))


SIZES_SQL = """z AS (SELECT p_partkey,
  CAST(CASE p_size WHEN 1 THEN 112 WHEN 2 THEN 60 WHEN 3 THEN 378 ELSE p_size * 37 + p_partkey % 113 END AS INTEGER) AS h,
  CAST(CASE p_size WHEN 1 THEN 500 WHEN 2 THEN 900 WHEN 3 THEN 378 ELSE (51 - p_size) * 41 + p_partkey % 97 END AS INTEGER) AS w FROM part)"""
TILING_SQL = f"""{SIZES_SQL},
c AS (SELECT i.i AS i, j.j AS j FROM range(1, 9) i(i), range(1, 9) j(j) WHERE i.i * j.j <= 8),
s AS (SELECT p_partkey, h, w, i, j, least(CASE WHEN h = 112 THEN 'Infinity'::FLOAT ELSE (i * 266)::FLOAT / (h - 112)::FLOAT END, CASE WHEN w = 112 THEN 'Infinity'::FLOAT ELSE (j * 266)::FLOAT / (w - 112)::FLOAT END) AS scale FROM z, c),
k AS (SELECT *, max(scale) OVER (PARTITION BY p_partkey) < 1 AS down FROM s),
t AS (SELECT p_partkey, h, w, CAST(i AS INTEGER) AS tile_rows, CAST(j AS INTEGER) AS tile_cols FROM k WHERE down OR scale >= 1 QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY CASE WHEN down THEN -scale ELSE scale END, i * j, i) = 1)"""


def _tiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sizes(spark, sf_dir).withColumn("tiling", tiling.select_tiling(F.col("h"), F.col("w")))


def q11_select_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tiled(spark, sf_dir).select("p_partkey", "h", "w", F.col("tiling.rows").alias("tile_rows"), F.col("tiling.cols").alias("tile_cols"))


def q12_token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = _tiled(spark, sf_dir).withColumn("grid", tiling.image_grid(F.col("tiling")))
    return grid.select(
        "p_partkey",
        F.col("grid.h").alias("grid_h"),
        F.col("grid.w").alias("grid_w"),
        (F.col("tiling.rows") * F.col("tiling.cols") + 1).alias("n_crops"),
        tiling.token_count(F.col("grid")).alias("n_tokens"),
        tiling.patch_tokens(F.col("grid")).alias("n_patch_tokens"),
        F.md5(tiling.image_tokens(F.col("grid")).cast("binary")).alias("tokens_md5"),
    )


def q12b_pooling_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tilings = _tiled(spark, sf_dir).select("tiling").distinct()
    windows = tilings.select("tiling", F.posexplode(tiling.image_pooling(F.col("tiling"))).alias("token", "idx"))
    return windows.select(F.col("tiling.rows").alias("tile_rows"), F.col("tiling.cols").alias("tile_cols"), "token", F.posexplode("idx").alias("pos", "patch"))


def q12c_crop_rectangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tiled(spark, sf_dir).select("p_partkey", F.inline(tiling.crop_rectangles(F.col("tiling"))))


def q13_render_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.render(_table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text", add_generation_prompt=True)


def q13b_task_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = F.array(*(F.lit(x) for x in (*answers.PROMPTS, "none")))
    events = _table(spark, sf_dir, "events").select("event_id", F.get(tasks, (F.col("event_id") % 6).cast("int")).alias("task"), "event_type")
    return events.select("event_id", "task", answers.task_prompt(F.col("task"), F.col("event_type")).alias("prompt"))


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = (F.col("l_quantity") * 2).cast("int").cast("string"), (F.col("l_partkey") % 1000).cast("string")
    forms = (F.concat(F.lit('<point x="'), x, F.lit('.5" y="'), y, F.lit('">')), F.concat(F.lit("x="), x), F.concat(F.lit('max="'), x, F.lit('" y='), y), F.lit("x= y= none"), F.concat(F.lit("y="), y, F.lit(" x="), x, F.lit(".25")))
    text = F.get(F.array(*forms), (F.col("l_suppkey") % 5).cast("int"))
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", text.alias("response"))


def q14_parse_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _responses(spark, sf_dir).withColumn("p", answers.parse_point(F.col("response")))
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("p.found").alias("found"), F.col("p.coordinates.x").alias("x"), F.col("p.coordinates.y").alias("y"))


def q15_parse_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", answers.parse_count(F.col("text")).alias("n"))


def q16_parse_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, two, three = F.col("o_orderkey"), (F.col("o_orderkey") % 90 + 10).cast("string"), lambda m: (F.col("o_orderkey") * m % 1300 + 100).cast("string")
    points = lambda a, b: F.concat(F.lit("1 "), three(a), F.lit(" "), three(b), F.lit(" 2 "), three(b), F.lit(" "), three(a), F.lit(" 3 "), two, F.lit(" "), two)
    text = F.concat(F.lit('Here <tracks coords="'), (k % 7).cast("string"), F.lit(".5 "), points(3, 7), F.lit(";"), (k % 5 + 8).cast("string"), F.lit(" "), points(11, 13), F.lit('"/> and <points coords="1 1 '), three(17), F.lit(" "), three(19), F.lit('"> end'))
    rows = _table(spark, sf_dir, "orders").select(k.alias("id"), text.alias("text"), F.lit(1280).alias("image_w"), F.lit(720).alias("image_h"))
    found = answers.parse_tracks(rows)
    return found.select("id", "tag_no", "group_no", "point_no", "t", "idx", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def _ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("example"), (F.row_number().over(order) - 1).alias("image_ix"), F.col("l_linenumber").alias("num_crops"), (196 + F.col("l_linenumber") * F.col("l_quantity")).cast("long").alias("pooled"))


def q17_ragged_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = _ragged(spark, sf_dir)
    offsets = batching.image_offsets(images, 729).groupBy("example").agg(F.max("patch_offset").alias("last_offset"))
    totals = batching.with_padding(batching.example_totals(images, F.col("pooled")), "n_crops")
    return totals.join(offsets, "example")


def q17b_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("ids"))
    return ids.select("l_orderkey", batching.images_in_tokens(F.col("ids"), END_TOKEN).alias("n_images"), batching.has_token(F.col("ids"), END_TOKEN).alias("has_end"), F.size(F.filter(batching.token_flags(F.col("ids"), 1, 2), lambda x: x)).alias("n_flagged"))


def q18_masked_mean_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").where("vec_id is not null")
    numbered = vectors.select("label", F.col("vec_id").cast("int").alias("vec_id"), (F.col("vec_id") % 40).alias("part"))
    pools = numbered.groupBy(F.concat_ws(":", "label", "part").alias("token")).agg(F.concat(F.array_sort(F.collect_list("vec_id")), F.array(F.lit(-1))).alias("idx"))
    patches = vectors.select(F.col("vec_id").cast("int").alias("patch"), F.transform("embedding", lambda x: x.cast("double")).alias("features"))
    return batching.pool_features(pools, patches).select("token", "pos", F.round("value", 6).alias("value"))


def q18b_rescale(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = F.array((F.col("l_quantity") * 5).alias("p"), F.col("l_linenumber").cast("double") * 30)
    rows = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", batching.rescale(pixels).alias("v"))
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.round(F.col("v")[0], 6).alias("a"), F.round(F.col("v")[1], 6).alias("b"))


def q19_placeholders_and_bos(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    chat = turns.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: F.concat(x["role"], F.lit("<|image|>"))), " ").alias("text"))
    grids = turns.where("turn < 2").select("conv_id", F.col("turn").alias("ordinal"), F.concat(F.lit("["), F.col("turn").cast("string"), F.lit("]")).alias("tokens"))
    filled = batching.expand_placeholders(chat, grids, "<|image|>", "conv_id", "text")
    n = F.size(F.split("text", " ")).cast("int")
    padded = filled.select("conv_id", "text", (F.col("conv_id") % 10).alias("batch"), F.concat(F.array_repeat(F.lit(0), (F.col("conv_id") % 4).cast("int")), F.sequence(F.lit(5), n + 4)).alias("input_ids"), F.concat(F.array_repeat(F.lit(0), (F.col("conv_id") % 4).cast("int")), F.array_repeat(F.lit(1), n)).alias("attention_mask"))
    with_bos = batching.insert_bos(padded, 1, 0)
    return with_bos.select("conv_id", "text", "bos_present", F.array_join(F.transform("input_ids", lambda x: x.cast("string")), ",").alias("input_ids"), F.array_join(F.transform("attention_mask", lambda x: x.cast("string")), ",").alias("attention_mask"))


def q20_registry_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = _table(spark, sf_dir, "supplier")
    named = suppliers.select("s_suppkey", media.model_id(F.col("s_name"), REGISTRY).alias("model"), detect.size_hint(F.concat(F.lit("model-"), F.substring(F.lit("mlnx"), (F.col("s_suppkey") % 4 + 1).cast("int"), F.lit(1)))).alias("size"))
    required = suppliers.select(F.concat(F.lit("Supplier#"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("name"))
    present = lambda have, out: F.broadcast(media.all_present(required, have.select(F.col("s_name").alias("name"))).toDF(out))
    return named.crossJoin(present(suppliers, "all_present")).crossJoin(present(suppliers.where("s_suppkey % 7 <> 0"), "most_present"))


def q21_clip_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = motion.clip_manifest(_segments(spark, sf_dir))
    inside = motion.frames_in_segments(_frames(spark, sf_dir), manifest.select("clip", "start_frame", "end_frame", "segment_no"))
    counts = inside.groupBy("clip", "segment_no").agg(F.count(F.lit(1)).alias("n_frames"))
    return manifest.join(counts, ["clip", "segment_no"]).select("clip", "segment_no", "file_name", "duration", "n_frames")


def _pictures(spark: SparkSession, sf_dir: str, height: int, width: int, channels: int) -> DataFrame:
    """An image a part, of made-up pixels: (image, height, width, channels, data)."""
    at = F.sequence(F.lit(0), F.lit(height * width * channels - 1))
    value = lambda k: F.pmod(F.col("p_partkey") * 7 + F.floor(k / (width * channels)) * 13 + F.floor(k / channels) % width * 5 + k % channels * 3, F.lit(256))
    data = F.unhex(F.array_join(F.transform(at, lambda k: F.lpad(F.hex(value(k).cast("long")), 2, "0")), ""))
    return _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("image"), F.lit(height).alias("height"), F.lit(width).alias("width"), F.lit(channels).alias("channels"), data.alias("data"))


def q22_image_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pixels.image_patches(_pictures(spark, sf_dir, 6, 8, 3), 4, 4, 2)
    return found.select("image", "patch", F.posexplode("pixels").alias("place", "x")).select("image", "patch", "place", F.round(F.col("x") * 255).cast("int").alias("value"))


def q23_motion_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of a still scene with some noise, in which a square moves while an event's value is high."""
    clips = _frames(spark, sf_dir)
    at = F.sequence(F.lit(0), F.lit(12 * 16 - 1))
    y, x = lambda k: F.floor(k / 16), lambda k: k % 16
    inside = lambda k: (F.col("motion") > THRESHOLD) & (F.abs(y(k) - 6) <= 3) & (F.abs(x(k) - 3 - F.col("frame_idx") % 10) <= 3)
    value = lambda k: F.when(inside(k), 240).otherwise(60 + y(k) * 3 + x(k) * 2 + F.pmod(k * 7 + F.col("frame_idx") * 3, F.lit(3)))
    data = F.unhex(F.array_join(F.transform(at, lambda k: F.lpad(F.hex(value(k).cast("long")), 2, "0")), ""))
    frames = clips.select("clip", "frame_idx", F.lit(12).alias("height"), F.lit(16).alias("width"), F.lit(1).alias("channels"), data.alias("data"))
    return pixels.motion_percent(frames)


def q24_total_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return motion.clip_manifest(_segments(spark, sf_dir)).agg(F.count(F.lit(1)).alias("n_clips"), F.count_distinct("clip").alias("n_sources"))


def q25_label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", (F.col("l_suppkey") % 80).cast("int").alias("c"), *((F.col("l_partkey") % k / 1024).alias(f"v{k}") for k in (1021, 509, 251, 127)))
    return boxes.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", detect.label_line("c", "v1021", "v509", "v251", "v127").alias("line"), detect.label_name(F.concat(F.lit("dir.a/"), F.col("l_orderkey").cast("string"), F.lit(".tar.png"))).alias("file_name"))


def q26_video_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part")
    times = F.transform(F.sequence(F.lit(0).cast("long"), F.col("p_partkey") % 4), lambda k: k * (F.col("p_size") % 4 * 0.25 + 0.125))
    return part.select("p_partkey", F.md5(tiling.video_string(times, (F.col("p_size") % 3 + 1).cast("int"), (F.col("p_size") % 5 + 1).cast("int")).cast("binary")).alias("tokens_md5"))


def q27_scatter_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "events").select(F.col("user_id").alias("sequence"), F.col("event_id").alias("pos"), (F.col("event_id") % 3).alias("id"), F.col("value").cast("double").alias("value"))
    order = Window.partitionBy("sequence").orderBy("pos")
    features = lines.where("id = 2").select("sequence", (F.row_number().over(order) - 1).alias("ordinal"), (F.col("pos") * 0.5).alias("value"))
    return batching.scatter_add(lines, features, 2).select("sequence", "pos", F.round("value", 6).alias("value"))


def queries() -> dict[str, Query]:
    return {k: v for k, v in globals().items() if k[0] == "q" and k[1:3].isdigit()}


def _linspace_sql(last: str, n: str) -> str:
    return f"list_transform(range({n}), lambda k: CASE WHEN k = {n} - 1 AND {n} > 1 THEN ({last})::DOUBLE ELSE k * (({last})::DOUBLE / greatest({n} - 1, 1)) END)"


def oracle_sql() -> dict[str, str]:
    clips = "c AS (SELECT user_id AS clip, count(*) AS n FROM events GROUP BY user_id)"
    step = "29.97 / 8"
    stepped = f"list_transform(range(CAST(ceil((n - 1)::DOUBLE / ({step}::DOUBLE)) AS BIGINT)), lambda k: CAST(round_even(k * ({step}::DOUBLE), 0) AS BIGINT))"
    even = f"list_transform({_linspace_sql('n - 1', 'least(32, n)')}, lambda x: CAST(trunc(x) AS BIGINT))"
    registry = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in REGISTRY.items())
    ontology = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ONTOLOGY.items())
    prompts = " ".join(f"WHEN '{k}' THEN " + " || ".join([f"'{t.partition('{}')[0]}'", *(["event_type", f"'{t.partition('{}')[2]}'"] if "{}" in t else [])]) for k, t in answers.PROMPTS.items())
    tasks = "['" + "', '".join((*answers.PROMPTS, "none")) + "']"
    points = lambda a, b: f"'1 ' || (k * {a} % 1300 + 100) || ' ' || (k * {b} % 1300 + 100) || ' 2 ' || (k * {b} % 1300 + 100) || ' ' || (k * {a} % 1300 + 100) || ' 3 ' || (k % 90 + 10) || ' ' || (k % 90 + 10)"
    return {
        "q01_motion_segments": f"WITH {SEGMENTS_SQL} SELECT clip, s AS start_frame, e AS end_frame, s / {FPS}::DOUBLE AS start_time, e / {FPS}::DOUBLE AS end_time, a::FLOAT AS avg_motion, k AS n_runs FROM seg",
        "q02_motion_runs": f"WITH {RUNS_SQL} SELECT clip, s AS start_frame, e AS end_frame, round(a, 6) AS avg_motion FROM runs",
        "q03_detection_filter": f"SELECT event_id, user_id, event_type, value FROM events WHERE value >= 40 AND event_type IN {KEPT_EVENTS}",
        "q04_bbox_normalize": f"WITH {BOXES_SQL} SELECT image, class_id, round((x1 + (x2 - x1) / 2) / 1280, 9) AS cx, round((y1 + (y2 - y1) / 2) / 720, 9) AS cy, round((x2 - x1) / 1280, 9) AS w, round((y2 - y1) / 720, 9) AS h FROM b",
        "q05_motion_percent": "SELECT user_id, round(count(*) FILTER (value >= 50) / count(*) * 100, 6) AS motion FROM events GROUP BY user_id",
        "q06_detections_per_image": f"WITH {BOXES_SQL} SELECT image, count(*) AS n_detections FROM b WHERE score >= 0.4::DOUBLE AND class_id IN {detect.TRAFFIC_CLASSES} GROUP BY image",
        "q07_ontology_lookup": f"SELECT event_id, event_type AS prompt, CASE event_type {ontology} END AS class_name FROM events",
        "q08_sample_uniform": f"""WITH {clips}, a AS (SELECT clip, n, {stepped} AS st, {even} AS ev FROM c),
            l AS (SELECT clip, CASE WHEN n <= 2 THEN range(n) WHEN n / 29.97::DOUBLE > 31 / 8.0::DOUBLE THEN ev WHEN st[-1] <> n - 1 THEN list_append(st, n - 1) ELSE st END AS x FROM a)
            SELECT clip, CAST(unnest(range(len(x))) AS INTEGER) AS ordinal, unnest(x) AS frame_idx FROM l""",
        "q09_sample_fps": f"""WITH {clips}, o AS (SELECT clip, n, unnest([2, 4, 6, 8]) AS fps FROM c), k AS (SELECT *, n // (24 // fps) AS m FROM o),
            b AS (SELECT clip, n, coalesce(max(fps) FILTER (m <= 16 AND m > 0 AND fps > 2), 2) AS best, max(fps) FILTER (fps = 2) AS two FROM k GROUP BY clip, n),
            l AS (SELECT clip, list_slice(range(0, n, 24 // best), 1, 16) AS x FROM b)
            SELECT clip, CAST(unnest(range(len(x))) AS INTEGER) AS ordinal, unnest(x) AS frame_idx FROM l""",
        "q10_time_to_frame": f"""WITH f AS (SELECT user_id AS clip, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_idx, floor(epoch(ts) - epoch(TIMESTAMP '2024-01-01'))::DOUBLE AS e FROM events),
            d AS (SELECT clip, max(e) AS dur, max(frame_idx) AS last FROM f GROUP BY clip), t AS (SELECT clip, last, unnest({_linspace_sql("dur", "9")}) AS t FROM d)
            SELECT t.clip, round(t.t, 3) AS t, coalesce(min(f.frame_idx), any_value(t.last)) AS frame_idx FROM t LEFT JOIN f ON f.clip = t.clip AND f.e > t.t GROUP BY t.clip, t.t""",
        "q11_select_tiling": f"WITH {TILING_SQL} SELECT * FROM t",
        "q12_token_budget": f"""WITH {TILING_SQL}, g AS (SELECT *, CAST(ceil((tile_rows * 19 + 8) / 2) AS INTEGER) AS gh, CAST(ceil((tile_cols * 19 + 8) / 2) AS INTEGER) AS gw FROM t)
            SELECT p_partkey, gh AS grid_h, gw AS grid_w, tile_rows * tile_cols + 1 AS n_crops, 4 + 14 * 15 + gh * (gw + 1) AS n_tokens, 196 + gh * gw AS n_patch_tokens,
            md5('<low_res_im_start>' || repeat(repeat('<im_patch>', 14) || '<im_col>', 14) || '<im_end><im_start>' || repeat(repeat('<im_patch>', gw) || '<im_col>', gh) || '<im_end>') AS tokens_md5 FROM g""",
        "q12b_pooling_windows": f"""WITH {TILING_SQL}, d AS (SELECT DISTINCT tile_rows AS r, tile_cols AS c FROM t),
            low AS (SELECT r, c, y.y // 2 * 14 + x.x // 2 AS token, y.y % 2 * 2 + x.x % 2 AS pos, CASE WHEN y.y < 27 AND x.x < 27 THEN y.y * 27 + x.x ELSE -1 END AS patch FROM d, range(28) y(y), range(28) x(x)),
            h AS (SELECT r, c, r * 19 + 8 AS hh, c * 19 + 8 AS ww FROM d),
            p AS (SELECT r, c, hh, ww, unnest(range(CAST(2 * ((hh + 1) // 2) AS BIGINT))) AS y FROM h), q AS (SELECT *, unnest(range(CAST(2 * ((ww + 1) // 2) AS BIGINT))) AS x FROM p),
            own AS (SELECT *, least(greatest(CAST(floor((y - 4) / 19) AS BIGINT), 0), r - 1) AS i, least(greatest(CAST(floor((x - 4) / 19) AS BIGINT), 0), c - 1) AS j FROM q),
            high AS (SELECT r, c, 196 + y // 2 * ((ww + 1) // 2) + x // 2 AS token, y % 2 * 2 + x % 2 AS pos, CASE WHEN y < hh AND x < ww THEN (i * c + j) * 729 + (y - i * 19) * 27 + (x - j * 19) + 729 ELSE -1 END AS patch FROM own)
            SELECT r AS tile_rows, c AS tile_cols, CAST(token AS INTEGER) AS token, CAST(pos AS INTEGER) AS pos, CAST(patch AS INTEGER) AS patch FROM (SELECT * FROM low UNION ALL SELECT * FROM high)""",
        "q12c_crop_rectangles": f"""WITH {TILING_SQL}, u AS (SELECT *, unnest(range(tile_rows * tile_cols)) AS crop FROM t), x AS (SELECT *, crop // tile_cols AS i, crop % tile_cols AS j FROM u)
            SELECT p_partkey, CAST(crop AS INTEGER) AS crop, CAST(i * 266 AS INTEGER) AS y0, CAST(j * 266 AS INTEGER) AS x0, CASE WHEN i <> 0 THEN 4 ELSE 0 END AS top, CASE WHEN j <> 0 THEN 4 ELSE 0 END AS "left",
            CASE WHEN i <> tile_rows - 1 THEN 4 ELSE 0 END AS bottom, CASE WHEN j <> tile_cols - 1 THEN 4 ELSE 0 END AS "right" FROM x""",
        "q13_render_prompt": """WITH m AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
            v AS (SELECT conv_id, bool_and(lower(role) = CASE WHEN k % 2 = 1 THEN 'user' ELSE 'assistant' END) AS valid,
              string_agg(CASE WHEN lower(role) = 'user' THEN CASE WHEN k = 1 THEN '' ELSE '<|im_end|>' || chr(10) END || '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10) ELSE ' <|im_start|>assistant' || chr(10) || text END, '' ORDER BY turn) || '<|im_start|>assistant' || chr(10) AS prompt FROM m GROUP BY conv_id)
            SELECT conv_id, CASE WHEN valid THEN prompt END AS prompt, valid FROM v""",
        "q13b_task_prompt": f"WITH e AS (SELECT event_id, event_type, ({tasks})[event_id % 6 + 1] AS task FROM events) SELECT event_id, task, CASE task {prompts} END AS prompt FROM e",
        "q14_parse_point": r"""WITH r AS (SELECT *, CAST(trunc(l_quantity * 2) AS INTEGER) AS x, l_partkey % 1000 AS y FROM lineitem),
            s AS (SELECT *, CASE l_suppkey % 5 WHEN 0 THEN '<point x="' || x || '.5" y="' || y || '">' WHEN 1 THEN 'x=' || x WHEN 2 THEN 'max="' || x || '" y=' || y WHEN 3 THEN 'x= y= none' ELSE 'y=' || y || ' x=' || x || '.25' END AS response FROM r),
            p AS (SELECT *, nullif(regexp_extract(response, 'x="?(\d+\.?\d*)"?', 1), '') AS px, nullif(regexp_extract(response, 'y="?(\d+\.?\d*)"?', 1), '') AS py FROM s),
            q AS (SELECT *, contains(response, 'x=') AND contains(response, 'y=') AND px IS NOT NULL AND py IS NOT NULL AS found FROM p)
            SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, found, CASE WHEN found THEN px::DOUBLE END AS x, CASE WHEN found THEN py::DOUBLE END AS y FROM q""",
        "q15_parse_count": "SELECT doc_id, TRY_CAST(nullif(regexp_extract(text, '([0-9]+)', 1), '') AS BIGINT) AS n FROM documents",
        "q16_parse_tracks": rf"""WITH o AS (SELECT o_orderkey AS k FROM orders),
            s AS (SELECT k AS id, 'Here <tracks coords="' || (k % 7) || '.5 ' || {points(3, 7)} || ';' || (k % 5 + 8) || ' ' || {points(11, 13)} || '"/> and <points coords="1 1 ' || (k * 17 % 1300 + 100) || ' ' || (k * 19 % 1300 + 100) || '"> end' AS text FROM o),
            a AS (SELECT id, regexp_extract_all(text, '{answers.COORDS_PATTERN}', 1) AS tags FROM s),
            b AS (SELECT id, unnest(range(len(tags))) AS tag_no, unnest(tags) AS tag FROM a),
            c AS (SELECT id, tag_no, regexp_extract_all(tag, '{answers.FRAME_PATTERN}', 1) AS ts, regexp_extract_all(tag, '{answers.FRAME_PATTERN}', 2) AS ps FROM b),
            d AS (SELECT id, tag_no, unnest(range(len(ts))) AS group_no, unnest(ts)::DOUBLE AS t, unnest(ps) AS p FROM c),
            e AS (SELECT id, tag_no, group_no, t, regexp_extract_all(p, '{answers.POINT_PATTERN}', 1) AS ii, regexp_extract_all(p, '{answers.POINT_PATTERN}', 2) AS xx, regexp_extract_all(p, '{answers.POINT_PATTERN}', 3) AS yy FROM d),
            f AS (SELECT id, tag_no, group_no, t, unnest(range(len(ii))) AS point_no, unnest(ii) AS idx, unnest(xx)::DOUBLE / 1000 * 1280 AS x, unnest(yy)::DOUBLE / 1000 * 720 AS y FROM e)
            SELECT id, CAST(tag_no AS INTEGER) AS tag_no, CAST(group_no AS INTEGER) AS group_no, CAST(point_no AS INTEGER) AS point_no, t, idx, round(x, 6) AS x, round(y, 6) AS y FROM f WHERE x <= 1280 AND y <= 720""",
        "q17_ragged_batch": """WITH r AS (SELECT l_orderkey AS example, l_linenumber AS crops, CAST(trunc(196 + l_linenumber * l_quantity) AS BIGINT) AS pooled,
              row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS back FROM lineitem),
            t AS (SELECT example, count(*) AS n_images, CAST(sum(crops) AS BIGINT) AS n_crops, CAST(sum(pooled) AS BIGINT) AS n_pooled, CAST(coalesce(sum(crops) FILTER (back > 1), 0) * 729 AS BIGINT) AS last_offset FROM r GROUP BY example)
            SELECT *, max(n_crops) OVER () AS padded_to, max(n_crops) OVER () - n_crops AS padding FROM t""",
        "q17b_token_counts": f"SELECT l_orderkey, CAST(count(*) FILTER (l_linenumber = {END_TOKEN}) // 2 AS INTEGER) AS n_images, bool_or(l_linenumber = {END_TOKEN}) AS has_end, CAST(count(*) FILTER (l_linenumber IN (1, 2)) AS INTEGER) AS n_flagged FROM lineitem GROUP BY l_orderkey",
        "q18_masked_mean_pool": """WITH e AS (SELECT label || ':' || (vec_id % 40) AS token, unnest(range(len(embedding))) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings)
            SELECT token, CAST(pos AS INTEGER) AS pos, round(avg(x), 6) AS value FROM e GROUP BY token, pos""",
        "q18b_rescale": "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round((l_quantity * 5 / 255 - 0.5::DOUBLE) / 0.5::DOUBLE, 6) AS a, round((l_linenumber * 30 / 255 - 0.5::DOUBLE) / 0.5::DOUBLE, 6) AS b FROM lineitem",
        "q19_placeholders_and_bos": """WITH m AS (SELECT conv_id, turn, role, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
            k AS (SELECT conv_id, any_value(n) AS n, string_agg(role || CASE WHEN turn < 2 THEN '[' || turn || ']' ELSE '<|image|>' END, ' ' ORDER BY turn) AS text FROM m GROUP BY conv_id),
            b AS (SELECT *, range(5, n + 5) AS ids FROM k)
            SELECT conv_id, text, FALSE AS bos_present, array_to_string(list_concat(list_concat(list_transform(range(conv_id % 4), lambda x: 0), [1]), ids), ',') AS input_ids,
              array_to_string(list_concat(list_transform(range(conv_id % 4), lambda x: 0), list_transform(range(n + 1), lambda x: 1)), ',') AS attention_mask FROM b""",
        "q20_registry_check": f"""SELECT s_suppkey, CASE s_name {registry} ELSE s_name END AS model, CASE s_suppkey % 4 WHEN 0 THEN 'm' WHEN 1 THEN 'l' WHEN 2 THEN 'n' ELSE 's' END AS size,
            (SELECT bool_and('Supplier#' || lpad(CAST(s.s_suppkey AS VARCHAR), 9, '0') IN (SELECT s_name FROM supplier)) FROM supplier s) AS all_present,
            (SELECT bool_and('Supplier#' || lpad(CAST(s.s_suppkey AS VARCHAR), 9, '0') IN (SELECT s_name FROM supplier WHERE s_suppkey % 7 <> 0)) FROM supplier s) AS most_present FROM supplier""",
        "q21_clip_manifest": f"""WITH {SEGMENTS_SQL}, w AS (SELECT *, CAST(row_number() OVER (PARTITION BY clip ORDER BY s) AS INTEGER) AS segment_no FROM seg)
            SELECT clip, segment_no, clip || '_motion_' || CASE WHEN segment_no < 1000 THEN lpad(CAST(segment_no AS VARCHAR), 3, '0') ELSE CAST(segment_no AS VARCHAR) END || '.mp4' AS file_name, (e - s) / {FPS}::DOUBLE AS duration, e - s + 1 AS n_frames FROM w""",
        "q22_image_patches": """WITH g AS (SELECT i, j, c, (i + 0.5::DOUBLE) * 1.5::DOUBLE - 0.5::DOUBLE AS sy, (j + 0.5::DOUBLE) * 2 - 0.5::DOUBLE AS sx FROM range(4) a(i), range(4) b(j), range(3) d(c)),
            w AS (SELECT *, CAST(floor(sy) AS BIGINT) AS y, CAST(floor(sx) AS BIGINT) AS x FROM g),
            v AS (SELECT p_partkey AS image, i, j, c, sy - y AS dy, sx - x AS dx, (p_partkey * 7 + y * 13 + x * 5 + c * 3) % 256 AS v00, (p_partkey * 7 + (y + 1) * 13 + x * 5 + c * 3) % 256 AS v10,
              (p_partkey * 7 + y * 13 + (x + 1) * 5 + c * 3) % 256 AS v01, (p_partkey * 7 + (y + 1) * 13 + (x + 1) * 5 + c * 3) % 256 AS v11 FROM part, w)
            SELECT image, CAST(i // 2 * 2 + j // 2 AS INTEGER) AS patch, CAST((i % 2 * 2 + j % 2) * 3 + c AS INTEGER) AS place,
              CAST(round_even((v00 * (1 - dy) + v10 * dy) * (1 - dx) + (v01 * (1 - dy) + v11 * dy) * dx, 0) AS INTEGER) AS value FROM v""",
        "q24_total_clips": f"WITH {SEGMENTS_SQL} SELECT count(*) AS n_clips, count(DISTINCT clip) AS n_sources FROM seg",
        "q25_label_lines": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, printf('%d %.6f %.6f %.6f %.6f', l_suppkey % 80, l_partkey % 1021 / 1024::DOUBLE, l_partkey % 509 / 1024::DOUBLE, l_partkey % 251 / 1024::DOUBLE, l_partkey % 127 / 1024::DOUBLE) AS line, 'dir.a/' || l_orderkey || '.tar.txt' AS file_name FROM lineitem",
        "q26_video_string": """SELECT p_partkey, md5(array_to_string(list_transform(range(p_partkey % 4 + 1), lambda k: printf('%.1f', k * (p_size % 4 * 0.25::DOUBLE + 0.125::DOUBLE)) || ' <frame_start>' || repeat(repeat('<im_patch>', p_size % 5 + 1), p_size % 3 + 1) || '<frame_end>'), ' ')) AS tokens_md5 FROM part""",
        "q27_scatter_add": "SELECT user_id AS sequence, event_id AS pos, round(value::DOUBLE + CASE WHEN event_id % 3 = 2 THEN event_id * 0.5::DOUBLE ELSE 0 END, 6) AS value FROM events",
    }
