"""Prompts for vision-language tasks, and parsers of the answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Prompt texts by task; ``{}`` stands for the object, and "answer" passes the question on.
PROMPTS = {
    "point": "Point to the {} in the image.",
    "describe": "Describe this image in detail.",
    "count": "How many {} are in this image? Answer with just the number.",
    "ocr": "Read all text visible in this image.",
    "answer": "{}",
}

#: Patterns of coordinates in answers.
X_PATTERN, Y_PATTERN = r'x="?(\d+\.?\d*)"?', r'y="?(\d+\.?\d*)"?'
COORDS_PATTERN = r'<(?:points|tracks).*? coords="([0-9\t:;, .]+)"/?>'
FRAME_PATTERN = r"(?:^|\t|:|,|;)([0-9\.]+) ([0-9\. ]+)"
POINT_PATTERN = r"([0-9]+) ([0-9]{3,4}) ([0-9]{3,4})"


def task_prompt(task: Column, subject: Column) -> Column:
    """The prompt of a task about a subject; null for an unknown task."""
    out = F.lit(None).cast("string")
    for name, text in PROMPTS.items():
        before, _, after = text.partition("{}")
        out = F.when(task == name, F.concat(F.lit(before), subject, F.lit(after)) if "{}" in text else F.lit(text)).otherwise(out)
    return out


def parse_point(response: Column) -> Column:
    """struct(found, coordinates(x, y), response): the first x= and the first y=, where both are there."""
    x, y = (F.nullif(F.regexp_extract(response, p, 1), F.lit("")).cast("double") for p in (X_PATTERN, Y_PATTERN))
    found = F.coalesce(F.contains(response, F.lit("x=")) & F.contains(response, F.lit("y=")) & x.isNotNull() & y.isNotNull(), F.lit(False))
    return F.struct(found.alias("found"), F.when(found, F.struct(x.alias("x"), y.alias("y"))).alias("coordinates"), response.alias("response"))


def parse_count(response: Column) -> Column:
    """The first run of digits as a number, null without one (or where it exceeds a long)."""
    return F.nullif(F.regexp_extract(response, r"(\d+)", 1), F.lit("")).try_cast("bigint")


def parse_tracks(answers: DataFrame, text: str = "text", width: str = "image_w", height: str = "image_h", keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """One row per point in ``coords="..."`` tags: t, idx, x, y, in the order of the text.

    Coordinates are thousandths of the image. Points outside it are dropped.
    Where ``width`` and ``height`` are arrays, t is the number (from 1) of the
    image whose size counts, and a number beyond them is an error.
    """
    several = dict(answers.dtypes)[width].startswith("array")
    rows = answers.select(*keep, width, height, F.posexplode(F.regexp_extract_all(text, F.lit(COORDS_PATTERN), F.lit(1))).alias("tag_no", "tag"))
    frames, points = F.regexp_extract_all("tag", F.lit(FRAME_PATTERN), F.lit(1)), F.regexp_extract_all("tag", F.lit(FRAME_PATTERN), F.lit(2))
    rows = rows.select(*keep, width, height, "tag_no", F.posexplode(F.arrays_zip(frames.alias("t"), points.alias("points"))).alias("group_no", "g"))
    parts = [F.regexp_extract_all("g.points", F.lit(POINT_PATTERN), F.lit(k)).alias(n) for k, n in ((1, "idx"), (2, "px"), (3, "py"))]
    rows = rows.select(*keep, width, height, "tag_no", "group_no", F.col("g.t").alias("t_text"), F.posexplode(F.arrays_zip(*parts)).alias("point_no", "p"))
    t = F.col("t_text").cast("int") if several else F.col("t_text").cast("double")
    rows = rows.withColumn("t", t)
    w, h = (F.element_at(F.col(c), F.col("t")) if several else F.col(c) for c in (width, height))
    rows = rows.select(*keep, "tag_no", "group_no", "point_no", "t", F.col("p.idx").alias("idx"), w.cast("double").alias("w"), h.cast("double").alias("h"), F.col("p.px").alias("px"), F.col("p.py").alias("py"))
    rows = rows.withColumn("x", F.col("px").cast("double") / 1000 * F.col("w")).withColumn("y", F.col("py").cast("double") / 1000 * F.col("h"))
    return rows.where((F.col("x") >= 0) & (F.col("x") <= F.col("w")) & (F.col("y") >= 0) & (F.col("y") <= F.col("h"))).select(*keep, "tag_no", "group_no", "point_no", "t", "idx", "x", "y")
