"""Detections: filters, box normalisation, label lines, lookups and counts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Ids of the classes person, car, aeroplane, bus and truck.
TRAFFIC_CLASSES = (0, 2, 4, 5, 7)


def explode_detections(images: DataFrame, boxes: str = "xyxy", classes: str = "class_id", scores: str = "score") -> DataFrame:
    """Parallel arrays to one row per detection, by position: det_ix, x1, y1, x2, y2, class_id, score."""
    rest = [c for c in images.columns if c not in (boxes, classes, scores)]
    zipped = F.arrays_zip(F.col(boxes).alias("box"), F.col(classes).alias("class_id"), F.col(scores).alias("score"))
    rows = images.select(*rest, F.posexplode(zipped).alias("det_ix", "d"))
    return rows.select(*rest, "det_ix", *(F.col("d.box")[k].alias(n) for k, n in enumerate(("x1", "y1", "x2", "y2"))), F.col("d.class_id").alias("class_id"), F.col("d.score").alias("score"))


def filter_detections(detections: DataFrame, conf: float = 0.4, classes: tuple | list | DataFrame | None = None, score: str = "score", class_col: str = "class_id") -> DataFrame:
    """Detections scoring ``conf`` or more, of the given classes (None: all).

    A DataFrame of classes (column ``class_id``) is semi-joined, for lists too
    long for a plan.
    """
    kept = detections.where(F.col(score) >= conf)
    if classes is None:
        return kept
    if isinstance(classes, DataFrame):
        return kept.join(classes.select(F.col("class_id").alias(class_col)), class_col, "left_semi")
    return kept.where(F.col(class_col).isin(*classes))


def normalized_box(width: Column, height: Column, x1: str = "x1", y1: str = "y1", x2: str = "x2", y2: str = "y2") -> dict[str, Column]:
    """Centre and size of a corner box, as shares of the image."""
    w, h = F.col(x2) - F.col(x1), F.col(y2) - F.col(y1)
    return {"cx": (F.col(x1) + w / 2) / width, "cy": (F.col(y1) + h / 2) / height, "w": w / width, "h": h / height}


@F.pandas_udf(StringType())
def label_line(class_id: pd.Series, cx: pd.Series, cy: pd.Series, w: pd.Series, h: pd.Series) -> pd.Series:
    """``id cx cy w h`` with six decimals, rounded from the exact binary value (half to even), which ``format_string`` does not do."""
    return pd.Series(["%d %.6f %.6f %.6f %.6f" % row for row in zip(class_id, cx, cy, w, h, strict=True)], dtype=object)


def label_files(detections: DataFrame, image: str = "image", order: str = "det_ix") -> DataFrame:
    """File name and text of each image's labels; an image without detections has none.

    ``detections`` has cx, cy, w, h and class_id. Lines are gathered per
    image, whose detections are few by nature.
    """
    lines = detections.withColumn("line", label_line("class_id", "cx", "cy", "w", "h"))
    texts = lines.groupBy(image).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), "line"))).alias("lines"))
    return texts.select(image, label_name(F.col(image)).alias("file_name"), F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("text"))


def label_name(name: Column) -> Column:
    """An image's file name with its last suffix replaced by .txt; a leading dot starts no suffix."""
    return F.concat(F.regexp_replace(name, r"(?<=[^./])\.[^./]*$", ""), F.lit(".txt"))


def size_hint(path: Column) -> Column:
    """Model size by hints in a path: of -m, -l and -n the last named here that occurs wins; s without any."""
    return F.when(F.contains(path, F.lit("-n")), "n").when(F.contains(path, F.lit("-l")), "l").when(F.contains(path, F.lit("-m")), "m").otherwise("s")


@F.pandas_udf(StringType())
def label_text(category: pd.Series, score: pd.Series) -> pd.Series:
    """``category: 0.87``: the caption of a box, two decimals, rounded from the exact binary value (half to even)."""
    return pd.Series([None if c is None or s != s else f"{c}: {s:.2f}" for c, s in zip(category, score, strict=True)], dtype=object)


def ontology_lookup(detections: DataFrame, ontology: dict[str, str], prompt: str = "prompt", out: str = "class_name") -> DataFrame:
    """``detections`` with the class that each prompt stands for, null for an unknown one. The map is part of the plan."""
    if not ontology:
        return detections.withColumn(out, F.lit(None).cast("string"))
    pairs = F.create_map(*(F.lit(x) for pair in ontology.items() for x in pair))
    return detections.withColumn(out, F.try_element_at(pairs, F.col(prompt)))


def detections_per_image(detections: DataFrame, image: str = "image") -> DataFrame:
    return detections.groupBy(image).agg(F.count(F.lit(1)).alias("n_detections"))


def mask_pixels(pixels: DataFrame, value: str = "px") -> DataFrame:
    """Foreground pixels of a mask: values above zero."""
    return pixels.where(F.col(value) > 0)


def predict(images: DataFrame, detector, conf: float = 0.4) -> DataFrame:
    """Run a detector over (image, content) rows: the plug-in point for models.

    ``detector(image, content, conf)`` returns (xyxy, class_ids, scores); it is
    made once a worker by the zero-argument factory given here. The threshold
    is handed down and applied again afterwards. An image that can't be read
    (the detector returns None) gives no row.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = detector()
        for batch in batches:
            rows = []
            for image, content in zip(batch["image"], batch["content"], strict=True):
                found = model(image, content, conf)
                if found is not None:
                    rows += [(image, k, *map(float, box), int(c), float(s)) for k, (box, c, s) in enumerate(zip(*found, strict=True))]
            yield pd.DataFrame(rows, columns=["image", "det_ix", "x1", "y1", "x2", "y2", "class_id", "score"])

    out = images.select("image", "content").mapInPandas(run, "image string, det_ix int, x1 double, y1 double, x2 double, y2 double, class_id int, score double")
    return out.where(F.col("score") >= conf)
