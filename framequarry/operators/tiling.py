"""Image tiling, pooling windows, token budgets and token strings.

Sizes are in pixels, grids in patches. The tiling candidates are part of the
plan, so choosing one needs neither a join nor a window.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: Patch size, crop size, margins (patches a side), crops, pooling of images and of video frames.
PATCH, SIZE, MARGIN, MAX_CROPS = 14, 378, 4, 8
IMAGE_POOL, VIDEO_POOL = 2, 3
CROP_PATCHES = SIZE // PATCH
WINDOW_PATCHES = CROP_PATCHES - 2 * MARGIN
WINDOW, MARGIN_PIXELS = WINDOW_PATCHES * PATCH, 2 * MARGIN * PATCH
#: Special tokens in image and video strings.
PATCH_TOKEN, COL_TOKEN, START_TOKEN, LOW_START_TOKEN, END_TOKEN = "<im_patch>", "<im_col>", "<im_start>", "<low_res_im_start>", "<im_end>"
FRAME_START_TOKEN, FRAME_END_TOKEN = "<frame_start>", "<frame_end>"


def tilings(max_crops: int = MAX_CROPS) -> list[tuple[int, int]]:
    """(rows, columns) of all tilings with few enough crops, by area and then by rows."""
    return sorted(((i, j) for i in range(1, max_crops + 1) for j in range(1, max_crops // i + 1)), key=lambda x: (x[0] * x[1], x[0]))


def select_tiling(height: Column, width: Column, window: int = WINDOW, margin: int = MARGIN_PIXELS, max_crops: int = MAX_CROPS) -> Column:
    """struct(rows, cols): the tiling whose scale is the least that doesn't shrink the image, or the greatest if all do.

    Scales are single-precision. An image as small as its margin has an
    infinite scale on that side; a smaller one a negative scale. Ties go to
    the smaller area, then to fewer rows.
    """
    side = lambda n, size: F.coalesce(F.try_divide(F.lit(float(n * window)).cast("float"), (size - margin).cast("float")).cast("float"), F.lit(float("inf")).cast("float"))
    options = F.array(*(F.struct(F.least(side(i, height), side(j, width)).alias("scale"), F.lit(i).alias("rows"), F.lit(j).alias("cols")) for i, j in tilings(max_crops)))
    enough = F.filter(options, lambda o: o["scale"] >= 1)
    first = lambda better: lambda best, o: F.when(best.isNull() | better(o["scale"], best["scale"]), o).otherwise(best)
    none = F.lit(None).cast("struct<scale:float,rows:int,cols:int>")
    chosen = F.coalesce(F.aggregate(enough, none, first(lambda a, b: a < b)), F.aggregate(options, none, first(lambda a, b: a > b)))
    return F.struct(chosen["rows"].alias("rows"), chosen["cols"].alias("cols"))


def pooled(patches: Column, pool: int) -> Column:
    """Tokens along a side of so many patches."""
    return F.ceil(patches / pool).cast("int")


def image_grid(tiling: Column, pool: int = IMAGE_POOL) -> Column:
    """struct(resized_h, resized_w, h, w) in tokens: the global view and the tiled view."""
    side = -(-CROP_PATCHES // pool)
    high = lambda n: pooled(n * WINDOW_PATCHES + 2 * MARGIN, pool)
    return F.struct(F.lit(side).alias("resized_h"), F.lit(side).alias("resized_w"), high(tiling["rows"]).alias("h"), high(tiling["cols"]).alias("w"))


def patch_tokens(grid: Column) -> Column:
    """Patch tokens of an image."""
    return grid["resized_h"] * grid["resized_w"] + grid["h"] * grid["w"]


def token_count(grid: Column, col_tokens: bool = True, single_crop_col_tokens: bool | None = None) -> Column:
    """Tokens of an image with its start, end and column tokens."""
    low = col_tokens if single_crop_col_tokens is None else single_crop_col_tokens
    return 4 + grid["resized_h"] * (grid["resized_w"] + int(low)) + grid["h"] * (grid["w"] + int(col_tokens))


def _block(start: str, h: Column, w: Column, col_tokens: bool) -> Column:
    row = F.concat(F.repeat(F.lit(PATCH_TOKEN), w), F.lit(COL_TOKEN if col_tokens else ""))
    return F.concat(F.lit(start), F.repeat(row, h), F.lit(END_TOKEN))


def image_tokens(grid: Column, col_tokens: bool = True, single_crop_col_tokens: bool | None = None, single_crop_start_token: bool = True) -> Column:
    """Token string of an image: the global view first."""
    low = col_tokens if single_crop_col_tokens is None else single_crop_col_tokens
    return F.concat(_block(LOW_START_TOKEN if single_crop_start_token else START_TOKEN, grid["resized_h"], grid["resized_w"], low), _block(START_TOKEN, grid["h"], grid["w"], col_tokens))


@F.pandas_udf(ArrayType(StringType()))
def time_labels(times: pd.Series) -> pd.Series:
    """Times with one decimal, rounded from their exact binary values, half to even."""
    return pd.Series([None if x is None else [f"{t:.1f}" for t in x] for x in times], dtype=object)


def video_string(times: Column, h: Column, w: Column, col_tokens: bool = False, frame_tokens: bool = True) -> Column:
    """Token string of a video: each frame's time and patches, with a space between frames."""
    start, end = (FRAME_START_TOKEN, FRAME_END_TOKEN) if frame_tokens else (START_TOKEN, END_TOKEN)
    row = F.concat(F.repeat(F.lit(PATCH_TOKEN), w), F.lit(COL_TOKEN if col_tokens else ""))
    return F.array_join(F.transform(time_labels(times), lambda t: F.concat(t, F.lit(" " + start), F.repeat(row, h), F.lit(end))), " ")


def crop_rectangles(tiling: Column) -> Column:
    """array<struct(crop, y0, x0, top, left, bottom, right)>: origin of each crop and the patches at each side that an earlier or later crop holds."""
    rows, cols = tiling["rows"], tiling["cols"]
    cut = lambda inner: F.when(inner, F.lit(MARGIN)).otherwise(F.lit(0))

    def crop(k: Column) -> Column:
        i, j = F.floor(k / cols).cast("int"), (k % cols).cast("int")
        return F.struct(k.alias("crop"), (i * WINDOW).alias("y0"), (j * WINDOW).alias("x0"), cut(i != 0).alias("top"), cut(j != 0).alias("left"), cut(i != rows - 1).alias("bottom"), cut(j != cols - 1).alias("right"))

    return F.transform(F.sequence(F.lit(0), rows * cols - 1), crop)


def source_patch(tiling: Column, row: Column, col: Column) -> Column:
    """Number of the patch, counted crop by crop, that a patch of the tiled image comes from.

    A crop owns its inner patches; the image's outer margins belong to the
    crops at its edges.
    """
    last = lambda n: (n - 1).cast("int")
    crop_of = lambda p, n: F.least(F.greatest(F.floor((p - MARGIN) / WINDOW_PATCHES), F.lit(0)), last(n)).cast("int")
    i, j = crop_of(row, tiling["rows"]), crop_of(col, tiling["cols"])
    y, x = row - i * WINDOW_PATCHES, col - j * WINDOW_PATCHES
    return (i * tiling["cols"] + j) * (CROP_PATCHES * CROP_PATCHES) + y * CROP_PATCHES + x


def pooling_windows(h: Column, w: Column, pool_h: int, pool_w: int, number=None) -> Column:
    """array<array<int>>: the patches of each token, row by row, -1 where there is none.

    The grid is padded to a multiple of the pool, the smaller half before.
    ``number(row, col)`` numbers the patches (default: row by row).
    """
    number = number or (lambda y, x: y * w + x)
    out_h, out_w = F.ceil(h / pool_h).cast("int"), F.ceil(w / pool_w).cast("int")
    top, left = F.floor((out_h * pool_h - h) / 2).cast("int"), F.floor((out_w * pool_w - w) / 2).cast("int")

    def window(k: Column) -> Column:
        y0, x0 = F.floor(k / out_w).cast("int") * pool_h - top, (k % out_w).cast("int") * pool_w - left
        cells = [(y0 + dy, x0 + dx) for dy in range(pool_h) for dx in range(pool_w)]
        return F.array(*(F.when((y >= 0) & (y < h) & (x >= 0) & (x < w), number(y, x)).otherwise(F.lit(-1)).cast("int") for y, x in cells))

    return F.transform(F.sequence(F.lit(0), out_h * out_w - 1), window)


def image_pooling(tiling: Column, pool: int = IMAGE_POOL) -> Column:
    """Pooling windows of a whole image: the global view's tokens, then the tiled view's, numbered after the global crop."""
    side = F.lit(CROP_PATCHES)
    low = pooling_windows(side, side, pool, pool)
    high_h, high_w = tiling["rows"] * WINDOW_PATCHES + 2 * MARGIN, tiling["cols"] * WINDOW_PATCHES + 2 * MARGIN
    return F.concat(low, pooling_windows(high_h, high_w, pool, pool, lambda y, x: source_patch(tiling, y, x) + CROP_PATCHES * CROP_PATCHES))
