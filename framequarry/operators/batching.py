"""Ragged batches: sums and offsets by example, padding, pooled gathers, placeholders and the leading token."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def image_offsets(images: DataFrame, n_patches: int, example: str = "example", order: str = "image_ix", crops: str = "num_crops") -> DataFrame:
    """``images`` with each image's patches and the patches of earlier images of its example."""
    before = Window.partitionBy(example).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    patches = F.col(crops).cast("long") * n_patches
    return images.withColumn("n_patches", patches).withColumn("patch_offset", F.coalesce(F.sum(patches).over(before), F.lit(0).cast("long")))


def example_totals(images: DataFrame, pooled: Column, example: str = "example", crops: str = "num_crops") -> DataFrame:
    """Images, crops and pooled patches of each example."""
    return images.groupBy(example).agg(F.count(F.lit(1)).alias("n_images"), F.sum(F.col(crops).cast("long")).alias("n_crops"), F.sum(pooled.cast("long")).alias("n_pooled"))


def with_padding(totals: DataFrame, column: str) -> DataFrame:
    """``totals`` with the batch's greatest value of a column, to which examples are padded, and what each lacks.

    The greatest value is a one-row subquery, not a window over all rows.
    """
    top = totals.agg(F.max(column).alias("padded_to"))
    return totals.crossJoin(F.broadcast(top)).withColumn("padding", F.col("padded_to") - F.col(column))


def images_in_tokens(ids: Column, end_token: int) -> Column:
    """Images in a token sequence: each ends twice, once for either view."""
    return F.floor(F.size(F.filter(ids, lambda x: x == end_token)) / 2).cast("int")


def has_token(ids: Column, *tokens: int) -> Column:
    """Whether any of the tokens occurs."""
    return F.exists(ids, lambda x: x.isin(*tokens))


def token_flags(ids: Column, *tokens: int) -> Column:
    """For each token, whether it is one of those given."""
    return F.transform(ids, lambda x: x.isin(*tokens))


def repeat_rows(counts: DataFrame, count: str, out: str = "ordinal") -> DataFrame:
    """Each row so many times, numbered from 0; rows with a count of 0 vanish."""
    return counts.where(F.col(count) > 0).withColumn(out, F.explode(F.sequence(F.lit(0), F.col(count).cast("int") - 1)))


def merge_kind(n_images: Column, n_videos: Column) -> Column:
    """What a batch holds: "image", "video" or null for neither; both at once is an error."""
    both = F.raise_error(F.lit("images and videos can't be given at the same time")).cast("string")
    return F.when((n_images > 0) & (n_videos > 0), both).when(n_images > 0, "image").when(n_videos > 0, "video")


def pool_features(pools: DataFrame, patches: DataFrame, token: str = "token", idx: str = "idx", masked: bool = True) -> DataFrame:
    """Mean feature of the patches of each token: token, pos, value.

    ``pools`` has token and idx (patch numbers, -1: none), ``patches`` has
    patch and features (array). With ``masked`` the mean is over patches that
    are there (0 for a token without any), else missing ones count as zeros.
    """
    cells = pools.select(token, F.size(idx).alias("width"), F.explode(idx).alias("patch"))
    gathered = cells.join(patches.select("patch", "features"), "patch", "left")
    spread = gathered.select(token, "width", "patch", F.posexplode_outer("features").alias("pos", "x"))
    size = F.count_if(F.col("patch") >= 0) if masked else F.first("width")
    means = spread.where("pos is not null").groupBy(token, "pos").agg((F.sum("x") / F.greatest(size, F.lit(1))).alias("value"))
    empty = pools.where(~F.exists(idx, lambda x: x >= 0)).select(token)
    width = patches.select(F.size("features").alias("n")).limit(1)
    zeros = empty.crossJoin(F.broadcast(width)).select(token, F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("pos"), F.lit(0.0).alias("value"))
    return means.unionByName(zeros)


def rescale(values: Column, mean: float = 0.5, std: float = 0.5, top: float = 255.0) -> Column:
    """Pixels from 0..top to 0..1, then normalised."""
    return F.transform(values, lambda x: (x / top - mean) / std)


def scatter_add(tokens: DataFrame, features: DataFrame, patch_token: int) -> DataFrame:
    """``tokens`` (pos, id, value) with the k-th feature (ordinal k from 0, value) added at the k-th patch token.

    Patch tokens are numbered within ``sequence``; a number of features other
    than that of patch tokens is an error.
    """
    number = F.sum(F.when(F.col("id") == patch_token, 1).otherwise(0)).over(Window.partitionBy("sequence").orderBy("pos")) - 1
    numbered = tokens.withColumn("ordinal", F.when(F.col("id") == patch_token, number))
    counted = numbered.where("ordinal is not null").select("sequence", "ordinal").unionByName(features.select("sequence", "ordinal")).groupBy("sequence", "ordinal").count().where("count <> 2")
    joined = numbered.join(features.select("sequence", "ordinal", F.col("value").alias("added")), ["sequence", "ordinal"], "left")
    checked = joined.join(F.broadcast(counted.agg(F.count(F.lit(1)).alias("unmatched"))), how="cross")
    total = F.col("value") + F.coalesce("added", F.lit(0.0))
    return checked.select("sequence", "pos", "id", F.when(F.col("unmatched") > 0, F.raise_error(F.lit("features and patch tokens differ in number")).cast("double")).otherwise(total).alias("value"))


def first_valid(mask: Column) -> Column:
    """Place (from 0) of the first 1 in a mask, 0 without any."""
    return F.greatest(F.array_position(mask, 1) - 1, F.lit(0)).cast("int")


def insert_bos(sequences: DataFrame, bos: int, pad: int, batch: str = "batch", ids: str = "input_ids", mask: str = "attention_mask") -> DataFrame:
    """Put the leading token before the first valid one of each left-padded sequence.

    The decision is the batch's: where all of its sequences have the token
    already, none changes. An empty sequence becomes the token alone.
    """
    at = first_valid(F.col(mask))
    own = F.coalesce(F.get(F.col(ids), at) == bos, F.lit(False))
    decided = sequences.withColumn("bos_present", F.bool_and(own).over(Window.partitionBy(batch))).withColumn("first_valid", at)
    n = F.size(ids)
    tail = F.slice(F.col(ids), F.col("first_valid") + 1, F.greatest(n - F.col("first_valid"), F.lit(0)))
    new_ids = F.concat(F.array_repeat(F.lit(pad), F.col("first_valid")), F.array(F.lit(bos)), tail)
    new_mask = F.concat(F.array_repeat(F.lit(0), F.col("first_valid")), F.array_repeat(F.lit(1), n - F.col("first_valid") + 1))
    present = F.col("bos_present")
    return decided.withColumns({ids: F.when(present, F.col(ids)).otherwise(new_ids), mask: F.when(present, F.col(mask)).otherwise(new_mask)}).drop("first_valid")


def expand_placeholders(texts: DataFrame, grids: DataFrame, placeholder: str, example: str = "example", text: str = "text") -> DataFrame:
    """Replace each example's k-th placeholder by the k-th of its token strings.

    ``grids`` has example, ordinal (from 0) and tokens. Placeholders beyond
    the strings stay; strings beyond the placeholders are an error.
    """
    lists = grids.groupBy(example).agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "tokens"))), lambda x: x["tokens"]).alias("strings"))
    joined = texts.join(lists, example, "left").withColumn("strings", F.coalesce("strings", F.array().cast("array<string>")))
    pieces = F.split(F.col(text), "\\Q" + placeholder + "\\E", -1)
    filled = F.array_join(F.transform(pieces, lambda p, k: F.when(k == 0, p).otherwise(F.concat(F.coalesce(F.get(F.col("strings"), k - 1), F.lit(placeholder)), p))), "")
    over = F.size("strings") > F.size(pieces) - 1
    return joined.withColumn(text, F.when(over, F.raise_error(F.lit("more token strings than placeholders")).cast("string")).otherwise(filled)).drop("strings")
