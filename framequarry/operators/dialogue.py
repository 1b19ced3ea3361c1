"""Chat prompts: media placeholders, role order, text items and turns."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The markers of turns and media.
TURN_START, TURN_END, IMAGE, VIDEO = "<|im_start|>", "<|im_end|>", "<|image|>", "<|video|>"
#: Text styles that get no prefix.
PLAIN_STYLES = (
    "point_count pointing cosyn_point user_qa long_caption short_caption video_long_caption video_short_caption "
    "video_point_track_per_frame video_point_track_start_end video_point_track_all_frames video_single_point_track_start_end "
    "video_transcript video_clip_caption_start_end video_clip_caption_start_end_in_seconds video_clip_transcript_start_end "
    "video_clip_transcript_start_end_in_seconds video_frame_caption_timestamp video_frame_caption_timestamp_in_seconds correction_qa "
    "text_sft video_point video_point_count video_count video_count_point multi_image_pointing multi_image_counting "
    "multi_image_point_then_count multi_image_count_then_point demo a_okvqa_mc ai2_diagram_no_letter ai2_diagram science_qa "
    "multi_image_mc multi_image_mc_exp mantis_instruct_mc video_multiple_choice video_multiple_choice_count_without_pointing "
    "video_multiple_choice_multiple_correct video_multiple_choice_w_subtitle"
).split()


def placeholders(n_images: Column, n_videos: Column) -> Column:
    """Media markers before the turns: several images are numbered, one is not."""
    many = F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(n_images, F.lit(1)).cast("int")), lambda k: F.concat(F.lit("Image "), k.cast("string"), F.lit(IMAGE))), "")
    images = F.when(n_images > 1, many).when(n_images == 1, IMAGE).otherwise("")
    return F.concat(images, F.repeat(F.lit(VIDEO), n_videos.cast("int")))


def text_content(items: Column) -> Column:
    """Text items joined by spaces; one of an unknown style has the style before it. Empty items before the first text leave no space."""
    styled = lambda c: F.when(c["style"].isNotNull() & ~c["style"].isin(*PLAIN_STYLES), F.concat(c["style"], F.lit(": "), c["text"])).otherwise(c["text"])
    texts = F.transform(F.filter(items, lambda c: c["type"] == "text"), styled)
    return F.aggregate(texts, F.lit(""), lambda out, t: F.when(out == "", t).otherwise(F.concat(out, F.lit(" "), t)))


def media_count(items: Column, kind: str, keys: tuple[str, ...] = ()) -> Column:
    """Items of a kind: by their type, or by one of the fields ``keys`` that isn't null."""
    has = lambda c: [c[k].isNotNull() for k in keys]
    return F.size(F.filter(items, lambda c: reduce(or_, has(c), F.coalesce(c["type"] == kind, F.lit(False)))))


def render(messages: DataFrame, conv: str = "conv", pos: str = "pos", role: str = "role", content: str = "content", add_generation_prompt: bool = False, strict: bool = False) -> DataFrame:
    """conv, prompt, valid of each dialogue.

    ``content`` is a string, or an array of struct(type, text, style), where an
    item also counts as an image or a video if it has a field ``image``,
    ``image_url``, ``video`` or ``video_url`` that isn't null. Roles
    are compared in lower case. A leading "subtitle" message comes right
    after the media markers and stands outside the order of roles; later ones
    are left out but still count as positions. Positions are user at odd and
    assistant at even numbers; otherwise the dialogue is not valid, its prompt
    null (or, with ``strict``, an error). The turns of a dialogue meet in one
    row, as the prompt that they make does.
    """
    nested = dict(messages.dtypes)[content].startswith("array")
    c = F.col(content)
    fields = set(messages.schema[content].dataType.elementType.names) if nested else set()
    keys = {kind: tuple(k for k in (kind, f"{kind}_url") if k in fields) for kind in ("image", "video")}
    turn = F.struct(
        F.col(pos).alias("pos"),
        F.lower(role).alias("role"),
        (text_content(c) if nested else c).alias("text"),
        (media_count(c, "image", keys["image"]) if nested else F.lit(0)).alias("images"),
        (media_count(c, "video", keys["video"]) if nested else F.lit(0)).alias("videos"),
    )
    dialogues = messages.groupBy(conv).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    led = dialogues.withColumn("led", (F.get("turns", F.lit(0))["role"] == "subtitle").cast("int"))
    turns = F.filter(F.transform("turns", lambda t, k: F.struct((k + 1).alias("number"), t["role"].alias("role"), t["text"].alias("text"))), lambda t: t["role"] != "subtitle")
    wanted = lambda t: F.when((t["number"] - F.col("led")) % 2 == 1, "user").otherwise("assistant")
    valid = F.forall(turns, lambda t: t["role"] == wanted(t))
    start = F.lit(TURN_START)

    def show(t: Column) -> Column:
        opened = F.when(t["number"] == F.col("led") + 1, "").otherwise(TURN_END + "\n")
        user = F.concat(opened, start, F.lit("user\n"), t["text"], F.lit(TURN_END + "\n"))
        return F.when(t["role"] == "user", user).otherwise(F.concat(F.lit(" "), start, F.lit("assistant\n"), t["text"]))

    total = lambda name: F.aggregate("turns", F.lit(0), lambda n, t: n + t[name])
    subtitle = F.when(F.col("led") == 1, F.get("turns", F.lit(0))["text"]).otherwise("")
    prompt = F.concat(placeholders(total("images"), total("videos")), subtitle, F.array_join(F.transform(turns, show), ""), F.lit(TURN_START + "assistant\n" if add_generation_prompt else ""))
    bad = F.raise_error(F.lit("roles must alternate between user and assistant")).cast("string") if strict else F.lit(None).cast("string")
    return led.select(conv, F.when(valid, prompt).otherwise(bad).alias("prompt"), valid.alias("valid"))
