"""Media sources: listings, headers, decoding and frame scans, the model registry, and sinks."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: Suffixes of images and videos.
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "bmp", "webp")
VIDEO_SUFFIXES = ("mp4", "avi", "mkv", "mov", "wmv", "flv", "webm")

def has_suffix(path: Column, suffixes: tuple[str, ...]) -> Column:
    """Whether a path ends in one of the suffixes, in any case."""
    return F.lower(path).rlike(r"\.(" + "|".join(suffixes) + r")$")


def list_media(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = IMAGE_SUFFIXES, with_content: bool = False) -> DataFrame:
    """Files of a folder (not of those within it) with one of the suffixes: path, length, and content if asked for.

    Files are picked by their names while the folder is listed, in any case of
    the suffix, so that other files' contents are not read.
    """
    any_case = lambda s: "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in s)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").option("pathGlobFilter", "*.{" + ",".join(map(any_case, suffixes)) + "}").load(folder)
    return files.where(has_suffix(F.col("path"), suffixes)).select("path", "length", *(["content"] if with_content else []))


def video_header(headers: DataFrame) -> DataFrame:
    """``headers`` (clip, fps, total_frames, ...) with the duration in seconds, 0 where the rate isn't positive."""
    return headers.withColumn("duration", F.when(F.col("fps") > 0, F.try_divide(F.col("total_frames"), F.col("fps"))).otherwise(F.lit(0.0)))


def video_route(value: Column) -> Column:
    """How a video is loaded: "youtube", "http", "file" or null for no value."""
    host = F.lower(F.try_parse_url(value, F.lit("HOST")))
    tube = host.isin("www.youtube.com", "youtube.com", "youtu.be")
    return F.when(value.isNull(), F.lit(None).cast("string")).when(F.coalesce(tube, F.lit(False)), "youtube").when(F.startswith(value, F.lit("http://")) | F.startswith(value, F.lit("https://")), "http").otherwise("file")


def decode_images(files: DataFrame, decoder) -> DataFrame:
    """Decoded images: path, height, width, channels, data; files that the decoder can't read give no row.

    ``decoder()`` is called once a worker and returns a function from bytes
    to (height, width, channels, bytes), or None.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = decoder()
        for batch in batches:
            rows = [(p, *found) for p, c in zip(batch["path"], batch["content"], strict=True) if (found := read(bytes(c))) is not None]
            yield pd.DataFrame(rows, columns=["path", "height", "width", "channels", "data"])

    return files.select("path", "content").mapInPandas(run, "path string, height int, width int, channels int, data binary")


class FrameSource(DataSource):
    """``spark.read.format("frames")``: frames of videos, one partition a file.

    Options: ``paths`` (a JSON list) and ``decoder`` (``module:function`` with
    ``function(path)`` an iterator of (height, width, bytes)). Several
    decoders, divided by commas, are tried in turn until one opens the file.
    """

    @classmethod
    def name(cls) -> str:
        return "frames"

    def schema(self) -> str:
        return "clip string, frame_idx long, height int, width int, data binary"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _FrameReader(self.options)


class _FrameReader(DataSourceReader):
    def __init__(self, options):
        self.paths = json.loads(options["paths"])
        self.decoders = options["decoder"].split(",")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition):
        import importlib

        failure = None
        for name in self.decoders:
            module, _, function = name.partition(":")
            try:
                frames = iter(getattr(importlib.import_module(module), function)(partition.value))
                first = next(frames, None)
            except (ImportError, OSError, ValueError) as e:
                failure = e
                continue
            if first is not None:
                yield (partition.value, 0, *first)
                for k, frame in enumerate(frames, 1):
                    yield (partition.value, k, *frame)
            return
        raise RuntimeError(f"no decoder opens {partition.value}") from failure


def model_id(alias: Column, aliases: dict[str, str]) -> Column:
    """The model that an alias stands for; anything else stands for itself."""
    pairs = F.create_map(*(F.lit(x) for pair in aliases.items() for x in pair))
    return F.coalesce(F.try_element_at(pairs, alias), alias)


def model_path(kind: Column, name: Column, folders: dict[str, str], defaults: dict[str, str | None]) -> Column:
    """Path of a model by type and file name: the type's default file without a name, the folder where that is None; an unknown type is an error."""
    out = F.raise_error(F.concat(F.lit("unknown model type: "), F.coalesce(kind, F.lit("null")))).cast("string")
    for key, default in defaults.items():
        path = F.lit(folders[key]) if default is None else F.concat(F.lit(folders[key] + "/"), F.coalesce(F.nullif(name, F.lit("")), F.lit(default)))
        out = F.when(kind == key, path).otherwise(out)
    return out


def missing_models(required: DataFrame, present: DataFrame, key: str = "name") -> DataFrame:
    """Required models that are not there."""
    return required.join(present, key, "left_anti")


def all_present(required: DataFrame, present: DataFrame, key: str = "name") -> DataFrame:
    """One row: whether every required model is there (true for none)."""
    there = required.join(present.select(key, F.lit(True).alias("there")).distinct(), key, "left")
    return there.agg(F.coalesce(F.bool_and(F.coalesce("there", F.lit(False))), F.lit(True)).alias("all_present"))


def write_text_files(files: DataFrame, folder: str, name: str = "file_name", text: str = "text") -> DataFrame:
    """Write each row's text under its own name in a shared folder; returns path and size. Writing again overwrites."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for batch in batches:
            done = []
            for n, t in zip(batch[name], batch[text], strict=True):
                data = (t or "").encode()
                with store.open_output_stream(f"{root}/{n}", compression=None) as out:
                    out.write(data)
                done.append((f"{folder}/{n}", len(data)))
            yield pd.DataFrame(done, columns=["path", "bytes"])

    return files.select(name, text).mapInPandas(run, "path string, bytes long")


def write_clips(frames: DataFrame, encoder, folder: str) -> DataFrame:
    """Encode frames (file_name, frame_idx, data) into one file per name; the plug-in point for video writers.

    ``encoder(frames)`` turns the frames in order into bytes, or None where it
    can't; the result has file_name, n_frames and written.
    """

    def run(key, batch: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        data = encoder(batch.sort_values("frame_idx")["data"].tolist())
        if data is not None:
            with store.open_output_stream(f"{root}/{key[0]}", compression=None) as out:
                out.write(data)
        return pd.DataFrame([(key[0], len(batch), data is not None)], columns=["file_name", "n_frames", "written"])

    return frames.groupBy("file_name").applyInPandas(run, "file_name string, n_frames long, written boolean")
