"""Clip names, durations and paths. A clip name is ``scene_{n}_{start}_{end}.mp4``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Frames per second, and the fewest frames of a clip long enough to use.
FPS, LONG_FRAMES = 24, 48

_NAME = r"^scene_(\d+)_(\d+)_(\d+)"


def clip_name(number: Column, start: Column, end: Column) -> Column:
    """``scene_007_000120_000180.mp4``."""
    return F.concat(F.lit("scene_"), F.lpad(number.cast("string"), 3, "0"), F.lit("_"), F.lpad(start.cast("string"), 6, "0"), F.lit("_"), F.lpad(end.cast("string"), 6, "0"), F.lit(".mp4"))


def duration_by_prefix(name: Column) -> Column:
    """(end - start) / 24 where the name begins like a clip's; else null. For statistics."""
    start, end = (F.regexp_extract(name, _NAME, k).try_cast("long") for k in (2, 3))
    return (end - start) / F.lit(float(FPS))


def stem(name: Column) -> Column:
    """The last path component without its extension."""
    return F.regexp_replace(F.substring_index(name, "/", -1), r"\.[^.]*$", "")


def duration_by_suffix(name: Column) -> Column:
    """(end - start + 1) / 24 from the last two ``_`` parts of the stem; null where they are no numbers. For speaker detection."""
    parts = F.split(stem(name), "_")
    start, end = F.try_element_at(parts, F.lit(-2)).try_cast("long"), F.try_element_at(parts, F.lit(-1)).try_cast("long")
    return (end - start + 1) / F.lit(float(FPS))


def is_long_enough(name: Column, frames: int = LONG_FRAMES) -> Column:
    """Fewer than three parts, or no numbers: true (nothing says otherwise); else end > start and at least ``frames``."""
    parts = F.split(stem(name), "_")
    start, end = F.try_element_at(parts, F.lit(-2)).try_cast("long"), F.try_element_at(parts, F.lit(-1)).try_cast("long")
    return F.when((F.size(parts) < 3) | start.isNull() | end.isNull(), F.lit(True)).when(end <= start, F.lit(False)).otherwise(end - start >= frames)


def normalised_path(path: Column) -> Column:
    """The path of an image's normalised copy: ``_norm`` before the extension."""
    return F.regexp_replace(path, r"(\.[^./]*)$", "_norm$1")


def clip_of_image(path: Column) -> Column:
    """The clip that a person image belongs to: the stem without ``_person{n}`` and ``_norm``."""
    return F.regexp_replace(stem(path), r"_person\d*(_norm)?$", "")


def workspace_path(root: str, movie: Column, *parts: str) -> Column:
    return F.concat_ws("/", F.lit(root), movie, *[F.lit(p) for p in parts])


def relative_path(path: Column, root: Column) -> Column:
    """The path below ``root``; a path elsewhere stays whole."""
    base = F.concat(F.rtrim(root, F.lit("/")), F.lit("/"))
    return F.when(path.startswith(base), F.substr(path, F.length(base) + 1)).otherwise(path)


def with_suffix(path: Column, suffix: str) -> Column:
    """The path with another extension; one without gets it."""
    return F.concat(F.regexp_replace(path, r"(?<=[^/])\.[^./]*$", ""), F.lit(suffix))


def granularity(path: Column) -> Column:
    """What the entries of a subtitle file are: words of a transcript in JSON, else sentences."""
    return F.when(F.lower(path).endswith(".json"), F.lit("word")).otherwise(F.lit("sentence"))
