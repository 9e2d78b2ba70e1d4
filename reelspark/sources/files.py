"""Listings of media files and of the person images of clips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.functions.clips import clip_of_image, stem, with_suffix


def listing(spark: SparkSession, folder: str, pattern: str = "*.[mM][pP]4") -> DataFrame:
    """path, name (the stem), bytes of all files below ``folder`` whose name fits; contents are not read.

    Files without content are not listed, so what is listed counts as an output that is done.

    The folder's own name may hold brackets: it is escaped, so that it is no pattern.
    """
    safe = "".join("\\" + c if c in "[]{}*?" else c for c in folder)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(safe)
    return files.select("path", stem(F.col("path")).alias("name"), F.col("length").alias("bytes"))


#: Names of person images.
PERSON_IMAGES = ("*_person*.jpg", "*_person*.JPG", "*_person*.jpeg", "*_person*.JPEG")


def matching(files: DataFrame, patterns: tuple[str, ...] = PERSON_IMAGES) -> DataFrame:
    """The distinct rows of ``files`` (path and more) whose name fits one of several globs of ``*`` and ``?``."""
    name = F.substring_index("path", "/", -1)
    fits = F.lit(False)
    for p in patterns:
        regex = "".join({"*": ".*", "?": "."}.get(c, "\\" + c if not c.isalnum() and c != "_" else c) for c in p)
        fits = fits | name.rlike(f"^{regex}$")
    return files.filter(fits).distinct()


def without_normalised(files: DataFrame) -> DataFrame:
    return files.filter(~stem(F.col("path")).contains("_norm"))


def with_companions(subtitles: DataFrame, files: DataFrame) -> DataFrame:
    """``subtitles`` (path and more) with ``companion``: the path of the JSON transcript beside it, null where there is none."""
    there = files.select(F.col("path").alias("companion")).distinct()
    return subtitles.join(there, with_suffix(F.col("path"), ".json") == F.col("companion"), "left")


def person_images(files: DataFrame, normalised: bool) -> DataFrame:
    """clip, images: paths of each clip's person images in order, either the normalised copies or the others."""
    is_norm = stem(F.col("path")).contains("_norm")
    kept = files.filter(is_norm if normalised else ~is_norm).filter(stem(F.col("path")).rlike("_person"))
    return kept.groupBy(clip_of_image(F.col("path")).alias("clip")).agg(F.array_sort(F.collect_list("path")).alias("images"))
