"""Subtitles and transcripts: reading cues and words, writing SRT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark.functions.clips import granularity
from reelspark.functions.texts import strip, without_speaker
from reelspark.functions.times import nearest, srt_seconds, srt_time
from reelspark.sources.records import tolerant_documents


def srt_cues(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, idx, start, end, text of the cues of SRT texts.

    Blocks are parted by blank lines; the number line may be missing, then the cue gets the number of cues
    kept so far plus one. Speakers' prefixes go from the texts. Cues with bad times, no length or then no text go.
    """
    clean = F.replace(F.replace(F.col(text), F.lit("\r\n"), F.lit("\n")), F.lit("﻿"), F.lit(""))
    blocks = texts.select(key, F.posexplode(F.split(strip(clean), r"\n\s*\n")).alias("block_no", "block"))
    rows = F.filter(F.transform(F.split("block", "\n"), lambda x: strip(x)), lambda x: x != "")
    blocks = blocks.select(key, "block_no", rows.alias("rows"))
    timed = F.get("rows", 0).contains("-->")
    at = F.when(timed, F.lit(0)).otherwise(F.lit(1))
    times = F.split(F.get("rows", at), "-->")
    parsed = blocks.select(
        key, "block_no",
        F.when(~timed, F.get("rows", 0).try_cast("long")).alias("own"),
        srt_seconds(F.get(times, 0)).alias("start"), srt_seconds(F.get(times, 1)).alias("end"),
        without_speaker(F.array_join(F.slice("rows", at + 2, F.greatest(F.size("rows"), F.lit(1))), " ")).alias("text"),
    )
    kept = parsed.filter("start IS NOT NULL AND end IS NOT NULL AND end > start AND text <> ''")
    count = F.row_number().over(Window.partitionBy(key).orderBy("block_no"))
    return kept.select(key, F.coalesce("own", count.cast("long")).alias("idx"), *_thousandths("start", "end"), "text")


def _thousandths(*names: str) -> list[Column]:
    return [(nearest(F.col(n), 3) / 1000.0).alias(n) for n in names]


def transcript_words(docs: DataFrame, key: str, doc: str = "doc") -> DataFrame:
    """key, idx, start, end, text of the words of VARIANT transcripts.

    Words are ``word_segments`` if that is a list, also an empty one, else those of all segments in order. The
    number counts all of them from 1; speakers' prefixes go from the texts, and words without bounds, length or then text afterwards.
    """
    listed = lambda v, path: F.try_variant_get(v, path, "array<variant>")
    flat = F.flatten(F.transform(listed(F.col(doc), "$.segments"), lambda s: F.coalesce(listed(s, "$.words"), F.array().cast("array<variant>"))))
    words = docs.select(key, F.posexplode(F.coalesce(listed(F.col(doc), "$.word_segments"), flat)).alias("pos", "w"))
    bound = lambda k: F.try_variant_get("w", f"$.{k}", "double").alias(k)
    rows = words.select(key, (F.col("pos") + 1).cast("long").alias("idx"), bound("start"), bound("end"), without_speaker(F.try_variant_get("w", "$.word", "string")).alias("text"))
    return rows.filter("start IS NOT NULL AND end IS NOT NULL AND end > start AND text <> ''").select(key, "idx", *_thousandths("start", "end"), "text")


def entries(texts: DataFrame, key: str) -> DataFrame:
    """key, idx, start, end, text, granularity of subtitle files (key, path, text), each read as its name says."""
    kind = granularity(F.col("path"))
    words = transcript_words(tolerant_documents(texts.filter(kind == "word")), key).withColumn("granularity", F.lit("word"))
    return words.unionByName(srt_cues(texts.filter(kind == "sentence"), key).withColumn("granularity", F.lit("sentence")))


def has_dialogue(doc: Column) -> Column:
    """Whether the segments' texts, or where they are empty the words', hold a letter or digit."""
    texts = F.try_variant_get(doc, "$.segments", "array<struct<text:string>>")
    words = F.try_variant_get(doc, "$.word_segments", "array<struct<word:string>>")
    said = F.array_join(F.transform(texts, lambda s: s["text"]), " ")
    spoken = F.array_join(F.transform(words, lambda w: w["word"]), " ")
    chosen = F.when(F.coalesce(strip(said), F.lit("")) != "", said).otherwise(F.coalesce(spoken, F.lit("")))
    return chosen.rlike(r"[\p{L}\p{N}]")


def cue_block(number: Column, start: Column, end: Column, speaker: Column, text: Column) -> Column:
    """A cue as SRT; no speaker is UNKNOWN."""
    times = F.concat(srt_time(start), F.lit(" --> "), srt_time(end))
    return F.concat_ws("\n", number.cast("string"), times, F.concat(F.lit("["), F.coalesce(speaker, F.lit("UNKNOWN")), F.lit("] "), strip(text)), F.lit(""))


def srt_texts(cues: DataFrame, key: str, order: str) -> DataFrame:
    """key, text: an SRT file a key, from cues (key, ``order``, start, end, speaker, text)."""
    number = F.row_number().over(Window.partitionBy(key).orderBy(order))
    blocks = cues.select(key, number.alias("n"), "start", "end", "speaker", "text")
    blocks = blocks.withColumn("block", cue_block(F.col("n"), F.col("start"), F.col("end"), F.col("speaker"), F.col("text")))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "block"))), lambda x: x["block"]), "\n")
    return blocks.groupBy(key).agg(joined.alias("text"))
