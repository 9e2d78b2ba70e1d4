"""Text helpers: speaker prefixes, ellipsis, tags, prompts, and JSON inside a model's answer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelspark.functions.times import nearest

#: Beginnings that name the speaker of a subtitle, in the order they are removed.
SPEAKER_PREFIXES = (
    r"(?i)^\[\s*SPEAKER[_\-\s]*\d+\s*\]\s*:?\s*",
    r"(?i)^SPEAKER[_\-\s]*\d+\s*:?\s*",
    r"(?i)^\[\s*UNKNOWN\s*\]\s*:?\s*",
    r"(?i)^UNKNOWN\s*:?\s*",
)
#: A subtitle line on the picture.
LINE_CHARS = 72

_EDGES = r"^\s+|\s+$"


def strip(text: Column) -> Column:
    """White space at both ends removed."""
    return F.regexp_replace(text, _EDGES, "")


def without_speaker(text: Column) -> Column:
    out = strip(text)
    for pattern in SPEAKER_PREFIXES:
        out = F.regexp_replace(out, pattern, "")
    return strip(out)


def ellipsis(text: Column, chars: int = LINE_CHARS) -> Column:
    """Texts longer than ``chars`` end in three dots, ``chars`` in all."""
    return F.when(F.length(text) > chars, F.concat(F.substring(text, 1, chars - 3), F.lit("..."))).otherwise(text)


def track_tag(track: Column) -> Column:
    """``T07``; UNK for no track."""
    return F.when(track.isNull(), F.lit("UNK")).otherwise(F.format_string("T%02d", track))


def track_name(track: Column) -> Column:
    """``Track 00007``; UNKNOWN for no track."""
    return F.when(track.isNull(), F.lit("UNKNOWN")).otherwise(F.format_string("Track %05d", track))


def track_file(track: Column) -> Column:
    return F.format_string("Track_%05d", track)


def character_tag(person: Column) -> Column:
    return F.concat(F.lit("<char_"), person.cast("string"), F.lit(">"))


def display_text(tag: Column, text: Column) -> Column:
    return F.concat(tag, F.lit(": "), text)


def has_words(text: Column) -> Column:
    """Whether any letter or digit, of any script, is in the text."""
    return F.coalesce(text.rlike(r"[\p{L}\p{N}]"), F.lit(False))


def speaking_label(name: str, score: Column, threshold: float) -> Column:
    """``Track | speaking | score=0.25``; no score is silent and NA. The nearest hundredth of the exact score."""
    hundredths = nearest(F.abs(score), 2)
    number = F.concat(F.when(score < 0, F.lit("-")).otherwise(F.lit("")), F.format_string("%d.%02d", F.floor(hundredths / 100), hundredths % 100))
    status = F.when(score >= threshold, F.lit("speaking")).otherwise(F.lit("silent"))
    return F.concat(F.lit(f"{name} | "), status, F.lit(" | score="), F.when(score.isNull(), F.lit("NA")).otherwise(number))


def prompt(face_visible: Column, shot_type: Column, opening: str, framing: Mapping[str, str], other_framing: str, facing: tuple[str, str], closing: tuple[str, str]) -> Column:
    """``opening``, the framing of the shot type, and the facing between the two closings; a null face counts as not visible."""
    shot = F.lit(other_framing)
    for name, text in framing.items():
        shot = F.when(shot_type == name, F.lit(text)).otherwise(shot)
    side = F.when(F.coalesce(face_visible, F.lit(False)), F.lit(facing[0])).otherwise(F.lit(facing[1]))
    return F.concat(F.lit(opening), shot, F.lit(closing[0]), side, F.lit(closing[1]))


def _braces(text: Column) -> Column:
    """From the first opening to the last closing brace; null where there is none."""
    found = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    return F.when(found != "", found)


def _without_fences(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("```json"), F.lit("")), F.lit("```"), F.lit(""))


def strict_json(text: Column) -> Column:
    """The text as VARIANT; null where it is not one JSON value and nothing else.

    The parser itself stops after the first value and takes what follows for granted, so the text is put
    into an array before a last element that must then be the second.
    """
    both = F.try_parse_json(F.concat(F.lit("["), text, F.lit(', "end"]')))
    whole = lambda v: (F.try_variant_get(v, "$[1]", "string") == "end") & F.try_variant_get(v, "$[2]", "variant").isNull()
    # As the variable of a function the array is parsed once, not once for each use.
    return F.get(F.transform(F.array(both), lambda v: F.when(whole(v), F.try_variant_get(v, "$[0]", "variant"))), 0)


def salvaged_json(answer: Column, variant: int = 1) -> Column:
    """The JSON in a model's answer, as VARIANT; null where none can be read.

    1: fences go, then everything up to the first ``assistant`` in any case, and a colon after it;
       if the rest is no JSON, the braces of the raw answer.
    2: fences go, nothing else; if the rest is no JSON, the braces of the raw answer.
    3: everything up to the first lower-case ``assistant`` goes, then fences; if the rest is no
       JSON, the braces of what was left.
    """
    if variant == 3:
        at = F.instr(answer, "assistant")
        rest = F.when(at > 0, F.substring(answer, at + 9, F.length(answer))).otherwise(answer)
        rest = strip(_without_fences(rest))
        return F.coalesce(strict_json(rest), strict_json(_braces(rest)))
    rest = strip(_without_fences(answer))
    if variant == 1:
        at = F.instr(F.lower(rest), "assistant")
        after = strip(F.substring(rest, at + 9, F.length(rest)))
        rest = F.when(at > 0, strip(F.regexp_replace(after, r"^:", ""))).otherwise(rest)
    return F.coalesce(strict_json(rest), strict_json(_braces(answer)))


def parse_status(parsed: Column, empty_is_error: bool = True) -> Column:
    """``success``, or ``parse_error`` where nothing was read or, unless it may be, what was read is empty."""
    if not empty_is_error:
        return F.when(parsed.isNull(), F.lit("parse_error")).otherwise(F.lit("success"))
    text = F.to_json(parsed)
    return F.when(parsed.isNull() | text.isin("{}", "[]", "null", "false", "0", '""'), F.lit("parse_error")).otherwise(F.lit("success"))
