"""Times as text: subtitles, minutes, hours. Numbers are cut or rounded as each format wants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CODE = r"^\s*(\d+):(\d+):(\d+),(\d+)\s*$"


def half_even(x: Column, digits: int) -> Column:
    """Rounding of halves to even, on the decimal value of the number."""
    return F.bround(x, digits)


def srt_time(seconds: Column) -> Column:
    """``HH:MM:SS,mmm``; parts of a millisecond are cut."""
    whole = F.floor(seconds).cast("long")
    ms = ((seconds - whole) * 1000).cast("int")
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(whole / 3600), F.floor((whole % 3600) / 60), whole % 60, ms)


def srt_seconds(code: Column) -> Column:
    """Seconds of ``HH:MM:SS,mmm``; null for any other form."""
    h, m, s, ms = (F.regexp_extract(code, _CODE, k).try_cast("double") for k in range(1, 5))
    return h * 3600 + m * 60 + s + ms / 1000


def nearest(x: Column, digits: int) -> Column:
    """The whole number nearest to x * 10^``digits``, for x from 0 and up to three digits: of the exact value of x, halves to even.

    The product is kept in two doubles: the number's upper bits, which a float holds, and the rest are multiplied without loss.
    """
    x = x.cast("double")
    high = x.cast("float").cast("double")
    a, b = high * float(10**digits), (x - high) * float(10**digits)
    whole = F.floor(a + b)
    over = (a + b - whole - 0.5) + ((a - (a + b)) + b)
    return whole + ((over > 0) | ((over == 0) & (whole % 2 == 1))).cast("long")


def minutes_text(seconds: Column) -> Column:
    """``MM:SS.ss``; the seconds to the nearest hundredth of their exact value, without carrying over."""
    minutes = F.floor(seconds / 60)
    hundredths = nearest(seconds % 60, 2)
    return F.format_string("%02d:%02d.%02d", minutes, F.floor(hundredths / 100), hundredths % 100)


def duration_text(seconds: Column) -> Column:
    """``1h 2m 3.4s``, without the leading units that are zero; the seconds to the nearest tenth of their exact value, without carrying over."""
    h, m = F.floor(seconds / 3600), F.floor((seconds % 3600) / 60)
    tenths = nearest(seconds % 60, 1)
    s = F.format_string("%d.%ds", F.floor(tenths / 10), tenths % 10)
    minutes = F.concat(m.cast("string"), F.lit("m "), s)
    return F.when(h > 0, F.concat(h.cast("string"), F.lit("h "), minutes)).when(m > 0, minutes).otherwise(s)


def frames_to_seconds(frames: Column, fps: Column | float) -> Column:
    return frames / (F.lit(fps) if isinstance(fps, (int, float)) else fps)


def media_duration(frames: Column, fps: Column) -> Column:
    """Seconds of a file in thousandths; null where it tells no frames or no rate."""
    return F.when((fps > 0) & (frames > 0), F.round(frames / fps, 3))


def audio_slice(start: Column, end: Column, fps: float, rate: int, samples: Column) -> tuple[Column, Column]:
    """First and last sample of a range of frames, inside the audio; both null where nothing is left."""
    first = F.greatest(F.lit(0).cast("long"), (start / F.lit(fps) * rate).cast("long"))
    last = F.least(samples.cast("long"), (end / F.lit(fps) * rate).cast("long"))
    return F.when(first < last, first), F.when(first < last, last)


def common_rows(audio: Column, video: Column) -> tuple[Column, Column]:
    """Feature rows of audio (100 a second) and video (25 a second) that are used together: whole groups of four of the audio."""
    length = F.least((audio - audio % 4) / F.lit(100.0), video.cast("double"))
    return half_even(length * 100, 0).cast("long"), half_even(length * 25, 0).cast("long")
