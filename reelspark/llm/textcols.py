"""Column expressions on text that several operators share. White space is [\\x20\\x09-\\x0D]."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The six characters of [\x20\x09-\x0D].
WHITE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def without_white(text: Column) -> Column:
    """``text`` with white space deleted; null counts as empty. Byte search, no regex."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for c in WHITE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def n_words(text: Column) -> Column:
    """Number of maximal runs without white space; null: 0."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for c in WHITE[1:]:
        out = F.replace(out, F.lit(c), F.lit(" "))
    return F.size(F.array_remove(F.split(out, " "), "")).cast("long")


def free_name(name: str, taken: list[str]) -> str:
    """``name`` with as many underscores as it takes to be no column of ``taken``; names differ by more than case."""
    lower = {t.lower() for t in taken}
    while name in lower:
        name += "_"
    return name
