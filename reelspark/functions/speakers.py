"""Speaker results of clips: JSON objects by character, or lists of characters, as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _speaking(entry: Column) -> Column:
    return F.coalesce(F.try_variant_get(entry, "$.is_speaking", "boolean"), F.lit(False))


def speaking_characters(result: Column) -> Column:
    """Names of the characters that speak, in order of name; empty where there are none or nothing can be read.

    An object has them as keys; an item of a list as ``char``, else ``char_id``, and without either it has no name.
    """
    by_name = F.map_keys(F.map_filter(F.try_variant_get(result, "$", "map<string,variant>"), lambda _, v: _speaking(v)))
    name = lambda k, v: F.nullif(F.try_variant_get(v, f"$.{k}", "string"), F.lit(""))
    items = F.filter(F.try_variant_get(result, "$", "array<variant>"), _speaking)
    listed = F.filter(F.transform(items, lambda v: F.coalesce(name("char", v), name("char_id", v))), lambda x: x.isNotNull())
    return F.array_sort(F.coalesce(by_name, listed, F.array().cast("array<string>")))


def any_speaking(result: Column) -> Column:
    """Whether any character speaks, named or not."""
    by_name = F.exists(F.map_values(F.try_variant_get(result, "$", "map<string,variant>")), _speaking)
    return F.coalesce(by_name, F.exists(F.try_variant_get(result, "$", "array<variant>"), _speaking), F.lit(False))


#: Fixed value: what a prompt says where no characters are known.
NO_CHARACTERS = "No specific main characters detected. Describe the scene generally."


def character_lines(characters: Column) -> Column:
    """A line a character for a prompt, from an array of struct(person_id, x_min, y_min, x_max, y_max); ``NO_CHARACTERS`` for none."""
    edges = ("x_min", "y_min", "x_max", "y_max")
    line = lambda c: F.format_string(
        "- <char_%s> is located at bounding box [" + ", ".join(f"{e}:%.3f" for e in edges) + "]\n", c["person_id"].cast("string"), *[F.coalesce(c[e].cast("double"), F.lit(0.0)) for e in edges]
    )
    return F.when(F.coalesce(F.size(characters), F.lit(0)) > 0, F.array_join(F.transform(characters, line), "")).otherwise(F.lit(NO_CHARACTERS))
