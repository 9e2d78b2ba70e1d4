"""Models from outside as columns: a callable on lists of inputs becomes an Arrow-batched function.

Networks, codecs and pixels are not part of this library. An annotator is registered under a name
with the type of what it returns; a job then uses it like any column function. A failing item
gives an error, not a failed job: the batch is tried as a whole, then item by item.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_known: dict[str, Callable[[Column], Column]] = {}


def register_annotator(name: str, load: Callable[[], Callable[[list], list]], returns: str) -> Callable[[Column], Column]:
    """Column function giving struct(value, error). ``load`` makes the model, once for each task that runs it."""

    @F.pandas_udf(f"value {returns}, error string")
    def annotate(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            items = batch.tolist()
            try:
                found = [(v, None) for v in model(items)]
            except Exception:  # one bad item must not cost the others
                found = [_one(model, x) for x in items]
            yield pd.DataFrame(found, columns=["value", "error"])

    _known[name] = annotate
    return annotate


def _one(model: Callable[[list], list], item) -> tuple:
    try:
        return model([item])[0], None
    except Exception as e:
        return None, f"{type(e).__name__}: {e}"


def annotator(name: str) -> Callable[[Column], Column]:
    return _known[name]
