"""A barrier over streams: a film is done, once, when what is upstream is done and none of its items is open."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Kinds of events: the list of items is complete; an item was found; an item is through. An item may be through before it is found.
UPSTREAM_DONE, FOUND, THROUGH = "upstream_done", "found", "through"


#: What is counted of a film: items found, items through, items of either, and whether upstream is done.
_COUNTS = ("found", "through", "either", "upstream")


class _Barrier(StatefulProcessor):
    """State of a film: how many items were found, are through, and are known by either; whether upstream is done; whether it was told.

    Its open items are those known by either that are not through.
    """

    def __init__(self, patience: float):
        self.patience = patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.film = handle.getValueState("film", StructType([*[StructField(c, LongType()) for c in _COUNTS], StructField("told", BooleanType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:  # noqa: N802
        items, through, either, upstream, told = self.film.get() if self.film.exists() else (0, 0, 0, 0, False)
        for part in rows:
            new = [int(part[c].sum()) for c in _COUNTS]
            items, through, either, upstream = items + new[0], through + new[1], either + new[2], upstream + new[3]
        done = upstream > 0 and either == through and not told
        if done and self.patience:
            # Told when the film has been quiet for a while; what comes before then counts.
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timer_values.getCurrentProcessingTimeInMs() + int(self.patience * 1000))
        told = told or (done and not self.patience)
        self.film.update((items, through, either, upstream, told))
        if done and not self.patience:
            yield pd.DataFrame({"film": [str(key[0])], "items": [items]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 (Spark passes them by these names)
        items, through, either, upstream, told = self.film.get()
        if upstream > 0 and either == through and not told:
            self.film.update((items, through, either, upstream, True))
            yield pd.DataFrame({"film": [str(key[0])], "items": [items]})

    def close(self) -> None:
        pass


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks (film, mark) counted by film within each batch, so that few rows a film meet in the task that keeps its state."""
    for batch in batches:
        table = pa.table({"film": batch["film"], **{c: pc.cast(pc.equal(batch["mark"], c), pa.int64()) for c in _COUNTS}})
        sums = table.group_by("film").aggregate([(c, "sum") for c in _COUNTS])
        yield from sums.select(["film", *[f"{c}_sum" for c in _COUNTS]]).rename_columns(["film", *_COUNTS]).to_batches()


def stream_barrier(events: DataFrame, film: str = "film", kind: str = "kind", item: str = "item", patience: float = 0) -> DataFrame:
    """film (text), items: a row a film, when it is done, exactly once over the life of the checkpoint.

    ``events`` is a stream of (film, kind, item), kinds as above; events may come late, twice and in any order. A film
    is done when upstream is done and every item found is through; one without items is done with upstream. Once told it is not told again, also if items are
    found later or the query is started anew. ``patience``: seconds that must pass without a new event before it is told. Rows of other kinds and
    of no film are passed over. State is three entries an item, of Spark's own deduplication, and one a film, kept by the session's state
    store (see ``rocksdb``). The items of a film are dealt to all tasks; only counts meet in one.
    """
    rows = events.select(F.col(film).cast("string").alias("film"), F.col(kind).cast("string").alias("kind"), F.col(item).cast("string").alias("item")).filter("film IS NOT NULL")
    kind_ = F.col("kind")
    marks = F.when(kind_.isin(FOUND, THROUGH), F.array(kind_, F.lit("either"))).when(kind_ == UPSTREAM_DONE, F.array(F.lit("upstream")))
    marked = rows.select("film", F.when(kind_ != UPSTREAM_DONE, F.col("item")).alias("item"), F.explode(marks).alias("mark"))
    schema = "film string, " + ", ".join(f"{c} long" for c in _COUNTS)
    counts = marked.dropDuplicates(["film", "item", "mark"]).select("film", "mark").mapInArrow(_summed, schema)
    if patience:
        # What was known before counts as an event too: it is heard, though it adds nothing.
        counts = counts.unionByName(rows.select("film", *[F.lit(0).cast("long").alias(c) for c in _COUNTS]))
    return counts.groupBy("film").transformWithStateInPandas(_Barrier(patience), "film string, items long", outputMode="Append", timeMode="ProcessingTime" if patience else "None")


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """The state store that stateful processors need, for the queries that are started inside."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before is not None else spark.conf.unset(_PROVIDER)
