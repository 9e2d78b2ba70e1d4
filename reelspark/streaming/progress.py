"""Progress of stages, counted while they run: no second scan of what they wrote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

#: Statuses that are counted.
STATUSES = ("COMPLETED", "FAILED", "NO_VALID_SPEAKER")


def _metrics(status: Column, statuses: tuple[str, ...]) -> list[Column]:
    other = ~F.coalesce(status.isin(*statuses), F.lit(False))
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(status == s).alias(s) for s in statuses], F.count_if(other).alias("other")]


def observed(items: DataFrame, observation: Observation, status: str = "status", statuses: tuple[str, ...] = STATUSES) -> DataFrame:
    """``items`` as they are, counted by status while whatever reads them runs; ``counts_of`` gives the counts afterwards."""
    return items.observe(observation, *_metrics(F.col(status), statuses))


def counts_of(spark: SparkSession, observation: Observation, statuses: tuple[str, ...] = STATUSES) -> DataFrame:
    """status, items: what ``observed`` counted; waits for the first action to end. Statuses without items have no row."""
    got = observation.get
    return spark.createDataFrame([(s, got[s]) for s in (*statuses, "other") if got[s]], "status string, items long")


class ProgressTable(StreamingQueryListener):
    """Appends a row a batch to the table ``path``: query, batch, input rows, and the counts by status of streams that ``observed_stream`` watches."""

    def __init__(self, spark: SparkSession, path: str, statuses: tuple[str, ...] = STATUSES):
        self.spark, self.path, self.statuses = spark, path, statuses
        self.schema = ", ".join(["query string", "batch long", "input_rows long", "rows long", *(f"`{s}` long" for s in (*statuses, "other"))])

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        counts = (p.observedMetrics or {}).get("stage")
        row = (p.name, p.batchId, p.numInputRows, *[counts[c] if counts else None for c in ("rows", *self.statuses, "other")])
        self.spark.createDataFrame([row], self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def observed_stream(items: DataFrame, status: str = "status", statuses: tuple[str, ...] = STATUSES) -> DataFrame:
    """A stream of items that tells a ``ProgressTable`` its counts batch by batch."""
    return items.observe("stage", *_metrics(F.col(status), statuses))
