"""Intermediate tables in the folder that the cluster shares.

Long jobs cut their lineage by writing a Parquet table below ``spark.checkpoint.dir`` and reading
it again: the files outlive any executor, and columns can be pruned on the second read. Tables of steps that
are over are removed; those that a lazy result still reads stand in the application's own folder, which ``clear`` removes.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Held while a table is written. Nothing reads the shuffles of the write once the table stands, so they need not wait for the
#: driver's garbage collection.
_WHILE_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
_written: list[str] = []  # paths of all tables, in the order they were written
_own: dict[str, str] = {}  # application id -> folder, where the cluster names none


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset (tests), one of our own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own:
        if spark.sparkContext.master.startswith("local["):
            _own[app] = tempfile.mkdtemp(prefix="spark-reelspark-")
        else:
            _own[app] = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return _own[app]


def app_dir(spark: SparkSession) -> str:
    """This application's folder in the shared one."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"


def unique(name: str) -> str:
    """``name`` with an ending that no other run has."""
    return f"{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: list[str] | None = None, batch: str = "8m", group_rows: int | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back with the schema it was written with.

    ``batch``: bytes that go to Python at once, up to the row that passes them: rows of some megabytes go few at a time. ``group_rows``: rows in a row group at most, for rows of
    some megabytes. A group is held whole by its writer and its readers, and each column's page once more for its compression; left
    alone, Parquet looks at their sizes at the hundredth row first, and a file of fewer rows is one group with one page a column.
    """
    spark = df.sparkSession
    path = f"{app_dir(spark)}/{unique(name)}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    if group_rows:
        writer = writer.option("parquet.block.row.count.limit", group_rows)
    held = _WHILE_WRITING | {"spark.sql.execution.arrow.maxBytesPerBatch": batch}
    before = {k: spark.conf.get(k, None) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        writer.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch_path = path
    _written.append(path)
    return table


def mark() -> int:
    """A point in time for ``removed_since``."""
    return len(_written)


def removed_since(spark: SparkSession, point: int, keep: DataFrame) -> None:
    """Delete the tables written since ``point`` but for ``keep``; for when ``keep`` is all that is still read of them."""
    for path in _written[point:]:
        if path != getattr(keep, "_scratch_path", None):
            _delete(spark, path)
    del _written[point:]


def removed(*tables: DataFrame) -> None:
    """Delete tables that ``written`` gave; for those that nothing reads any more, since what came of them is written too."""
    for table in tables:
        if path := getattr(table, "_scratch_path", None):
            _delete(table.sparkSession, path)


def removed_part(table: DataFrame, part: str) -> None:
    """Delete one folder, such as ``round=0``, of a table that was written with ``partition_by``; the other parts can still be read."""
    _delete(table.sparkSession, f"{table._scratch_path}/{part}")


def clear(spark: SparkSession) -> None:
    """Delete all tables of this application; for when every result that reads one is stored elsewhere."""
    _delete(spark, app_dir(spark))


def _delete(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
