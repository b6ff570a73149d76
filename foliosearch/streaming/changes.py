"""A stream of index commands, applied to an index table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from foliosearch.operators.maintain import COMMAND_SCHEMA, UNREADABLE
from foliosearch.plans.index_table import IndexTable
from foliosearch.session import shared_folder


def read_commands(spark, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Commands as JSON lines, dropped into a folder.  A line that is no command is kept as text, to be rejected."""
    reader = spark.readStream.schema(f"{COMMAND_SCHEMA}, {UNREADABLE} string").option("columnNameOfCorruptRecord", UNREADABLE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def maintain_index(
    commands: DataFrame,
    source: DataFrame,
    index: IndexTable,
    name: str,
    *,
    sync: bool = True,
    interval: str = "1 minute",
    recursive: bool = True,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Start applying commands to ``index``; the newest per document wins, in
    whatever batch it comes.  Refused commands are kept in ``index.rejects()``.

    ``sync=True`` works off what is there, waits and stops; otherwise the query
    goes on in the background, one batch per ``interval``.  A batch that is
    replayed after a failure is recognised by its number and by the id that the
    checkpoint gives the query, and is applied once.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        label = f"{name} {query_id or checkpoint} batch {batch_id}"
        index.apply_commands(batch, source, label, recursive=recursive)

    checkpoint = checkpoint or f"{shared_folder(commands.sparkSession)}/streams/{name}"
    writer = commands.writeStream.queryName(name).foreachBatch(apply).option("checkpointLocation", checkpoint)
    if not sync:
        return writer.trigger(processingTime=interval).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
