"""Landing ingest: an unbounded event stream appended to date/hour partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# Fixed value: a micro-batch closes after 60 seconds.
FLUSH_SECONDS = 60


def source_limits(fmt: str, max_rows: int | None = None, max_files: int | None = None) -> dict[str, str]:
    """Reader options that bound a micro-batch; without a limit it takes what has arrived, so no rate is a ceiling."""
    name, limit = ("maxOffsetsPerTrigger", max_rows) if fmt == "kafka" else ("maxFilesPerTrigger", max_files)
    return {} if limit is None else {name: str(limit)}


def land_stream(stream: DataFrame, path: str, checkpoint: str, parts: Sequence[str] = ("event_date", "event_hour"),
                seconds: int = FLUSH_SECONDS, drain: bool = False) -> StreamingQuery:
    """Append the stream to Parquet partitions.

    Offsets advance in the checkpoint after a batch is written and the file sink logs its batches, so a restart
    neither loses nor repeats rows. ``drain`` processes what is available and stops.
    """
    writer = (stream.writeStream.format("parquet").outputMode("append").partitionBy(*parts)
              .option("path", path).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=f"{seconds} seconds")
    return writer.start()


def drain(query: StreamingQuery, timeout: int = 600) -> None:
    """Let a bounded run finish; an error of the stream is raised here."""
    if not query.awaitTermination(timeout):
        query.processAllAvailable()
        query.stop()
    if query.exception():
        raise query.exception()


def replay(stream: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Read the retained log again from its start: a new checkpoint and a new target."""
    return land_stream(stream, path, checkpoint, drain=True, **options)
