"""Ingest as a stream: each micro-batch of new files goes through the same steps as a batch run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textloom.pipeline import CurationPipeline


def stream_ingest(source: DataFrame, pipeline: CurationPipeline, order: str, dataset: str, checkpoint: str, once: bool = True, **options) -> StreamingQuery:
    """Run :meth:`CurationPipeline.ingest` on every micro-batch of a streaming DataFrame.

    The ingest log makes a micro-batch that is repeated after a failure harmless. ``once``
    handles what is there and stops; otherwise the query waits for more.
    """

    def handle(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            pipeline.ingest(batch, order, dataset, **options)

    writer = source.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def windowed_rates(scored: DataFrame, time: str, source: str, flag: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows and flagged rows per source and window of event time; rows later than the watermark are left out. For streams and tables."""
    return (
        scored.withWatermark(time, late).groupBy(F.window(time, window), source)
        .agg(F.count("*").alias("n"), F.count_if(F.col(flag)).alias("n_flagged"))
        .select(F.col("window.start").alias("window_start"), source, "n", "n_flagged")
    )
