"""Stream-triggered landing intake.

Structured Streaming's file source remembers paths, so a file re-sent at
the same path with a new size or time would never be seen again, while the
ledger must register it (L1). The stream here is therefore only a trigger:
each micro-batch runs the ledger-based ``Pipeline.ingest``, which lists the
landing folder and registers by the natural key. With
``trigger(availableNow=True)`` this is the daily run as a restartable
streaming query whose progress is kept in its checkpoint location.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from depotlens.plans.pipeline import SYSTEMS, Pipeline

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def ingest_handler(pipeline: Pipeline, landing_root: str,
                   clock: Callable[[], dt.datetime] | None = None,
                   systems=SYSTEMS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: on new paths, run the ledger intake."""
    now = clock or (lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0))

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        pipeline.ingest(landing_root, now(), systems=systems)

    return handle


def start_intake(spark: SparkSession, pipeline: Pipeline, landing_root: str, checkpoint_location: str,
                 system: str = "complaints", available_now: bool = True,
                 clock: Callable[[], dt.datetime] | None = None) -> StreamingQuery:
    """Watch ``<landing_root>/<system>`` for new files and ingest them."""
    # only the path is selected: file content is never read by the trigger
    paths = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
             .option("pathGlobFilter", "*.{csv,json,xml}")
             .load(f"{landing_root.rstrip('/')}/{system}").select("path"))
    w = paths.writeStream.foreachBatch(ingest_handler(pipeline, landing_root, clock, systems=(system,)))
    w = w.option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    return w.start()
