"""Streaming ingest of landed status files into the snapshot fact.

A file-source stream over the landing folder replaces the 30-minute batch
poll: each micro-batch is typed, joined to the station dimension as it is then, and
those of its snapshots that the fact doesn't hold yet are appended (:func:`insert_new`).
Files may come in any order, late or repeated under another name: the fact's key
decides, so nothing is lost to a stream watermark and no state grows with the stream.  The
checkpoint folder records which files were consumed, so a restarted query neither
skips nor repeats a file; ``availableNow`` drains what has landed and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dockstat.operators.enrich import status_history
from dockstat.operators.incremental import insert_new
from dockstat.operators.joins import release_broadcasts
from dockstat.operators.staging import stage_station_status
from dockstat.plans.marts_core import fct_status_snapshots
from dockstat.sources.gbfs import JUDGED, read_gbfs_stream, read_judged_stream
from dockstat.sources.quarantine import put_aside, with_mended


def stream_status_to_fact(spark: SparkSession, landing: str, stations: DataFrame | Callable[[SparkSession], DataFrame],
                          fact_path: str, checkpoint: str, available_now: bool = True,
                          processing_time: str | None = None, max_files_per_trigger: int | None = None,
                          quarantine: str | None = None) -> StreamingQuery:
    """Start the stream.

    ``stations`` is the enriched station dimension, or a function that reads it: that is called
    for every micro-batch, so stations that appear while the stream runs are known.  With
    ``quarantine`` unreadable files and unfit items are put aside there (see
    :mod:`dockstat.sources.quarantine`); without it they fail the stream.
    """
    read = read_judged_stream if quarantine else read_gbfs_stream
    raw = read(spark, landing, "station_status", max_files_per_trigger)

    def merge(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        try:
            if quarantine:
                batch, mended = with_mended(session, batch, "station_status", landing, quarantine, number)
                put_aside(batch, mended, quarantine, number)
                batch = batch.filter(F.col("problem").isNull()).drop(*JUDGED)
            known = stations(session) if callable(stations) else stations
            insert_new(fact_path, fct_status_snapshots(status_history(stage_station_status(batch), known)))
        finally:
            release_broadcasts()

    w = raw.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "30 minutes")
    return w.start()
