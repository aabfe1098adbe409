"""Incremental staging as a Structured Streaming query (§2.14 re-aim).

Landed raw files are a file source; each trigger hands the new rows to ``foreachBatch``, which
applies the staging model's incremental rule (rows of races not yet in the target, appended) to the
versioned target. ``trigger(availableNow=True)`` processes everything landed so far and stops, so a
scheduler runs it once per landing. The checkpoint location (under the session's shared checkpoint
folder) records which files were consumed; with the target's own commit log this makes a restarted
run skip work already committed.

Failure: if a trigger dies after the target commit but before the stream's own checkpoint commit,
the micro-batch is replayed; the incremental rule then finds its races already staged and appends
nothing, so a replay cannot duplicate rows.

Semantics: "first batch wins" applies per run. All files landed since the last run form one
micro-batch (no limit on files per trigger), so a race that is spread over several files of a landing
is staged whole, as in the batch pipeline; rows of a race that land after its run are dropped, also as there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paddock.operators import incremental as inc
from paddock.sinks.tables import VersionedTable


def stream_incremental_stage(spark: SparkSession, landing_dir: str, schema, target: VersionedTable, stage,
                             race_key, checkpoint: str, dealt_by: str | None = None) -> None:
    """Run one ``availableNow`` trigger over ``landing_dir`` (parquet, given ``schema``); ``dealt_by`` as in
    ``incremental_stage``."""
    raw = spark.readStream.schema(schema).parquet(landing_dir)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        inc.incremental_stage(target, batch, stage, race_key, dealt_by=dealt_by)

    q = (raw.writeStream.foreachBatch(apply)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
