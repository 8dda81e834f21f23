"""Append-only landing folders ingested with Structured Streaming.

For resources with an append disposition and no month filter (online status
snapshots), a file stream with a checkpoint remembers which landed files were
taken; ``availableNow`` processes everything new and stops, so it runs as a
batch job on a schedule. Each micro-batch is appended under the query's id
(kept in the checkpoint) and its batch number: a batch replayed after a failure
between the table commit and the stream's own commit is not above the table's
mark for that query and is not appended twice.

Archive bodies keep the batch ledger (``json_ingest.load_games_incrementally``):
a file stream would also mark files outside the month range as seen.
"""

from __future__ import annotations

from collections.abc import Callable
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.sources.store import TableStore


def ingest_new_files(spark: SparkSession, landing_dir: str, schema: T.StructType | str, store: TableStore,
                     table: str, checkpoint_dir: str, *, fmt: str = "json",
                     transform: Callable[[DataFrame], DataFrame] | None = None,
                     max_files_per_trigger: int | None = None) -> int:
    """Append every landed file not seen before to ``table``; returns the
    number of micro-batches run."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(landing_dir)
    if transform is not None:
        stream = transform(stream)
    batches, query_id, started = [], [], Event()

    def _append(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        load_id = f"stream-{query_id[0]}-{batch_id}"
        store.append_batch(table, batch.withColumn("_load_id", F.lit(load_id)), query_id[0], batch_id)
        batches.append(batch_id)

    q = (stream.writeStream.foreachBatch(_append)
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    query_id.append(str(q.id))
    started.set()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return len(batches)
