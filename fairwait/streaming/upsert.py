from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sinks.tables import read_text, upsert_table


def stream_upsert(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    part_col: str,
    checkpoint: str,
    ties: Sequence[str] = (),
    stable_partition: bool = False,
    once: bool = True,
) -> StreamingQuery:
    """Merge a stream of request versions into a partitioned table, the newest per key.

    Spark may deliver a micro-batch again after a failure; the stream's own id, which its
    checkpoint keeps, and the batch id make the repeat a no-op. Several streams, or one with a
    new checkpoint, may write to one table, one at a time. ``once`` takes what is there and stops (the daily run); otherwise the query
    keeps going. Versions arriving out of order are settled by ``order``.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        log = read_text(batch.sparkSession, f"{checkpoint}/metadata")
        upsert_table(
            batch, path, keys, order, part_col, f"{json.loads(log)['id']}-{batch_id}", ties, stable_partition
        )

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
