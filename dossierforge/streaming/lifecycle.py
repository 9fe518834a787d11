"""The batch transforms over a stream of records: each micro-batch merges into the lifecycle table that batch runs use as well."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources.keyed import KeyedTable, update_lifecycle


def merge_stream(records: DataFrame, table: str, run_at: str, checkpoint: str, order: str | None = None) -> StreamingQuery:
    """records(company_id, content_hash[, order]) into the lifecycle table at `table`, a version for each micro-batch.

    Of several rows of a key in one batch the latest by `order` counts, then the greatest hash. The table remembers the number of the checkpoint's last batch, so a
    batch that runs again after a restart changes nothing.
    """
    order_column = order or "content_hash"

    def merge(batch: DataFrame, epoch: int) -> None:
        update_lifecycle(KeyedTable(batch.sparkSession, table, name=None), batch, run_at, order_column, (checkpoint, epoch))

    return records.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
