"""Order files to Bronze: raw, append only, each file read once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillflow.sources.orders import write_batch


def append_to_bronze(lines: DataFrame, bronze_path: str, checkpoint: str) -> None:
    """Drain what has arrived and stop. The checkpoint remembers the files read; each batch has a folder of its own."""
    query = (
        lines.writeStream.foreachBatch(lambda batch, number: write_batch(batch, f"{bronze_path}/batch-{number}"))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
