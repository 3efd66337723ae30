"""Apply a staging model to a file stream, publishing exactly once."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame


def stage_stream(stream: DataFrame, model: Callable[[DataFrame], DataFrame], path: str,
                 checkpoint: str, trigger_once: bool = True):
    """Run the stateless ``model`` on ``stream`` and append its rows as parquet
    under ``path``.  The file sink logs the files of each micro-batch, so a
    retried batch is not read twice.  ``checkpoint`` must be a shared folder
    (the stream's progress log), e.g. under ``spark.checkpoint.dir``."""
    writer = (model(stream).writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
