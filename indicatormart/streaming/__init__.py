"""Streaming.

The modelled warehouse rebuilds every model in full (views and tables); it
has no stream, watermark, late-data rule or incremental model, so nothing
here is stream-specific.  The row-level staging models are stateless
DataFrame functions, so they also accept a streaming DataFrame unchanged
(``spark.readStream...`` in, ``writeStream`` out); the grain and registry
steps need whole tables and run as batch jobs over what the stream wrote.
"""

from indicatormart.streaming.batches import stage_stream

__all__ = ["stage_stream"]
