"""indicatormart: conformed indicator marts built with Spark DataFrames.

Layers:
  functions/  Column -> Column helpers (cleaning, numbers, periods, keys)
  operators/  DataFrame -> DataFrame steps (filters, joins, reshape, grain, quality)
  sources/    readers, sinks, the Spark session helper and test-table stand-ins
  plans/      the staging, reference and mart models composed from the above
  streaming/  notes on incremental use (the modelled warehouse has no streams)
"""

from indicatormart.session import get_spark, ensure_checkpoint_dir

__all__ = ["get_spark", "ensure_checkpoint_dir"]
