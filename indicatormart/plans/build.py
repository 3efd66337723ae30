"""Full warehouse build: staging and marts published as views, the reference
layer (dimensions, facts) written as tables in their own database."""

from __future__ import annotations

from pyspark.sql import DataFrame

from indicatormart.plans.warehouse import MARTS, REFERENCE, STAGING, Warehouse
from indicatormart.sources.sinks import publish

# Models the modelled warehouse publishes as views inside the reference layer.
REFERENCE_VIEWS = ("dim_region_geojson", "ref_physicians_per_1000_y")


def build_warehouse(wh: Warehouse, path: str, ref_database: str = "REF",
                    partitions: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """Publish every model in dependency order and return the published relations.

    ``path`` is a shared folder (e.g. under ``spark.checkpoint.dir`` or the
    lake); each reference table is written once to ``{path}/{name}`` and
    registered in ``ref_database``, so marts read the written tables.
    ``partitions`` maps a reference table to its partition columns (e.g.
    ``{"fct_kolada_y": ["year"]}``).
    """
    out: dict[str, DataFrame] = {}
    for name in STAGING:
        out[name] = publish(wh.model(name), name, kind="view")
    for name in REFERENCE:
        if name in REFERENCE_VIEWS:
            out[name] = publish(wh.model(name), name, kind="view")
        else:
            out[name] = publish(wh.model(name), name, kind="table", database=ref_database,
                                path=f"{path.rstrip('/')}/{name}", partition_by=(partitions or {}).get(name))
            wh.use(name, out[name])   # later models read the written table
    for name in MARTS:
        out[name] = publish(wh.model(name), name, kind="view")
    return out
