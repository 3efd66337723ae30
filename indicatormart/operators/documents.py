"""Semi-structured documents (JSON) -> rows.

Documents are read with a typed schema (see :mod:`indicatormart.sources.readers`)
and flattened with ``explode``; each document is handled inside its own row,
so several documents never share an index or an aggregate.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType, VariantType

from indicatormart.functions._util import as_col, ColumnOrName


def _spread(df: DataFrame, n: int | None) -> DataFrame:
    """Round-robin the exploded rows over ``n`` partitions (one large document
    is read by one task; its rows need not stay there)."""
    return df.repartition(n) if n else df


def is_variant(df: DataFrame, col: str) -> bool:
    """True when ``col`` holds VARIANT (a document read without a schema)."""
    return isinstance(df.schema[col].dataType, VariantType)


def typed(df: DataFrame, payload: str, schema: StructType) -> DataFrame:
    """A VARIANT payload cast to ``schema`` (missing or mistyped fields -> NULL);
    a struct payload is returned unchanged."""
    if not is_variant(df, payload):
        return df
    return df.withColumn(payload, F.try_variant_get(F.col(payload), "$", schema.simpleString()))


def prop(df: DataFrame, props: str, name: str, to: str = "string") -> Column:
    """Field ``name`` of a properties column that is a struct or a VARIANT."""
    if is_variant(df, props):
        return F.try_variant_get(F.col(props), f"$.{name}", to)
    return F.col(f"{props}.{name}").cast(to)


def explode_features(df: DataFrame, payload: str = "payload", spread: int | None = None) -> DataFrame:
    """GeoJSON FeatureCollection -> one row per feature: ``props``, ``geom``.

    ``geom`` is the geometry as GeoJSON text (a string geometry is kept as is).
    Documents without features produce no rows.  A VARIANT payload keeps
    ``props`` as VARIANT (any property set) and serialises the geometry from
    VARIANT (object keys then come out sorted).
    """
    if is_variant(df, payload):
        feats = df.select(F.explode(F.try_variant_get(F.col(payload), "$.features", "array<variant>")).alias("f"))
    else:
        feats = df.select(F.explode(F.col(f"{payload}.features")).alias("f"))
    return feature_rows(_spread(feats, spread), "f")


def feature_rows(df: DataFrame, feature: str = "element") -> DataFrame:
    """``props`` and ``geom`` of features, one per row (as :func:`elements.read_elements` reads them from large documents)."""
    feats = df.select(F.col(feature).alias("f"))
    if is_variant(feats, "f"):
        return feats.select(F.try_variant_get(F.col("f"), "$.properties", "variant").alias("props"),
                            F.to_json(F.try_variant_get(F.col("f"), "$.geometry", "variant")).alias("geom"))
    geom_type = feats.schema["f"].dataType["geometry"].dataType
    geom = F.col("f.geometry") if isinstance(geom_type, StringType) else F.to_json(F.col("f.geometry"))
    return feats.select(F.col("f.properties").alias("props"), geom.alias("geom"))


def key_position(columns: Column, code: str) -> Column:
    """1-based position of ``code`` (case-insensitive) in ``columns[*].code``, 0 if absent."""
    codes = F.transform(columns, lambda c: F.lower(c["code"]))
    return F.array_position(codes, F.lit(code.lower()))


def flatten_pxweb(df: DataFrame, codes: dict[str, str], payload: str = "payload",
                  value_index: int = 0, value_col: str = "obs_raw", spread: int | None = None) -> DataFrame:
    """PXWeb matrix (``columns[]``, ``data[{key[], values[]}]``) -> rows.

    ``codes`` maps output column -> variable code; each key position is looked
    up in the same document's ``columns`` (so column order may differ between
    documents).  Missing codes or short keys give NULL, not an error.  A
    VARIANT payload is cast to the matrix shape first.
    """
    from indicatormart.sources.schemas import PXWEB_SCHEMA
    df = typed(df, payload, PXWEB_SCHEMA)
    positions = {out: key_position(F.col(f"{payload}.columns"), code) for out, code in codes.items()}
    base = _spread(df.select(*[p.alias(f"__pos_{out}") for out, p in positions.items()],
                             F.explode(F.col(f"{payload}.data")).alias("d")), spread)
    outs = [F.get(F.col("d.key"), F.col(f"__pos_{out}") - 1).cast("string").alias(out) for out in codes]
    return base.select(*outs, F.get(F.col("d.values"), F.lit(value_index)).cast("string").alias(value_col))


def json_path(c: ColumnOrName, path: str, to: str | None = None) -> Column:
    """Value at a JSONPath in a JSON string column (``$.a.b[0]``), optionally cast."""
    v = F.get_json_object(as_col(c), path)
    return v.try_cast(to) if to else v


def variant_path(c: ColumnOrName, path: str, to: str = "string") -> Column:
    """Same through VARIANT: ``try_variant_get(parse_json(c), path, to)``."""
    return F.try_variant_get(F.try_parse_json(as_col(c)), path, to)


def explode_series(df: DataFrame, payload: str = "payload",
                   series_fields: Sequence[str] = ("kpi_id", "region_id")) -> DataFrame:
    """Series document ``{data: [{kpi_id, region_id, values: [...]}]}`` -> one
    row per value: the series fields plus every field of the value struct.
    A VARIANT payload is cast to the series shape first."""
    from indicatormart.sources.schemas import SERIES_SCHEMA
    df = typed(df, payload, SERIES_SCHEMA)
    s = df.select(F.explode(F.col(f"{payload}.data")).alias("s"))
    v = s.select(*[F.col(f"s.{f}").alias(f) for f in series_fields],
                 F.explode(F.col("s.values")).alias("v"))
    return v.select(*series_fields, "v.*")
