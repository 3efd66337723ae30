"""Raw source names, their column names and typed document schemas.

Fixed values: the raw column names below are the ones the public statistics
extracts carry (quoted, mixed case, non-ASCII, with blanks and slashes; the
personnel measure column holds a SOFT HYPHEN U+00AD).  Raw measures are read
as strings and parsed by the cleaning functions.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, IntegerType, LongType, StringType, StructField,
                               StructType, DoubleType)

# Raw source table names.
RAW_SOURCES = (
    "KOLADA_RAW", "DATAEXPORT_RAW", "SCB_POPULATION_RAW", "GEO_LAN_REGIONS_RAW",
    "OVERCROWDING_RAW", "BEDS_REGION_RAW", "BEDS_INTL_RAW", "MEDICAL_PERSONNEL_RAW",
    "NET_COST_RAW", "EXPENDITURE_GDP_RAW", "STAT_KON_ALDER_RAW", "STAT_DIAGNOS_RAW",
    "PHYSICIANSPER1000_RAW", "HEALTH_EXPENDITURE_INTL_RAW",
)

# Raw column names per source.
KOLADA_COLS = ("Område", "Kön", "NYCKELTALSID", "NYCKELTAL", "NYCKELTALSBESKRIVNING")
DATAEXPORT_COLS = ("ENHETSNAMN", "ENHETSTYP", "REGIONSKOD", "ENHETSKOD", "Kön/Totalt", "Indikator-Id",
                   "TITEL", "Måttenhet", "Mätperiod", "Värde", "Täljare", "Nämnare/antal fall")
BEDS_REGION_COLS = ("Enhetsnamn", "Enhetstyp", "Regionskod", "Indikator-Id", "Titel", "Diagramrubrik",
                    "Mätperiod", "Värde", "Register/källa")
BEDS_INTL_COLS = ("REF_AREA", "Reference area", "OBS_VALUE", "STRUCTURE_NAME", "Unit of measure",
                  "TIME_PERIOD")
PERSONNEL_VALUE_COL = "86 Hälso­ och sjukvård"
PERSONNEL_COLS = ("År", "Grupp", "Område", "Kön", PERSONNEL_VALUE_COL)
NET_COST_COLS = ("Enhetsnamn", "Regionskod", "Enhetstyp", "Kön/Totalt", "Ålder", "Mätperiod",
                 "Måttenhet", "Värde", "Titel", "Diagramrubrik", "Register/källa")
EXPENDITURE_COLS = ("Year", "Totala hälso- och sjukvårdsutgifter, mnkr", "BNP till marknadspris, mnkr",
                    "BNP relationstal, procent")
KON_ALDER_COLS = ("Year", "Month", "Metric", "Value", "Region/landsting/akutmottagning", "Kön", "Ålder",
                  "PERIOD")
DIAGNOS_COLS = ("Year", "Month", "Metric", "Value", "Region", "Diagnosgrupp", "PERIOD")
PHYSICIANS_COLS = ("REGION_NAME", "YEAR", "VALUE")
HEALTH_INTL_COLS = ("REFERENCE_AREA", "TIME_PERIOD", "OBS_VALUE", "UNIT_OF_MEASURE")
OVERCROWDING_CATEGORY = "CATEGORY"


def string_schema(cols) -> StructType:
    """All-string schema for a CSV extract (no inference)."""
    return StructType([StructField(c, StringType(), True) for c in cols])


# PXWeb matrix response: columns[] describe the key positions, data[] holds rows.
PXWEB_SCHEMA = StructType([
    StructField("columns", ArrayType(StructType([
        StructField("code", StringType()), StructField("text", StringType()),
        StructField("type", StringType())]))),
    StructField("data", ArrayType(StructType([
        StructField("key", ArrayType(StringType())),
        StructField("values", ArrayType(StringType()))]))),
])

GEOJSON_SCHEMA = StructType([
    StructField("type", StringType()),
    StructField("features", ArrayType(StructType([
        StructField("type", StringType()),
        StructField("properties", StructType([
            StructField("scb_lan_code_2", StringType()),
            StructField("region_name_official", StringType())])),
        StructField("geometry", StringType())]))),
])

# KPI series document: data[{kpi_id, region_id, values[{period, gender, value}]}]
SERIES_SCHEMA = StructType([
    StructField("source", StringType()),
    StructField("fetched_at", StringType()),
    StructField("data", ArrayType(StructType([
        StructField("kpi_id", StringType()),
        StructField("region_id", StringType()),
        StructField("values", ArrayType(StructType([
            StructField("period", IntegerType()),
            StructField("gender", StringType()),
            StructField("value", DoubleType())])))]))),
])

TAXONOMY_SCHEMA = StructType([
    StructField("source_system", StringType()),
    StructField("source_indicator_code", StringType()),
    StructField("topic", StringType()),
    StructField("polarity", StringType()),
])
