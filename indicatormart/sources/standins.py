"""Raw sources derived from the TPC-H-like test tables.

The test data has no health statistics, so each raw extract is re-expressed
from the given tables with the extract's own column names and dirt (dirty
numbers, period spellings, name variants, aggregate rows, NULLs).  Every
stand-in grows with its tables: per-order and per-lineitem extracts keep one
raw row per input row; documents and the wide tables group by bounded keys
(nation x year, nation region, month).  Strings are built from integers and
decimals only, so a SQL engine can rebuild identical text.

Role mapping: nation -> region (code = n_nationkey, name = n_name),
orders x customer -> monthly/yearly regional observations, lineitem x
supplier -> staff and beds, part -> international beds, supplier x region ->
international expenditure, customer -> physicians.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicatormart.functions.periods import SWEDISH_MONTHS
from indicatormart.operators.joins import checked_broadcast
from indicatormart.session import session_id
from indicatormart.sources import schemas as S

# Years laid out as columns of the wide KPI extract.

# Spellings the stand-ins need beyond the modelled warehouse's own lists.
STANDIN_KPI_ALIASES = (("NATION_23", "NATION_3"),)
STANDIN_OVERCROWDING_ALIASES = (("nation_22", "NATION_2"),)
STANDIN_VISITS_ALIASES = (("NATION_24", "NATION_4"),)
STANDIN_SPECIAL_NAMES = {"NATION_9regionen": "NATION_9"}


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def month_name(m):
    """Swedish month name of a month number column."""
    mp = F.create_map(*chain.from_iterable((F.lit(i + 1), F.lit(n)) for i, n in enumerate(SWEDISH_MONTHS)))
    return mp[m]


def _money(c) -> "F.Column":
    """Two-decimal text of a price with a decimal comma: 1234.5 -> '1234,50'."""
    return F.replace(c.cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))


def _geometry(x: Column, y: Column, kind: Column) -> Column:
    """Geometry text: a point, a polygon or a multi-polygon near (x, y), with decimals."""
    def ring(step: str) -> list:
        return ["[[", x, ",", y, "],[", x, f".{step},", y, "],[", x, ",", y, f".{step}],[", x, ",", y, "]]"]

    def text(*parts) -> Column:
        return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))

    return (F.when(kind == 0, text('{"type":"Point","coordinates":[', x, ".5,", y, "]}"))
             .when(kind == 1, text('{"type":"Polygon","coordinates":[', *ring("25"), "]}"))
             .otherwise(text('{"type":"MultiPolygon","coordinates":[[', *ring("5"), "]]}")))


class StandIns:
    """Builds the 14 raw extracts from the test tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._bases: dict[str, DataFrame] = {}
        self._tables: dict[str, DataFrame] = {}

    def land_bases(self, write) -> None:
        """Replace the order and line base joins by written copies (``write``
        returns the re-read DataFrame)."""
        self._bases = {"orders": write(self.orders_by_nation(), "base_orders"),
                       "lines": write(self.lines_by_nation(), "base_lines")}

    def table(self, name: str) -> DataFrame:
        """One DataFrame per table, so a size check on it is made once."""
        if name not in self._tables:
            self._tables[name] = _t(self.spark, self.sf_dir, name)
        return self._tables[name]

    def orders_by_nation(self) -> DataFrame:
        if "orders" in self._bases:
            return self._bases["orders"]
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                        "o_orderdate", "o_orderpriority")
        c = self.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        nation = self.table("nation")
        n = nation.select(F.col("n_nationkey"), F.col("n_name"), F.col("n_regionkey"))
        return (o.join(c, o.o_custkey == c.c_custkey)
                 .join(checked_broadcast(n, base=nation), F.col("c_nationkey") == F.col("n_nationkey"))
                 .withColumns({"k": F.col("c_nationkey"), "nm": F.col("n_name"),
                               "yr": F.year("o_orderdate"), "mo": F.month("o_orderdate")}))

    def lines_by_nation(self) -> DataFrame:
        if "lines" in self._bases:
            return self._bases["lines"]
        li = self.table("lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity",
                                           "l_returnflag", "l_linestatus", "l_shipdate")
        supplier, nation = self.table("supplier"), self.table("nation")
        s = supplier.select("s_suppkey", "s_nationkey")
        n = nation.select("n_nationkey", "n_name")
        return (li.join(checked_broadcast(s, base=supplier), li.l_suppkey == s.s_suppkey)
                  .join(checked_broadcast(n, base=nation), F.col("s_nationkey") == F.col("n_nationkey"))
                  .withColumns({"k": F.col("s_nationkey"), "nm": F.col("n_name"),
                                "yr": F.year("l_shipdate")}))

    def kpi_years(self) -> range:
        """Years of the wide extract's columns: all between the first and the last order (one row)."""
        r = self.orders_by_nation().agg(F.min("yr").alias("a"), F.max("yr").alias("b")).first()
        return range(r.a, r.b + 1) if r.a is not None else range(0)

    # -- extracts -----------------------------------------------------------------------
    def kolada(self) -> DataFrame:
        o = self.orders_by_nation()
        area = (F.when(F.col("o_orderkey") % 50 == 0, F.lit("Alla regioner, ovägt"))
                 .when(F.col("k") % 4 == 0, F.concat(F.lit("Region "), "nm"))
                 .when(F.col("k") % 4 == 1, F.concat("nm", F.lit("s")))
                 .when(F.col("k") % 4 == 2, F.concat(F.lit("Regionen "), "nm"))
                 .otherwise(F.col("nm")))
        gender = (F.when(F.col("o_orderkey") % 13 == 0, F.lit(None).cast("string"))
                   .when(F.col("o_orderstatus") == "F", F.lit("Kvinnor"))
                   .when(F.col("o_orderstatus") == "O", F.lit("M"))
                   .otherwise(F.lit("Totalt")))
        code = F.concat(F.lit("N7924"), (F.col("o_custkey") % 6).cast("string"))
        value = F.when(F.col("o_orderkey") % 17 != 0, F.col("o_totalprice"))
        years = {str(y): F.when(F.col("yr") == y, value).cast("double") for y in self.kpi_years()}
        return o.select(area.alias("Område"), gender.alias("Kön"), code.alias("NYCKELTALSID"),
                        F.concat(F.lit("Väntetid "), (F.col("o_custkey") % 6).cast("string")).alias("NYCKELTAL"),
                        F.col("o_orderpriority").alias("NYCKELTALSBESKRIVNING"),
                        *[c.alias(y) for y, c in years.items()])

    def dataexport(self) -> DataFrame:
        o = self.orders_by_nation()
        y = F.col("yr").cast("string")
        sel = (F.col("k") + F.col("yr")) % 3
        period = (F.when(F.col("o_orderkey") % 89 == 3, F.concat(y, F.lit("-13")))
                   .when(F.col("o_orderkey") % 97 == 1, F.concat(y, F.lit("-Q1")))
                   .when(sel == 0, F.concat(F.lit(" "), y))
                   .when((sel == 1) & (F.col("o_orderkey") % 4 == 0), y)
                   .otherwise(F.concat(y, F.lit("-"), F.lpad(F.col("mo").cast("string"), 2, "0"))))
        gender = (F.when(F.col("o_orderkey") % 11 == 0, F.lit("K"))
                   .when(F.col("o_orderstatus") == "F", F.lit("Kvinnor"))
                   .when(F.col("o_orderstatus") == "O", F.lit("män"))
                   .otherwise(F.lit("Totalt")))
        title = (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Responstid för ambulans vid prio 1-larm"))
                  .when(F.col("o_orderpriority") == "2-HIGH", F.lit("Ambulanslarm per invånare – prio1-larm"))
                  .otherwise(F.concat(F.lit("Väntetid "), "o_orderpriority")))
        unit = (F.when(F.col("o_orderkey") % 3 == 0, F.lit(""))
                 .when(F.col("o_orderkey") % 3 == 1, F.lit("dagar")).otherwise(F.lit("procent")))
        value = F.when(F.col("o_orderkey") % 23 == 0, F.lit("--")) \
                 .otherwise(F.concat(_money(F.col("o_totalprice")), F.lit(" %")))
        return o.select(
            F.concat(F.lit(" "), "nm", F.lit(" ")).alias("ENHETSNAMN"),
            F.when(F.col("o_orderkey") % 10 == 0, F.lit("Sjukhus")).otherwise(F.lit("Region")).alias("ENHETSTYP"),
            F.col("k").cast("string").alias("REGIONSKOD"),
            F.col("o_custkey").cast("string").alias("ENHETSKOD"),
            gender.alias("Kön/Totalt"),
            F.concat(F.lit(" "), "o_orderpriority").alias("Indikator-Id"),
            title.alias("TITEL"), unit.alias("Måttenhet"), period.alias("Mätperiod"), value.alias("Värde"),
            _money(F.col("o_totalprice")).alias("Täljare"),
            F.col("o_custkey").cast("string").alias("Nämnare/antal fall"))

    def population_rows(self) -> DataFrame:
        """Orders per (nation, year) as population counts; '..' marks missing."""
        o = self.orders_by_nation()
        g = o.groupBy("k", "n_regionkey", "yr").agg(F.count(F.lit(1)).alias("cnt"))
        obs = F.when((F.col("k") + F.col("yr")) % 11 == 0, F.lit("..")).otherwise(F.col("cnt").cast("string"))
        return g.select("k", "n_regionkey", F.lpad(F.col("k").cast("string"), 2, "0").alias("code"),
                        F.col("yr").cast("string").alias("year"), obs.alias("obs"))

    def population_docs(self) -> DataFrame:
        """One PXWeb document per nation region; odd regions list Tid before Region."""
        rows = self.population_rows()
        even = F.col("n_regionkey") % 2 == 0
        key = F.when(even, F.array("code", "year")).otherwise(F.array("year", "code"))
        docs = rows.groupBy("n_regionkey").agg(
            F.collect_list(F.struct(key.alias("key"), F.array("obs").alias("values"))).alias("data"))
        region = F.struct(F.lit("Region").alias("code"), F.lit("region").alias("text"), F.lit("d").alias("type"))
        tid = F.struct(F.lit("Tid").alias("code"), F.lit("år").alias("text"), F.lit("t").alias("type"))
        cols = F.when(even, F.array(region, tid)).otherwise(F.array(tid, region))
        return docs.select(F.struct(cols.alias("columns"), F.col("data")).alias("payload"))

    def geo_docs(self) -> DataFrame:
        n = self.table("nation")
        name = F.when(F.col("n_nationkey") % 2 == 0, F.concat("n_name", F.lit("s"))).otherwise(F.col("n_name"))
        feat = F.struct(
            F.lit("Feature").alias("type"),
            F.struct(F.col("n_nationkey").cast("string").alias("scb_lan_code_2"),
                     name.alias("region_name_official")).alias("properties"),
            _geometry(F.col("n_nationkey").cast("string"), F.col("n_regionkey").cast("string"),
                      F.col("n_nationkey") % 3).alias("geometry"))
        docs = n.groupBy("n_regionkey").agg(F.collect_list(feat).alias("features"))
        return docs.select(F.struct(F.lit("FeatureCollection").alias("type"), "features").alias("payload"))

    def overcrowding_columns(self) -> list[str]:
        """Region column names (nation is a fixed 25-row dimension)."""
        rows = self.table("nation").select("n_nationkey", "n_name").orderBy("n_nationkey").collect()
        return [self._overcrowding_name(r.n_nationkey, r.n_name) for r in rows]

    @staticmethod
    def _overcrowding_name(k: int, name: str) -> str:
        if k == 9:
            return f"{name}regionen"
        return (f"Region {name}", f"{name} län", name)[k % 3]

    def overcrowding(self) -> DataFrame:
        o = self.orders_by_nation()
        colname = (F.when(F.col("k") == 9, F.concat("nm", F.lit("regionen")))
                    .when(F.col("k") % 3 == 0, F.concat(F.lit("Region "), "nm"))
                    .when(F.col("k") % 3 == 1, F.concat("nm", F.lit(" län")))
                    .otherwise(F.col("nm")))
        cat = F.concat(month_name(F.col("mo")), F.lit(" "), F.col("yr").cast("string"))
        cols = self.overcrowding_columns()
        wide = (o.select(cat.alias(S.OVERCROWDING_CATEGORY), colname.alias("__col"))
                 .groupBy(S.OVERCROWDING_CATEGORY).pivot("__col", cols).agg(F.sum(F.lit(1)).cast("string")))
        return wide

    def beds_region(self) -> DataFrame:
        li = self.lines_by_nation()
        year = F.when(F.col("l_orderkey") % 101 != 0, F.col("yr").cast("string"))
        return li.select(
            F.col("nm").alias("Enhetsnamn"), F.lit("Region").alias("Enhetstyp"),
            F.col("k").cast("string").alias("Regionskod"),
            F.concat(F.lit("beds_"), F.lower("l_returnflag")).alias("Indikator-Id"),
            F.concat(F.lit("Vårdplatser "), "l_returnflag").alias("Titel"),
            F.lit("Vårdplatser per 1000 invånare").alias("Diagramrubrik"),
            year.alias("Mätperiod"), F.col("l_quantity").alias("Värde"),
            F.lit("Väntetidsdatabasen").alias("Register/källa"))

    def beds_intl(self) -> DataFrame:
        p = self.table("part")
        return p.select(
            F.col("p_brand").alias("REF_AREA"),
            F.concat(F.lit(" "), "p_brand").alias("Reference area"),
            F.when(F.col("p_partkey") % 9 != 0, F.col("p_retailprice")).alias("OBS_VALUE"),
            F.lit("Hospital beds").alias("STRUCTURE_NAME"),
            F.when(F.col("p_size") % 3 == 0, F.lit(" ")).otherwise(F.lit("Per 1 000 inhabitants"))
             .alias("Unit of measure"),
            F.when(F.col("p_partkey") % 11 != 0, (F.lit(1995) + F.col("p_size") % 7)).cast("int")
             .alias("TIME_PERIOD"))

    def medical_personnel(self) -> DataFrame:
        li = self.lines_by_nation()
        group = (F.when(F.col("l_returnflag") == "A", F.lit("Läkare"))
                  .when(F.col("l_returnflag") == "N", F.lit("Sjuksköterska"))
                  .otherwise(F.lit("Specialist läkare")))
        area = (F.when(F.col("l_linenumber") == 7, F.lit("Riket"))
                 .when(F.col("l_linenumber") == 6, F.lit("Sjukvårdsregion Norr"))
                 .when(F.col("k") % 2 == 0, F.concat("nm", F.lit(" län")))
                 .otherwise(F.concat("nm", F.lit("s"))))
        return li.select(
            F.col("yr").cast("int").alias("År"), group.alias("Grupp"), area.alias("Område"),
            F.when(F.col("l_linestatus") == "O", F.lit("Män")).otherwise(F.lit("Kvinnor")).alias("Kön"),
            F.col("l_quantity").alias(S.PERSONNEL_VALUE_COL))

    def net_cost(self) -> DataFrame:
        o = self.orders_by_nation()
        return o.select(
            F.col("nm").alias("Enhetsnamn"),
            F.when(F.col("o_orderkey") % 29 == 0, F.lit("")).otherwise(F.col("k").cast("string")).alias("Regionskod"),
            F.when(F.col("o_orderkey") % 10 == 1, F.lit("Kommun")).otherwise(F.lit(" Region ")).alias("Enhetstyp"),
            F.when(F.col("o_orderstatus") == "F", F.lit("K")).when(F.col("o_orderstatus") == "O", F.lit("M"))
             .otherwise(F.lit("Totalt")).alias("Kön/Totalt"),
            F.when(F.col("o_custkey") % 4 == 0, F.lit(" ")).otherwise(F.col("c_mktsegment")).alias("Ålder"),
            F.col("yr").cast("string").alias("Mätperiod"),
            F.lit("kr per invånare").alias("Måttenhet"),
            F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("Värde"),
            F.when(F.col("o_orderkey") % 2 == 0, F.lit("")).otherwise(F.lit("Nettokostnad hälso- och sjukvård"))
             .alias("Titel"),
            F.lit("Nettokostnad för hälso- och sjukvård").alias("Diagramrubrik"),
            F.lit("Kolada").alias("Register/källa"))

    def expenditure_gdp(self) -> DataFrame:
        o = self.orders_by_nation()
        g = o.groupBy("yr").agg(
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("h"),
            (F.count(F.lit(1)) * 1000).cast("double").alias("g"),
            F.count_distinct("o_custkey").cast("double").alias("s"))
        cols = S.EXPENDITURE_COLS
        return g.select(F.col("yr").cast("int").alias(cols[0]), F.col("h").alias(cols[1]),
                        F.col("g").alias(cols[2]),
                        F.when(F.col("yr") % 2 == 1, F.col("s")).alias(cols[3]))

    def _ed_common(self, o: DataFrame):
        period = F.date_format(F.trunc(F.col("o_orderdate").cast("date"), "MM"), "yyyy-MM-dd")
        return {"Year": F.col("yr").cast("string"), "Month": month_name(F.col("mo")), "PERIOD": period}

    def stat_kon_alder(self) -> DataFrame:
        o = self.orders_by_nation()
        common = self._ed_common(o)
        metric = F.when(F.col("o_orderkey") % 2 == 0, F.lit("Antal besök")) \
                  .otherwise(F.lit("Median tid till läkare i minuter"))
        value = F.when(F.col("o_orderkey") % 31 != 0,
                       F.concat(F.floor("o_totalprice").cast("bigint").cast("string"), F.lit(" st")))
        region = (F.when(F.col("k") % 3 == 0, F.concat(F.lit("REGION "), "nm"))
                   .when(F.col("k") % 3 == 1, F.concat("nm", F.lit(" LÄN"))).otherwise(F.col("nm")))
        gender = (F.when(F.col("o_orderstatus") == "F", F.lit("Kvinnor"))
                   .when(F.col("o_orderstatus") == "O", F.lit("Män")).otherwise(F.lit("Totalt")))
        age = (F.when(F.col("o_custkey") % 5 == 0, F.lit("0-17")).when(F.col("o_custkey") % 5 == 1, F.lit("18-29"))
                .when(F.col("o_custkey") % 5 == 2, F.lit("30-64")).when(F.col("o_custkey") % 5 == 3, F.lit("80+"))
                .otherwise(F.lit("Totalt")))
        return o.select(common["Year"].alias("Year"), common["Month"].alias("Month"), metric.alias("Metric"),
                        value.alias("Value"), region.alias("Region/landsting/akutmottagning"),
                        gender.alias("Kön"), age.alias("Ålder"), common["PERIOD"].alias("PERIOD"))

    def stat_diagnos(self) -> DataFrame:
        o = self.orders_by_nation()
        common = self._ed_common(o)
        metric = F.when(F.col("o_orderkey") % 3 == 0, F.lit("Antal besök")) \
                  .otherwise(F.lit("Median tid till läkare i minuter"))
        value = (F.when(F.col("o_orderkey") % 37 == 0, F.lit("--"))
                  .when(F.col("o_orderkey") % 41 == 0, F.lit("-"))
                  .otherwise(F.concat((F.floor("o_totalprice").cast("bigint") % 1000).cast("string"), F.lit(",5"))))
        region = F.when(F.col("o_orderkey") % 19 == 0, F.lit("Riket")).otherwise(F.col("nm"))
        diag = F.when(F.col("o_orderkey") % 43 != 0, F.col("c_mktsegment"))
        return o.select(common["Year"].alias("Year"), common["Month"].alias("Month"), metric.alias("Metric"),
                        value.alias("Value"), region.alias("Region"), diag.alias("Diagnosgrupp"),
                        common["PERIOD"].alias("PERIOD"))

    def physicians(self) -> DataFrame:
        c = self.table("customer").select("c_custkey", "c_nationkey", "c_acctbal")
        n = self.table("nation").select("n_nationkey", "n_name")
        j = c.join(checked_broadcast(n, base=self.table("nation")), c.c_nationkey == n.n_nationkey)
        return j.select(
            F.when(F.col("c_custkey") % 2 == 0, F.lower("n_name")).otherwise(F.col("n_name")).alias("REGION_NAME"),
            (F.lit(1995) + F.col("c_custkey") % 7).cast("string").alias("YEAR"),
            F.col("c_acctbal").alias("VALUE"))

    def health_intl(self) -> DataFrame:
        s = self.table("supplier").select("s_suppkey", "s_nationkey")
        n = self.table("nation").select("n_nationkey", "n_regionkey")
        r = self.table("region").select("r_regionkey", "r_name")
        j = (s.join(checked_broadcast(n, base=self.table("nation")), s.s_nationkey == n.n_nationkey)
              .join(checked_broadcast(r, base=self.table("region")), F.col("n_regionkey") == F.col("r_regionkey")))
        obs = F.concat((F.col("s_suppkey") % 100).cast("string"), F.lit(","),
                       F.lpad(((F.col("s_suppkey") * 7) % 1000).cast("string"), 3, "0"))
        return j.select(
            F.when(F.col("s_suppkey") % 13 != 0, F.concat(F.lit(" "), "r_name")).alias("REFERENCE_AREA"),
            F.when(F.col("s_suppkey") % 17 == 0, F.lit("n/a"))
             .otherwise((F.lit(1995) + F.col("s_suppkey") % 7).cast("string")).alias("TIME_PERIOD"),
            obs.alias("OBS_VALUE"), F.lit("% of GDP").alias("UNIT_OF_MEASURE"))

    def all(self) -> dict[str, DataFrame]:
        return {
            "KOLADA_RAW": self.kolada(),
            "DATAEXPORT_RAW": self.dataexport(),
            "SCB_POPULATION_RAW": self.population_docs(),
            "GEO_LAN_REGIONS_RAW": self.geo_docs(),
            "OVERCROWDING_RAW": self.overcrowding(),
            "BEDS_REGION_RAW": self.beds_region(),
            "BEDS_INTL_RAW": self.beds_intl(),
            "MEDICAL_PERSONNEL_RAW": self.medical_personnel(),
            "NET_COST_RAW": self.net_cost(),
            "EXPENDITURE_GDP_RAW": self.expenditure_gdp(),
            "STAT_KON_ALDER_RAW": self.stat_kon_alder(),
            "STAT_DIAGNOS_RAW": self.stat_diagnos(),
            "PHYSICIANSPER1000_RAW": self.physicians(),
            "HEALTH_EXPENDITURE_INTL_RAW": self.health_intl(),
        }


def standin_options():
    from indicatormart.plans.warehouse import Options
    return Options(kpi_aliases=STANDIN_KPI_ALIASES, overcrowding_aliases=STANDIN_OVERCROWDING_ALIASES,
                   visits_aliases=STANDIN_VISITS_ALIASES, overcrowding_special_names=STANDIN_SPECIAL_NAMES)


def standin_taxonomy_path() -> str:
    import os
    return os.path.join(os.path.dirname(os.path.dirname(__file__)), "seeds", "standin_taxonomy.csv")


_LANDED: dict[tuple[str, str], dict[str, DataFrame]] = {}
_LANDED_BASES: dict[tuple[str, str], StandIns] = {}
_WAREHOUSES: dict[tuple, object] = {}


# Extracts that aggregate their inputs are written; the others are narrow projections of the
# landed base joins (or of small tables) and stay lazy.
AGGREGATED_EXTRACTS = ("SCB_POPULATION_RAW", "OVERCROWDING_RAW", "EXPENDITURE_GDP_RAW")


#: Most rows of a landed file, so that later scans of one written partition still split.
LANDED_FILE_ROWS = 4_000_000


def landed_standins(spark: SparkSession, sf_dir: str) -> StandIns:
    """The stand-ins over base joins written once per session; their file count follows the data."""
    from indicatormart.sources.sinks import materialize
    key = (session_id(spark), sf_dir)
    if key not in _LANDED_BASES:
        si = StandIns(spark, sf_dir)
        # the two base joins feed ten extracts: write them once, derive from the files
        si.land_bases(lambda df, name: materialize(df, name, max_file_rows=LANDED_FILE_ROWS))
        _LANDED_BASES[key] = si
    return _LANDED_BASES[key]


def landed_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The 14 raw extracts over base joins written once per session as parquet
    under the shared checkpoint folder (the RAW layer the staging models read)."""
    from indicatormart.sources.sinks import materialize
    key = (session_id(spark), sf_dir)
    if key not in _LANDED:
        si = landed_standins(spark, sf_dir)
        _LANDED[key] = {name: (materialize(df, f"raw_{name.lower()}") if name in AGGREGATED_EXTRACTS else df)
                        for name, df in si.all().items()}
    return _LANDED[key]


def standin_warehouse(spark: SparkSession, sf_dir: str, materialize_dims: bool = True,
                      materialize_facts: bool = False, land_raw: bool = True):
    """The full model graph over stand-ins of one test-data directory.

    With ``land_raw`` the raw extracts are landed once and the graph is
    shared by later calls with the same arguments; a call that does not ask for
    written facts also takes a graph that has them.
    """
    from indicatormart.plans.warehouse import Warehouse
    from indicatormart.sources.readers import load_seed
    key = (session_id(spark), sf_dir, materialize_dims, materialize_facts)
    if land_raw:
        for known in (key, (*key[:3], True)):
            if known in _WAREHOUSES:
                return _WAREHOUSES[known]
    tax = load_seed(spark, standin_taxonomy_path(), S.TAXONOMY_SCHEMA)
    raw = landed_sources(spark, sf_dir) if land_raw else StandIns(spark, sf_dir).all()
    wh = Warehouse(spark, raw, tax, standin_options(), materialize_dims, materialize_facts)
    if land_raw:
        _WAREHOUSES[key] = wh
    return wh
