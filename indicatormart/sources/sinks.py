"""Sinks: views, tables, CSV, GeoJSON export and lineage cuts."""

from __future__ import annotations

import re
import time
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicatormart.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/indicatormart/{name}-{uuid.uuid4().hex}"


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder when the session's JVM ends (classic sessions)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(target)


def materialize(df: DataFrame, name: str = "table", max_file_rows: int = 0,
                partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet to the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor recomputes from the written files, not
    from the raw sources), runs the upstream plan once, and gives later joins
    exact file-size statistics.  ``max_file_rows`` splits larger partitions
    into several files; ``partition_by`` gives a folder per value, which
    readers filtering on it prune.  The folder goes when the session ends.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", max_file_rows)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    drop_at_exit(df.sparkSession, path)
    if partition_by:        # a table without rows has no folder to read the columns from
        return df.sparkSession.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])
    back = df.sparkSession.read.parquet(path)
    _FOLDERS[back] = path
    return back


_FOLDERS: "weakref.WeakKeyDictionary[DataFrame, str]" = weakref.WeakKeyDictionary()


def folder_of(df: DataFrame) -> str | None:
    """The folder of a frame that :func:`materialize` returned, if ``df`` is one."""
    return _FOLDERS.get(df)


def publish(df: DataFrame, name: str, kind: str = "view", database: str | None = None,
            path: str | None = None, partition_by: list[str] | None = None, keep_previous: int = 1) -> DataFrame:
    """Publish a model: ``view`` (lazy temp view) or ``table`` (full replace).

    For a table, ``database`` is created if absent and used verbatim.  Each call
    writes a new version (``v-<time>-<id>``) below ``path``, or beside the
    database's own folder, while the published rows stay as they are; only when
    the write has ended does the table point at it.  A failing write leaves the
    old rows, and its unfinished version is removed.  Readers that began before
    the swap still find their files: ``keep_previous`` older versions stay.
    Published tables are external.

    ``partition_by`` lays the table out by those columns (e.g. ``["year"]``)
    so readers filtering on them prune whole directories.  Returns the
    published relation, read back from the catalog.
    """
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind != "table":
        raise ValueError("kind must be 'view' or 'table'")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    base = path.rstrip("/") if path is not None else _versions_folder(spark, name, database)
    stamp = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    target = f"{base}/{stamp}"
    fresh = f"{name}__{stamp.replace('-', '_')}"
    writer = df.write.mode("error").format("parquet").option("path", target)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.saveAsTable(_qualified(fresh, database))
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {_qualified(fresh, database)}")
        _delete(spark, target)
        raise
    _swap(spark, name, fresh, target, database, bool(partition_by))
    _forget(spark, base, stamp, keep_previous)
    return spark.table(_qualified(name, database))


def _qualified(name: str, database: str | None) -> str:
    return f"`{database}`.`{name}`" if database else f"`{name}`"


def _versions_folder(spark: SparkSession, name: str, database: str | None) -> str:
    home = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{home.rstrip('/')}/{name}__versions"


def _swap(spark: SparkSession, name: str, fresh: str, target: str, database: str | None, partitioned: bool) -> None:
    """Let ``name`` stand for the table ``fresh``.

    Same columns and no partitions: one catalog operation sets the location.
    Otherwise the tables change names, the old one first; should the session
    end between the two, both versions are there under their long names.
    """
    old, new = _qualified(name, database), _qualified(fresh, database)
    if not spark.catalog.tableExists(old):
        spark.sql(f"ALTER TABLE {new} RENAME TO {old}")
        return
    plain = not partitioned and not spark.sql(f"DESCRIBE TABLE {old}").filter("col_name LIKE '# Partition%'").count()
    external = spark.catalog.getTable(old).tableType == "EXTERNAL"
    if plain and external and spark.table(old).schema == spark.table(new).schema:
        spark.sql(f"ALTER TABLE {old} SET LOCATION '{target}'")
        spark.sql(f"DROP TABLE {new}")          # external: its files stay
    else:
        former = _qualified(f"{fresh}__old", database)
        spark.sql(f"ALTER TABLE {old} RENAME TO {former}")
        spark.sql(f"ALTER TABLE {new} RENAME TO {old}")
        spark.sql(f"DROP TABLE {former}")
    spark.catalog.refreshTable(old)


def _fs(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path (classic sessions)."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def _forget(spark: SparkSession, base: str, current: str, keep_previous: int) -> None:
    """Delete versions older than the last ``keep_previous`` before ``current``."""
    fs, folder = _fs(spark, base)
    found = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory())
    older = [v for v in found if re.fullmatch(r"v-\d{20}-[0-9a-f]{8}", v) and v < current]
    for v in older[:max(0, len(older) - keep_previous)]:
        _delete(spark, f"{base}/{v}")


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """CSV sink with a header line (one file per partition)."""
    df.write.mode("overwrite").option("header", header).csv(path)


def export_region_geojson(dim_region: DataFrame) -> DataFrame:
    """Region shapes as GeoJSON text with a two-digit region code."""
    return dim_region.select(
        "region_key",
        F.lpad(F.col("region_code_int").cast("string"), 2, "0").alias("region_code"),
        "region_name",
        F.col("geom").alias("geojson"),
    )
