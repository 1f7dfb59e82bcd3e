"""Databases and tables of the session catalog.

Tables are external Parquet tables.  A load points the table's name at its new
folder (``SET LOCATION``), so readers switch only after a write has finished.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def register_views(frames: dict[str, DataFrame]) -> list[str]:
    """``createOrReplaceTempView`` for each DataFrame, so existing SQL text
    (``FROM silver_property_events s JOIN agent_master a ...``) runs as is."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return sorted(frames)


def quoted(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}{loc}")


def register_table(spark: SparkSession, database: str, table: str, location: str) -> str:
    """Point the name at ``location``, with the columns and partitions that are found there."""
    name = f"{database}.{table}"
    found = spark.read.parquet(location)
    if spark.catalog.tableExists(name):
        partitioned = any(c.isPartition for c in spark.catalog.listColumns(name))
        if not partitioned and [(f.name, f.dataType) for f in spark.table(name).schema] == \
                [(f.name, f.dataType) for f in found.schema]:
            spark.sql(f"ALTER TABLE {quoted(name)} SET LOCATION '{location}'")
            spark.sql(f"REFRESH TABLE {quoted(name)}")
            return name
    replace_table(spark, name, f"USING parquet LOCATION '{location}'")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {quoted(name)}")
    return name


def replace_table(spark: SparkSession, name: str, definition: str) -> None:
    """Create the external table anew; files of the one before stay, and so do its labels."""
    labels = table_properties(spark, name) if spark.catalog.tableExists(name) else {}
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
    spark.sql(f"CREATE TABLE {quoted(name)} {definition}")
    own = table_properties(spark, name)
    set_properties(spark, name, {k: v for k, v in labels.items() if k not in own})


def table_location(spark: SparkSession, name: str) -> str:
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").where("col_name = 'Location'").first()
    return found["data_type"]


def point_table(spark: SparkSession, name: str, location: str, schema: StructType,
                partition: tuple[str, str] | None = None) -> None:
    """Point ``name`` at ``location``, with these columns and partition column (name, type).  Where
    the columns stay as they are only the location changes."""
    held = [f for f in schema if partition is None or f.name != partition[0]]
    columns = [(f.name, f.dataType.simpleString()) for f in held] + ([partition] if partition else [])
    if spark.catalog.tableExists(name):
        if not partition and [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema] == columns:
            spark.sql(f"ALTER TABLE {quoted(name)} SET LOCATION '{location}'")
            spark.catalog.refreshTable(name)
            return
    ddl = ", ".join(f"`{n}` {t}" for n, t in columns)
    by = f" PARTITIONED BY (`{partition[0]}`)" if partition else ""
    replace_table(spark, name, f"({ddl}) USING parquet{by} LOCATION '{location}'")
    if partition:
        spark.sql(f"MSCK REPAIR TABLE {quoted(name)}")


def add_columns(spark: SparkSession, name: str, schema: StructType) -> list[str]:
    """Add to the table the columns of ``schema`` that it lacks (older files read as null there).
    A column that it has with another type is an error.  Returns the added names."""
    held = {f.name.lower(): f.dataType.simpleString() for f in spark.table(name).schema}
    new = []
    for f in schema:
        kind = f.dataType.simpleString()
        if held.get(f.name.lower(), kind) != kind:
            raise ValueError(f"column {f.name} of {name} is {held[f.name.lower()]}, not {kind}")
        if f.name.lower() not in held:
            new.append((f.name, kind))
    if new:
        spark.sql(f"ALTER TABLE {quoted(name)} ADD COLUMNS ({', '.join(f'`{n}` {k}' for n, k in new)})")
    return [n for n, _ in new]


def set_properties(spark: SparkSession, name: str, properties: dict[str, str]) -> None:
    """``ALTER TABLE .. SET TBLPROPERTIES``: labels only.  The behaviours the
    reference switched on this way (deletion vectors, change data feed) are
    jobs here: ``Table.delete_keys`` and ``dimensions.change_feed``."""
    def text(s: str) -> str:
        return "'" + str(s).replace("\\", "\\\\").replace("'", "\\'") + "'"
    if properties:
        props = ", ".join(f"{text(k)} = {text(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {quoted(name)} SET TBLPROPERTIES ({props})")


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()}


def labels(spark: SparkSession, database: str, prefix: str) -> DataFrame:
    """(table_name, label, value) of the database's tables, labels that start with ``prefix`` only."""
    rows = [(t, k, v) for t in list_tables(spark, database)
            for k, v in table_properties(spark, f"{database}.{t}").items() if k.startswith(prefix)]
    return spark.createDataFrame(rows, "table_name string, label string, value string")


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """``SHOW TABLES IN db`` (catalog metadata, one entry per table)."""
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def table_counts(spark: SparkSession, database: str, tables: list[str] | None = None
                 ) -> DataFrame:
    """``SELECT 'name' AS table_name, COUNT(*) AS row_count ... UNION ALL``."""
    parts = [spark.table(f"{database}.{t}").agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table_name"), "row_count")
             for t in (tables if tables is not None else list_tables(spark, database))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def path_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Tagged counts over path-addressed scans, in SQL (``parquet.`path```)."""
    sql = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM parquet.`{path}`"
        for name, path in paths.items())
    return spark.sql(sql)
