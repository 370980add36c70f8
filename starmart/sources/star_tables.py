"""Stored star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.schemas import STAR_TABLES
from starmart.sinks.versions import Warehouse, is_versioned


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table, such as ``manager/Dim_Date``, under its declared schema; of a versioned root, the newest version."""
    if is_versioned(spark, root):
        return Warehouse(spark, root).read(name, STAR_TABLES[name])
    return spark.read.schema(STAR_TABLES[name]).parquet(f"{root}/{name}")


def read_star_schema(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    if not is_versioned(spark, root):
        return {name: read_table(spark, root, name) for name in STAR_TABLES}
    warehouse = Warehouse(spark, root)
    version = warehouse.version()
    return {name: warehouse.read(name, STAR_TABLES[name], version) for name in STAR_TABLES if name in warehouse.manifest(version)}


def register_views(spark: SparkSession, root: str, schema: str) -> list[str]:
    """Expose the tables of one schema to ``spark.sql`` under their table names, all of one version."""
    warehouse = Warehouse(spark, root) if is_versioned(spark, root) else None
    version = warehouse.version() if warehouse else None
    held = warehouse.manifest(version) if warehouse else STAR_TABLES
    views = []
    for name in [n for n in STAR_TABLES if n in held]:
        owner, table = name.split("/")
        if owner == schema:
            frame = warehouse.read(name, STAR_TABLES[name], version) if warehouse else read_table(spark, root, name)
            frame.createOrReplaceTempView(table)
            views.append(table)
    return views
