"""Replacing all rows of a table without a moment in which it is missing, empty or half full.

Each generation of a table's rows has a folder of its own, below a folder named
after the table. A new one is built beside the old one; then the table's
location is changed, one change in the catalog. A reader sees the generation
that the table had when its query was planned, whole. The generation before
the current one stays until the next replacement, for readers still at work.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from segflow.storage import Storage

_PREFIX = "g-"


def table_folder(spark: SparkSession, name: str) -> str:
    """The folder that holds the generations of a table, in the folder of its schema."""
    *schema, table = name.split(".")
    return f"{spark.catalog.getDatabase('.'.join(schema) or spark.catalog.currentDatabase()).locationUri.rstrip('/')}/{table}"


def new_location(spark: SparkSession, name: str) -> str:
    return f"{table_folder(spark, name)}/{_PREFIX}{uuid.uuid4().hex}"


def location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def generation(spark: SparkSession, name: str) -> str | None:
    """The name of the table's current generation; None for a table that was not made by generations."""
    last = location(spark, name).rpartition("/")[2]
    return last if last.startswith(_PREFIX) else None


def point_to(spark: SparkSession, name: str, new: str) -> None:
    """Let the table's rows be those at `new`, and remove generations that are neither those nor their predecessor's."""
    old = location(spark, name)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{new}'")
    spark.catalog.refreshTable(name)
    remove_generations(spark, str(new).rpartition("/")[0], {new.rpartition("/")[2], old.rpartition("/")[2]})


def remove_generations(spark: SparkSession, folder: str, kept: set[str]) -> None:
    """Delete the generations in a folder, or checkpoints named after them, that are not kept."""
    storage = Storage(spark)
    for child in storage.children(folder):
        if child.startswith(_PREFIX) and child not in kept:
            storage.delete(f"{folder}/{child}")


def replace_rows(rows: DataFrame, name: str, provider: str = "parquet", then: Callable[[str], None] | None = None) -> None:
    """Create the table from the rows or, if it exists, swap them in.

    The rows may be read from the table itself. New columns are added to the table, columns that
    the rows lack read as NULL from then on; a column whose type changes is refused, before
    anything is written. Nothing has changed if writing fails. `then` is called with the place of
    the written rows, before they are swapped in.
    """
    spark = rows.sparkSession
    exists = spark.catalog.tableExists(name)
    added = _added_columns(spark.table(name).schema, rows.schema, name) if exists else []
    new = new_location(spark, name)
    rows.write.format(provider).save(new)
    if then is not None:
        then(new)
    if not exists:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING {provider} LOCATION '{new}'")
        return
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(added)})")
    point_to(spark, name, new)


def _added_columns(old: StructType, new: StructType, name: str) -> list[str]:
    types = {f.name: f.dataType.simpleString() for f in old.fields}
    changed = [f.name for f in new.fields if types.get(f.name, f.dataType.simpleString()) != f.dataType.simpleString()]
    if changed:
        raise ValueError(f"columns {changed} of {name} would change their type: drop the table first")
    return [f"`{f.name}` {f.dataType.simpleString()}" for f in new.fields if f.name not in types]
