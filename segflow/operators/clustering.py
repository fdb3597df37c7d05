"""Tables whose files hold ranges of their clustering columns, and reads that open only the files a filter needs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segflow.storage import Storage
from segflow.streaming import generations

#: Ranges of each column that a curve through several columns tells apart: 2 ** this.
CURVE_BITS = 8
_BOUNDS = "_bounds"
_CURVE = "_curve"


def _curve(rows: DataFrame, columns: tuple[str, ...]) -> Column:
    """Place on a Z-order curve: the bits of each column's range number, interleaved. NULL counts as the first range.

    A column's ranges hold about as many distinct values each, so a frequent value does not fill
    many. Their limits, at most 2 ** CURVE_BITS for each column, come to the driver.
    """
    sampled = rows.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    if len(columns) * (CURVE_BITS + 1) > 63:
        raise ValueError(f"a curve through {len(columns)} columns is too fine for 64 bits")
    n, bits = 1 << CURVE_BITS, []
    for i in range(len(columns)):
        values = sampled.select(f"c{i}").filter(F.col(f"c{i}").isNotNull()).distinct()
        parts = values.repartitionByRange(n, f"c{i}").groupBy(F.spark_partition_id()).agg(F.min(f"c{i}").alias("low"))
        limits = [r["low"] for r in parts.select("low").orderBy("low").collect()]
        kind = sampled.schema[f"c{i}"].dataType
        lows = F.array(*[F.lit(low).cast(kind) for low in limits]) if limits else F.array().cast(f"array<{kind.simpleString()}>")
        bits.append(F.coalesce(_not_above(lows, F.col(columns[i])), F.lit(0)).cast("long"))
    spread = [
        F.shiftleft(F.shiftright(place, b).bitwiseAND(1), b * len(columns) + i) for i, place in enumerate(bits) for b in range(CURVE_BITS + 1)
    ]
    return reduce(Column.bitwiseOR, spread)


def _not_above(lows: Column, value: Column) -> Column:
    """How many of the limits are not above the value."""
    return F.size(F.filter(lows, lambda low: low <= value))


def replace_clustered(rows: DataFrame, name: str, columns: tuple[str, ...], files: int, provider: str = "parquet") -> None:
    """Create or replace a table whose rows lie in about `files` files by ranges of the clustering columns.

    One column: each file holds a range of it, in order. Several: ranges of a Z-order curve through
    them, so each file is narrow in all. Columns may be fields of structs. What the files hold is
    recorded beside them, for ``read_clustered``. Readers are not disturbed, as by ``replace_rows``.
    """
    if len(columns) == 1:
        dealt = rows.repartitionByRange(files, columns[0]).sortWithinPartitions(columns[0])
    else:
        dealt = rows.withColumn(_CURVE, _curve(rows, columns)).repartitionByRange(files, _CURVE)
        dealt = dealt.sortWithinPartitions(_CURVE, *columns).drop(_CURVE)
    generations.replace_rows(dealt, name, provider, lambda location: _record_bounds(rows.sparkSession, location, columns, provider))


def _record_bounds(spark: SparkSession, location: str, columns: tuple[str, ...], provider: str) -> None:
    stored = spark.read.format(provider).load(location)
    file = F.col("_metadata.file_path").alias("file")
    bounds = stored.select(file, *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    limits = [f(f"c{i}").alias(f"{label}{i}") for i in range(len(columns)) for f, label in ((F.min, "low"), (F.max, "high"))]
    names = F.lit(list(columns)).alias("columns")
    bounds.groupBy("file").agg(*limits).withColumn("columns", names).coalesce(1).write.parquet(f"{location}/{_BOUNDS}")


def files_between(spark: SparkSession, name: str, ranges: dict[str, tuple]) -> list[str] | None:
    """Files of the table's current generation that may hold rows within all ranges; None if the table has no bounds."""
    at = f"{generations.location(spark, name)}/{_BOUNDS}"
    if not Storage(spark).exists(at):
        return None
    bounds = spark.read.parquet(at)
    first = bounds.first()
    known = list(first["columns"]) if first else []
    for column, (low, high) in ranges.items():
        if column in known:
            i = known.index(column)
            if low is not None:
                bounds = bounds.filter(F.col(f"high{i}") >= F.lit(low))
            if high is not None:
                bounds = bounds.filter(F.col(f"low{i}") <= F.lit(high))
    return [r["file"] for r in bounds.select("file").collect()]


def read_clustered(spark: SparkSession, name: str, **ranges: tuple) -> DataFrame:
    """Rows of a table with each column between two values, both included; None leaves a side open, and NULL is in no range.

    Of a table made by ``replace_clustered`` only files whose bounds meet the ranges are read; the
    names of these come to the driver, as those of all files do for a whole table. Dots in the names
    of fields are written as two underscores.
    """
    named = {c.replace("__", "."): r for c, r in ranges.items()}
    files = files_between(spark, name, named)
    table = spark.table(name)
    if files is not None:
        # Names in bounds are URIs; a reader takes paths.
        paths = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(f)).toString() for f in files]
        table = spark.read.schema(table.schema).parquet(*paths) if paths else table.limit(0)
    for column, (low, high) in named.items():
        if low is not None:
            table = table.filter(F.col(column) >= F.lit(low))
        if high is not None:
            table = table.filter(F.col(column) <= F.lit(high))
    return table
