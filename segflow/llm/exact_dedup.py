"""Exact dedup: counting quotient filters find repeated fingerprints, their texts are compared whole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segflow.llm.quotient_filter import CountingQuotientFilter
from segflow.llm.tables import join_groups, parts_for, split_by_keys, stored, text_of

#: Fingerprints that one merged filter holds on average.
RANGE_ROWS = 500_000
#: Fingerprints that a task gathers before it writes its filters.
FILTER_ROWS = 4_000_000
#: Runs of white space that are not yet a single space.
_SPACE_RUNS = r"\x20[\x20\x09-\x0D]+|[\x09-\x0D][\x20\x09-\x0D]*"


def normalised(text: Column) -> Column:
    """Each run of blanks, tabs, line and page breaks becomes one space."""
    return F.regexp_replace(text, _SPACE_RUNS, " ")


def repeated_fingerprints(rows: DataFrame, column: str, n_rows: int) -> DataFrame:
    """The 64-bit values that occur more than once.

    Each task counts its values in quotient filters, one for each range of upper bits. The filters
    of a range meet in one task and merge without loss. A range holds about RANGE_ROWS distinct
    values however often each occurs, so neither repeats nor size make a task large.
    """
    range_bits = (parts_for(n_rows, RANGE_ROWS) - 1).bit_length()
    bits = 64 - range_bits
    quotient_bits = min(14, max(4, n_rows.bit_length() - range_bits - 5))

    def filters_of(batch: list[np.ndarray]) -> pd.DataFrame:
        values = np.sort(np.concatenate(batch))
        ranges = values >> np.uint64(bits) if range_bits else np.zeros(len(values), np.uint64)
        low = values & np.uint64((1 << bits) - 1)
        starts = np.flatnonzero(np.r_[True, ranges[1:] != ranges[:-1]])
        stops = np.r_[starts[1:], len(values)]
        filters = [CountingQuotientFilter.of(low[a:b], bits, quotient_bits) for a, b in zip(starts, stops)]
        return pd.DataFrame({"range": ranges[starts].astype(np.int64), "filter": [f.to_bytes() for f in filters]})

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            if len(batch):
                held.append(batch[column].to_numpy(np.int64).view(np.uint64))
                n += len(batch)
            if n >= FILTER_ROWS:
                yield filters_of(held)
                held, n = [], 0
        if held:
            yield filters_of(held)

    def merge(key: tuple, filters: pd.DataFrame) -> pd.DataFrame:
        whole = CountingQuotientFilter.merged([CountingQuotientFilter.from_bytes(b) for b in filters["filter"]])
        values, counts = whole.items()
        found = values[counts > 1]
        if range_bits:
            found = found | (np.uint64(key[0]) << np.uint64(bits))
        return pd.DataFrame({column: found.view(np.int64)})

    filters = rows.select(column).mapInPandas(build, "range long, filter binary")
    return filters.groupBy("range").applyInPandas(merge, f"{column} long")


def exact_groups(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, keep_id, group_size, kept and the SHA-256 of its normalised text.

    Null text counts as empty. Of equal texts the row with the smallest key stays; a null key is
    larger than any other. Of rows that share that key too, one stays: `kept` is true once in each
    group. An empty table gives no rows; columns besides key and text are not read.
    """
    whole = normalised(text_of(text))
    source = documents.select(F.col(key).alias("key"), whole.alias("whole"))
    prints = source.select(
        "key",
        F.xxhash64("whole").alias("print"),
        F.sha2(F.col("whole").cast("binary"), 256).alias("sha"),
    )
    rows = stored(prints.withColumn("row", F.monotonically_increasing_id()), "prints")
    repeated = stored(repeated_fingerprints(rows, "print", rows.count()), "repeated")

    # Whole texts meet only where a fingerprint repeats; equal texts are summed up before they move.
    possible, _ = split_by_keys(source.withColumn("print", F.xxhash64("whole")), "print", repeated)
    texts = possible.join(repeated, "print", "left_semi")
    verified = (
        texts.groupBy("whole")
        .agg(F.count("*").alias("group_size"), F.min("key").alias("keep_id"))
        .filter("group_size > 1")
        .select(F.sha2(F.col("whole").cast("binary"), 256).alias("sha"), "group_size", "keep_id")
    )
    verified = stored(verified, "copies")
    stays = verified.select(F.col("sha").alias("stay_sha"), "keep_id")
    keepers = (
        rows.join(stays, (F.col("sha") == F.col("stay_sha")) & F.col("key").eqNullSafe(F.col("keep_id")))
        .groupBy("sha")
        .agg(F.min("row").alias("keep_row"))
    )
    groups = stored(verified.join(keepers, "sha"), "groups")
    joined = join_groups(rows, groups, ["sha"], "group_size")
    return joined.select(
        F.col("key").alias(key),
        F.when(F.col("group_size").isNull(), F.col("key")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def exact_dedup(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, all columns, with one row for each normalised text.

    Of equal texts the row with the smallest key stays, null keys last; of rows with one key and
    text, one stays. Null text counts as empty.
    """
    marked = documents.withColumn("_seg_whole", normalised(text_of(text))).withColumn("_seg_print", F.xxhash64("_seg_whole"))
    prints = stored(marked.select("_seg_print"), "prints")
    repeated = stored(repeated_fingerprints(prints, "_seg_print", prints.count()), "repeated")
    columns = [F.col(f"`{c}`") for c in documents.columns]
    possible, single = split_by_keys(marked, "_seg_print", repeated)
    possible = possible.select("_seg_print", *columns)
    alone = single.select(*columns).unionByName(possible.join(repeated, "_seg_print", "left_anti").select(*columns))
    row = F.struct(*columns)
    order = F.struct(F.col(key).isNull(), F.col(key), F.xxhash64(row))
    copies = possible.join(repeated, "_seg_print", "left_semi").withColumn("_seg_whole", normalised(text_of(text)))
    first = copies.groupBy("_seg_whole").agg(F.min_by(row, order).alias("_seg_row"))
    return alone.unionByName(first.select("_seg_row.*"))
