"""Dealing rows to buckets by what they cost, before work that is costly for each row."""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What tasks run travels with the plan, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Cells for each bucket: the others hold too little to matter, and a row counts as heavy at this share of a bucket.
FINE_CELLS, FEWEST_CELLS = 256, 16
_MOST_CELLS = 1 << 20
_CELL, _ROW, _WEIGHT, _TOTAL, _BUCKET = "_cell", "_row", "_weight", "_total", "_bucket"


def distribute_by_path(files: DataFrame, buckets: int) -> DataFrame:
    """Files of one path in one partition: number crc32(path) % `buckets`. Files without a path are left out.

    A path that many rows share fills its partition alone; see ``distribute_by_weight`` for such tables.
    """
    return files.filter(F.col("path").isNotNull()).repartitionById(buckets, (F.crc32("path") % buckets).cast("int"))


def _pack(buckets: int):
    """Cells to buckets: the heaviest first, each to the bucket that holds least."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        cells, weights = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in range(2))
        order = np.argsort(-weights, kind="stable")
        loads = [(0, i) for i in range(buckets)]
        chosen = np.zeros(len(cells), np.int32)
        for i in order.tolist():
            load, bucket = heapq.heappop(loads)
            chosen[i] = bucket
            heapq.heappush(loads, (load + int(weights[i]), bucket))
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(chosen)], [_CELL, _BUCKET])

    return pack


def distribute_by_weight(rows: DataFrame, weight: Column, buckets: int) -> DataFrame:
    """Rows over `buckets` partitions whose weights come out nearly equal, whatever keys the rows share.

    Rows are dealt to many more cells than buckets, and the cells, with what their rows weigh, are
    packed into buckets, heaviest first. Rows that weigh a sixteenth of a bucket or more are cells of their
    own, so a huge one gets a bucket to itself and the others share the rest. No bucket holds more
    than the heaviest row or the mean and one cell. Only weights are read for this; how many cells
    are packed, in one task, depends on `buckets` alone, not on the rows. Null weights count as 0,
    and a row weighs 1 more than it says, so that rows without weight are spread too.
    """
    cells = buckets * max(FEWEST_CELLS, min(FINE_CELLS, _MOST_CELLS // buckets))
    weighted = rows.withColumn(_WEIGHT, F.coalesce(weight.cast("long"), F.lit(0)) + 1).withColumn(_ROW, F.monotonically_increasing_id())
    total = weighted.agg(F.coalesce(F.sum(_WEIGHT), F.lit(0)).alias(_TOTAL))
    heavy = F.col(_WEIGHT) * (buckets * FEWEST_CELLS) >= F.col(_TOTAL)
    cell = F.when(heavy, -1 - F.col(_ROW)).otherwise(F.pmod(F.xxhash64(_ROW), F.lit(cells)))
    marked = weighted.crossJoin(F.broadcast(total)).withColumn(_CELL, cell)
    sums = marked.groupBy(_CELL).agg(F.sum(_WEIGHT).alias(_WEIGHT))
    packed = sums.coalesce(1).mapInArrow(_pack(buckets), f"{_CELL} long, {_BUCKET} int")
    # A row whose cell is not among the packed ones, as its number changed when a task was repeated, goes anywhere.
    anywhere = F.pmod(F.col(_CELL), F.lit(buckets)).cast("int")
    placed = marked.join(F.broadcast(packed), _CELL, "left").withColumn(_BUCKET, F.coalesce(_BUCKET, anywhere))
    return placed.repartitionById(buckets, F.col(_BUCKET)).select(*rows.columns)
