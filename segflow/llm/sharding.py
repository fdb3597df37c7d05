"""Uniform sharding: a communication matrix says how many rows go from each partition to each shard."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segflow.llm.tables import parts_for, stored, text_of, totals_before

#: Rows of a partition, and of a block within a shard, on average.
PART_ROWS = 500_000
#: numpy draws from populations below this size; larger ones are drawn by _wide_draw.
_NUMPY_LIMIT = 1_000_000_000


def _log_factorial(x: np.ndarray) -> np.ndarray:
    """ln(x!) by Stirling's series; exact sums for small x."""
    small = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 64)))])
    y = np.maximum(x, 1).astype(float) + 1
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3)
    return np.where(x < 64, small[np.minimum(x, 63).astype(np.int64)], series)


def _wide_draw(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """A hypergeometric draw by inversion over all values within 12 deviations of the mean."""
    total = good + bad
    mean = sample * good / total
    spread = math.sqrt(max(1.0, mean * (bad / total) * (total - sample) / max(1, total - 1)))
    low = max(0, sample - bad, math.floor(mean - 12 * spread) - 12)
    high = min(good, sample, math.ceil(mean + 12 * spread) + 12)
    k = np.arange(low, high + 1, dtype=np.int64)
    ln = -(_log_factorial(k) + _log_factorial(good - k) + _log_factorial(sample - k) + _log_factorial(bad - sample + k))
    weights = np.exp(ln - ln.max())
    return int(low + np.searchsorted(np.cumsum(weights), rng.random() * weights.sum(), side="right"))


def communication_matrix(rows: list[int], shards: list[int], seed: int) -> np.ndarray:
    """How many rows each partition sends to each shard, drawn as a uniform permutation would.

    Row sums equal `rows`, column sums equal `shards`. The partitions take their rows from the
    shards' free places one after another, each by a multivariate hypergeometric draw.
    """
    rng = np.random.default_rng(seed)
    free = np.array(shards, np.int64)
    out = np.zeros((len(rows), len(shards)), np.int64)
    for p, n in enumerate(rows):
        left, rest = int(n), int(free.sum())
        for s in range(len(shards)):
            rest -= int(free[s])
            if left == 0:
                break
            if rest + free[s] < _NUMPY_LIMIT:
                out[p, s] = rng.hypergeometric(free[s], rest, left) if rest else left
            else:
                out[p, s] = _wide_draw(rng, int(free[s]), rest, left) if rest else left
            left -= int(out[p, s])
        free -= out[p]
    return out


def _random(seed: int, salt: str, *columns: str) -> Column:
    """A 64-bit value for a row that depends on the seed and its contents alone."""
    return F.xxhash64(F.lit(f"{salt}-{seed}"), *[F.col(c) for c in columns])


def shuffled_shards(documents: DataFrame, shards: int, key: str = "doc_id", text: str = "text", seed: int = 7) -> DataFrame:
    """Every row in one of `shards` shards, in an order drawn uniformly; sizes differ by at most one.

    Returns key, size (UTF-8 bytes plus 8), text_crc32, shard and slot, which is gapless from 0 in
    each shard. The law is `rows`. Null text has no bytes; null and repeated keys are rows like any
    other. Rows are put into partitions, and permuted there, by hashes of the seed, their contents and
    their places in the table, which tell equal rows apart: the same files give the same result, the
    same rows laid out otherwise another one. An empty table gives no rows.
    """
    content = text_of(text).cast("binary")
    rows = stored(
        documents.select(
            F.col(key).alias("key"),
            (F.length(content) + 8).cast("long").alias("size"),
            F.crc32(content).alias("text_crc32"),
            F.xxhash64(content).alias("print"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "rows",
    )
    n = rows.count()
    parts = parts_for(n, PART_ROWS)
    # A third of all rows may be one row repeated: `row` spreads them, contents order them.
    place = F.pmod(_random(seed, "place", "key", "print", "row"), F.lit(parts))
    placed = rows.withColumn("part", place.cast("int")).withColumn("order", _random(seed, "local", "key", "print", "row"))

    counts = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect()}
    wanted = [n // shards + (s < n % shards) for s in range(shards)]
    matrix = communication_matrix([counts.get(p, 0) for p in range(parts)], wanted, seed)
    bounds = rows.sparkSession.createDataFrame(
        [(p, [int(x) for x in np.cumsum(matrix[p])]) for p in range(parts)], "part int, bounds array<long>"
    )

    # Permute each partition, then cut it where the matrix says.
    local = F.row_number().over(Window.partitionBy("part").orderBy("order", "row"))
    dealt = (
        placed.withColumn("rank", local)
        .join(F.broadcast(bounds), "part")
        .withColumn("shard", F.size(F.filter("bounds", lambda b: b < F.col("rank"))))
        .withColumn("order", _random(seed, "shard", "key", "print", "row"))
    )

    # Permute each shard: by blocks of the random value, so that a shard is not one task's work.
    blocks = parts_for(wanted[0] if wanted else 0, PART_ROWS)
    width = (1 << 62) // blocks + 1
    upper = F.call_function("div", F.shiftright("order", 2) + F.lit(1 << 61), F.lit(width))
    dealt = stored(
        dealt.withColumn("block", (F.col("shard") * blocks + upper).cast("long")).select(
            "key", "size", "text_crc32", "row", "shard", "block", "order"
        ),
        "dealt",
    )
    sizes = dealt.groupBy("block").agg(F.count("*").alias("n"), F.first("shard").alias("shard"))
    starts = totals_before(sizes, "block", "n", "start")
    first = starts.groupBy("shard").agg(F.min("start").alias("shard_start"))
    offsets = starts.join(first, "shard").select("block", (F.col("start") - F.col("shard_start")).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("block").orderBy("order", "row"))
    return (
        dealt.withColumn("rank", rank)
        .join(F.broadcast(offsets), "block")
        .select(
            F.col("key").alias(key),
            "size",
            "text_crc32",
            "shard",
            (F.col("rank") - 1 + F.col("offset")).cast("long").alias("slot"),
        )
    )
