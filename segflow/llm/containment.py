"""Benchmark decontamination: size-partitioned MinHash containment search, then exact shingle containment."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segflow.llm.tables import join_groups, split_by_keys, stored, text_of

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
#: Chance that an item contained to the threshold has no signature value in common with its document.
MISS = 1e-6
#: Broadcast at most this many shingles of items (16 bytes each before they are hashed).
BROADCAST_VALUES = 1_000_000
#: In place of a number of bins: every shingle is kept.
ALL_SHINGLES = 63


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    spaced = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def shingles(words: str) -> Column:
    """Distinct runs of SHINGLE_WORDS words as text; a shorter text has its words as its only shingle."""
    n = F.size(words)
    starts = F.when(n >= SHINGLE_WORDS, F.sequence(F.lit(1), n - SHINGLE_WORDS + 1)).otherwise(F.array(F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(words, i, SHINGLE_WORDS), " ")))


def shingle_hashes(word_hashes: str) -> Column:
    """Distinct 64-bit hashes of the same shingles, ascending, from the hashes of the words."""
    n = F.size(word_hashes)
    starts = F.when(n >= SHINGLE_WORDS, F.sequence(F.lit(0), n - SHINGLE_WORDS)).otherwise(F.array(F.lit(0)))
    zero = F.lit(0).cast("bigint")
    parts = [lambda i, k=k: F.coalesce(F.get(word_hashes, i + k), zero) for k in range(SHINGLE_WORDS)]
    return F.sort_array(F.array_distinct(F.transform(starts, lambda i: F.xxhash64(*[part(i) for part in parts]))))


def _bin(value: Column, bins_log: str) -> Column:
    """Which of 2**bins_log bins a hash falls in: its upper bits."""
    return F.call_function("shiftrightunsigned", value, 64 - F.col(bins_log))


def signature(hashes: str, bins_log: str) -> Column:
    """The smallest hash of each bin that has one: a one-permutation MinHash of ascending hashes."""
    first = F.filter(
        hashes, lambda h, i: (i == 0) | (_bin(h, bins_log) != _bin(F.get(hashes, i - 1), bins_log))
    )
    return F.when(F.col(bins_log) == ALL_SHINGLES, F.col(hashes)).otherwise(first)


def bins_for(size_class: int, item_shingles: int, threshold: float) -> int:
    """Logarithm of the number of bins in the partition of documents with up to 2**size_class shingles.

    A shared shingle is the smallest of its bin in the document with a chance of (1 - exp(-g)) / g
    for g shingles to a bin. An item shares at least threshold times its number of shingles, so the
    chance that all of them are hidden is that of one to this power. The bins are the fewest, down
    to an eighth of the shingles, for which it is at most MISS. Items too short to afford any
    hiding need every shingle.
    """
    shared = math.ceil(threshold * item_shingles - 1e-9)
    for log in range(max(1, size_class - 3), size_class + 3):
        load = 2.0 ** (size_class - log)
        hidden = 1 - (1 - math.exp(-load)) / load
        if hidden**shared <= MISS:
            return log
    return ALL_SHINGLES


def _with_hashes(rows: DataFrame) -> DataFrame:
    """Adds `hashes` to rows with `words`."""
    hashed = rows.withColumn("word_hashes", F.transform("words", lambda w: F.xxhash64(w)))
    return hashed.withColumn("hashes", shingle_hashes("word_hashes")).drop("word_hashes")


def _hits(documents: DataFrame, items: DataFrame, key: str, text: str, item_key: str, item_text: str, threshold: float):
    """doc, print (hash of the text), item, item_print, n_shared and containment, a row for each pair."""
    item_rows = items.select(F.col(item_key).alias("item"), words_of(text_of(item_text)).alias("words"))
    item_rows = _with_hashes(item_rows.filter(F.size("words") > 0)).withColumn("item_print", F.xxhash64("words"))
    item_rows = stored(item_rows.dropDuplicates(["item", "item_print"]), "items")
    values = stored(item_rows.select("item", "item_print", F.explode("hashes").alias("value")), "values")

    # The shortest item says how many bins each partition of documents needs; there are at most 32 partitions.
    shortest = item_rows.agg(F.min(F.size("hashes"))).first()[0] or 1
    bins = F.array(*[F.lit(bins_for(c, shortest, threshold)) for c in range(32)])
    source = documents.select(
        F.col(key).alias("doc"), F.xxhash64(text_of(text)).alias("print"), words_of(text_of(text)).alias("words")
    ).filter(F.size("words") > 0)
    size_class = F.ceil(F.log2(F.size("hashes"))).cast("int")
    signed = _with_hashes(source).withColumn("bins_log", F.get(bins, size_class))
    sketch = signed.select("doc", "print", F.explode(signature("hashes", "bins_log")).alias("value"))
    if values.count() <= BROADCAST_VALUES:
        values = F.broadcast(values)
    candidates = stored(sketch.join(values, "value").select("doc", "print", "item", "item_print").distinct(), "candidates")

    # Exact containment, on the shingles' texts, of the candidates alone.
    sizes = candidates.groupBy("item", "item_print").agg(F.count("*").alias("n"))
    same_item = F.col("i.item").eqNullSafe(F.col("s.item")) & (F.col("i.item_print") == F.col("s.item_print"))
    wanted = (
        item_rows.alias("i")
        .join(sizes.alias("s"), same_item)
        .select(F.xxhash64("i.item", "i.item_print").alias("item_ref"), "i.item", "i.item_print", "n", shingles("words").alias("item_shingles"))
    )
    pairs = candidates.select("doc", "print", F.xxhash64("item", "item_print").alias("item_ref"))
    pairs = join_groups(pairs, stored(wanted, "wanted"), ["item_ref"], "n", "inner")
    same_doc = F.col("d.doc").eqNullSafe(F.col("p.doc")) & (F.col("d.print") == F.col("p.print"))
    shared = F.size(F.array_intersect("item_shingles", "doc_shingles"))
    texts = documents.select(F.col(key).alias("doc"), F.xxhash64(text_of(text)).alias("print"), F.col(text).alias("text"))
    # Words are made below the join: above it, the filter on the result would repeat their making for each shingle.
    possible = split_by_keys(texts, "print", candidates)[0].select("doc", "print", words_of(text_of("text")).alias("words"))
    return (
        possible.alias("d")
        .join(pairs.alias("p"), same_doc)
        .select("p.doc", "p.print", "item", "item_print", "item_shingles", shingles("words").alias("doc_shingles"))
        .withColumn("n_shared", shared)
        .withColumn("containment", F.col("n_shared") / F.size("item_shingles"))
        .drop("doc_shingles", "item_shingles")
        .filter(F.col("containment") >= threshold)
        .distinct()
    )


def contaminated(
    documents: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    threshold: float = CONTAINMENT,
) -> DataFrame:
    """Key, item key, n_shared and containment for each document that holds at least `threshold` of an item's shingles.

    Containment is the share of the item's distinct shingles that the document has. Texts without
    words, null or empty, hold nothing and are held by nothing; an item of fewer than SHINGLE_WORDS
    words is held by the documents of just these words. Repeated rows of a key and text, or of an
    item, count once; null keys are keys like any other. An empty table on either side gives no
    rows. Whole texts are read on both sides, and only DataFrame functions are used.
    """
    hits = _hits(documents, items, key, text, item_key, item_text, threshold)
    return hits.select(F.col("doc").alias(key), F.col("item").alias(item_key), "n_shared", "containment")


def decontaminate(
    documents: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    threshold: float = CONTAINMENT,
) -> DataFrame:
    """The documents, all columns, that hold no item; see contaminated()."""
    hits = _hits(documents, items, key, text, item_key, item_text, threshold)
    found = stored(hits.select(F.col("doc").alias("_seg_doc"), F.col("print").alias("_seg_print")).distinct(), "contaminated")
    same = F.col(key).eqNullSafe(F.col("_seg_doc")) & (F.col("_seg_text") == F.col("_seg_print"))
    marked = documents.withColumn("_seg_text", F.xxhash64(text_of(text)))
    possible, clean = split_by_keys(marked, "_seg_text", found.select(F.col("_seg_print").alias("_seg_text")))
    return clean.unionByName(possible.join(found, same, "left_anti")).drop("_seg_text")
