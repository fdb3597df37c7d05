"""N-gram Jaccard join: MinHash LSH forest, then exact verification."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.llm.components import connected_components
from segflow.llm.rank_bpe import chunks
from segflow.llm.tables import join_groups, split_by_keys, stored, text_of, text_slices

SHINGLE_WORDS = 5
SIMILARITY = 0.8
TREES, MAX_DEPTH = 24, 6
#: Chance that two sets of exactly the least similarity share a prefix in some tree.
RECALL = 0.9999
#: Sketches of two sets agree in about their similarity; families join sets down to this agreement.
#: It lies five deviations of a sketch below the least similarity.
SKETCH_MARGIN = 5.0
#: Sets, and their shingles, of one block of a large group; a task compares two blocks at a time.
BLOCK_SETS, BLOCK_SHINGLES = 400, 1_500_000
KNOWN_WORDS = 400_000

_WORDS = re.compile(r"[^\W_]+").findall


class Shingler:
    """Sets of word shingles as sorted distinct 64-bit hashes; remembers the hashes of words."""

    def __init__(self, size: int = SHINGLE_WORDS):
        self.size = size
        self.known: dict[str, int] = {}

    def shingles(self, text: str) -> np.ndarray:
        """Runs of `size` words in lower case; a shorter text has its words as its only shingle."""
        words = _WORDS(text.lower())
        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        known = self.known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(min(1, len(words)), len(words) - self.size + 1)
        mixed = np.full(n, len(words) if len(words) < self.size else self.size, np.uint64)
        for k in range(min(self.size, len(words))):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
        mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed * np.uint64(0xD6E8FEB86659FD93))


def forest_depth(trees: int, deepest: int, similarity: float, recall: float) -> int:
    """How far prefixes are shortened: from the deepest, level by level, until the recall is reached.

    At depth k two sets of similarity s share a prefix in some tree with probability
    1 - (1 - s**k)**trees. A shorter prefix keeps every match of a longer one.
    """
    depth = deepest
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return depth


class Forest:
    """MinHash signatures in the order of the trees' levels."""

    def __init__(self, trees: int = TREES, deepest: int = MAX_DEPTH, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.trees, self.deepest = trees, deepest
        self.factors = rng.integers(0, 1 << 63, trees * deepest, np.uint64) * np.uint64(2) + np.uint64(1)
        self.offsets = rng.integers(0, 1 << 63, trees * deepest, np.uint64)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """The smallest upper half, over all shingles, of each hash function."""
        least = np.full(len(self.factors), np.iinfo(np.uint32).max, np.uint32)
        for start in range(0, len(shingles), 512):
            part = shingles[start : start + 512, None] * self.factors[None, :] + self.offsets[None, :]
            least = np.minimum(least, (part.min(axis=0) >> np.uint64(32)).astype(np.uint32))
        return least

    def prefixes(self, signatures: np.ndarray, depth: int) -> np.ndarray:
        """For each signature, a number that stands for its prefix of `depth` values in each tree."""
        levels = signatures.reshape(len(signatures), self.trees, self.deepest)[:, :, :depth].astype(np.uint64)
        mixed = np.broadcast_to(np.arange(1, self.trees + 1, dtype=np.uint64), levels.shape[:2]).copy()
        for k in range(depth):
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + levels[:, :, k]
        mixed ^= mixed >> np.uint64(32)
        return (mixed * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def grouped(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by a column: no group is cut between two tables."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_numpy(zero_copy_only=False)
        change = np.flatnonzero(values[1:] != values[:-1])
        fresh = bool(held) and held[-1].column(column)[-1].as_py() != values[0]
        if fresh:
            yield pa.Table.from_batches(held)
            held = []
        if len(change):
            cut = int(change[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def forest_edges(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node it is connected with by the given edges."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        after = root.copy()
        np.minimum.at(after, root[left], low)
        np.minimum.at(after, root[right], low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def _blocks(groups: DataFrame, group: str, n_sets: str, n_shingles: str | None) -> DataFrame:
    """Group, its size and the number of blocks that its sets are dealt to."""
    parts = F.ceil(F.col(n_sets) / BLOCK_SETS)
    if n_shingles:
        parts = F.greatest(parts, F.ceil(F.col(n_shingles) / BLOCK_SHINGLES))
    return groups.select(group, n_sets, parts.cast("int").alias("blocks"))


def _cells(members: DataFrame, group: str) -> DataFrame:
    """Sends each member to every pair of blocks that its own block is in; adds `cell` and `block`.

    All pairs of a group meet in some cell, and a cell holds two blocks at most. A pair of one block
    meets in the cell of this block alone.
    """
    block = F.pmod(F.xxhash64(F.lit("block"), "set"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = members.withColumn("block", block).withColumn("other", other)
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return dealt.withColumn("cell", F.xxhash64(group, low, high)).withColumn("alone", F.col("block") == F.col("other")).drop("other")


def shingle_rows(documents: DataFrame, key: str, text: str, forest: Forest, depth: int) -> DataFrame:
    """A row for each document: key, hash of its text, hash and number of its shingles, signature and prefixes.

    The prefixes stand for whole values; the signature keeps the lower eight bits of each. Equal
    values agree in them, others hardly ever do, so families lose nothing.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in text_slices(batches, 2):
            marks, sizes, signatures = [], [], []
            for texts in chunks(batch.column(2)):
                for text in texts:
                    shingles = shingler.shingles(text)
                    marks.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                    sizes.append(len(shingles))
                    signatures.append(forest.signature(shingles))
            matrix = np.array(signatures, np.uint32).reshape(len(sizes), -1)
            prefixes = forest.prefixes(matrix, depth)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(marks, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array([x.tobytes() for x in matrix.astype(np.uint8)], pa.binary()),
                    pa.ListArray.from_arrays(
                        np.arange(0, prefixes.size + 1, forest.trees, dtype=np.int32), pa.array(prefixes.ravel())
                    ),
                ],
                ["doc", "print", "mark", "size", "signature", "prefixes"],
            )

    source = documents.select(F.col(key).alias("doc"), F.xxhash64(text_of(text)).alias("print"), F.col(text).alias("text"))
    kind = source.schema["doc"].dataType.simpleString()
    return source.mapInArrow(
        sketch, f"doc {kind}, print long, mark binary, size long, signature binary, prefixes array<long>"
    )


def _candidate_edges(sets: DataFrame, forest: Forest, least: float) -> DataFrame:
    """Edges that connect sets which share a prefix and whose signatures agree in `least` of their values."""
    places = sets.filter("size > 0").select("set", F.explode("prefixes").alias("prefix"))
    groups = places.groupBy("prefix").agg(F.count("*").alias("n")).filter("n > 1")
    groups = stored(_blocks(groups, "prefix", "n", None), "prefixes")
    possible, _ = split_by_keys(places, "prefix", groups)
    members = stored(join_groups(possible, groups, ["prefix"], "n", "inner"), "members")
    signatures, _ = split_by_keys(sets.select("set", "signature"), "set", members)
    cells = _cells(members, "prefix").select("cell", "alone", "block", "set").join(signatures, "set")
    cells = cells.repartition("cell").sortWithinPartitions("cell", "block", "set")
    agree = int(np.ceil(least * forest.trees * forest.deepest))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, 1):
            cell = table.column("cell").to_numpy()
            node = table.column("set").to_numpy()
            raw = b"".join(table.column("signature").to_pylist())
            signature = np.frombuffer(raw, np.uint8).reshape(len(cell), -1)
            left, right = [], []
            for step in range(1, len(cell)):
                at = np.flatnonzero(cell[step:] == cell[:-step])
                if not len(at):
                    break
                for part in np.array_split(at, len(at) // 20_000 + 1):
                    close = (signature[part] == signature[part + step]).sum(axis=1) >= agree
                    left.append(part[close])
                    right.append(part[close] + step)
            root = forest_edges(len(cell), np.concatenate([*left, _NO]), np.concatenate([*right, _NO]))
            tied = root != np.arange(len(cell))
            yield pa.RecordBatch.from_arrays([pa.array(node[tied]), pa.array(node[root[tied]])], ["a", "b"])

    return cells.select("set", "cell", "signature").mapInArrow(compare, "a long, b long").filter("a <> b").distinct()


_NO = np.zeros(0, np.int64)


def similar_pairs(shingles: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the pairs of sets whose Jaccard similarity is at least `similarity`, exactly."""
    m = len(shingles)
    sizes = np.fromiter(map(len, shingles), np.int64, m)
    _, place, counts = np.unique(np.concatenate(shingles), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), sizes)
    shared = counts[place] > 1
    number = np.cumsum(counts > 1) - 1
    columns, owner = number[place[shared]], owner[shared]
    order = np.argsort(columns, kind="stable")
    columns, owner = columns[order], owner[order]
    common = np.zeros((m, m), np.float64)
    width = 4096
    for start in range(0, int(columns[-1]) + 1 if len(columns) else 0, width):
        a, b = np.searchsorted(columns, [start, start + width])
        present = np.zeros((m, min(width, int(columns[b - 1]) - start + 1)), np.float32)
        present[owner[a:b], columns[a:b] - start] = 1
        common += present @ present.T
    union = sizes[:, None] + sizes[None, :] - common
    left, right = np.nonzero(np.triu(common >= similarity * union - 1e-9, 1))
    return left, right


def _verified(members: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """For each set: `near`, the rows of other sets similar to it, and edges that connect similar sets.

    Rows are (set, other, near): near counts for set, other is tied to it or null.
    """

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in text_slices(batches, 1):
            found = [shingler.shingles(t).tobytes() for part in chunks(batch.column(1)) for t in part]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["set", "shingles"])

    sets = texts.select("set", "text").mapInArrow(shingle, "set long, shingles binary")
    cells = _cells(members, "family").join(sets, "set")
    cells = cells.repartition("cell").sortWithinPartitions("cell", "block", "set")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches):
            cell = table.column("cell").to_numpy()
            starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            for a, b in zip(starts, np.r_[starts[1:], len(cell)]):
                part = table.slice(a, b - a)
                node, copies = part.column("set").to_numpy(), part.column("copies").to_numpy()
                block = part.column("block").to_numpy()
                hashes = [np.frombuffer(x, np.uint64) for x in part.column("shingles").to_pylist()]
                left, right = similar_pairs(hashes, similarity)
                if not part.column("alone")[0].as_py():
                    across = block[left] != block[right]
                    left, right = left[across], right[across]
                if not len(left):
                    continue
                near = np.bincount(left, copies[right], len(node)) + np.bincount(right, copies[left], len(node))
                root = forest_edges(len(node), left, right)
                some = near > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[some]), pa.array(node[root[some]]), pa.array(near[some].astype(np.int64))],
                    ["set", "other", "near"],
                )

    columns = cells.select("cell", "alone", "block", "set", "copies", "shingles")
    return columns.mapInArrow(compare, "set long, other long, near long")


def near_classes(documents: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """A row per document: key, print (hash of the text), class_id and n_links.

    Two documents are linked if the Jaccard similarity of their sets of five-word shingles is at
    least `similarity`; n_links counts the other documents linked to one, copies included, and
    class_id is the smallest key of all documents connected by links (null if all are null). Null
    texts and texts without words have no links, and are each a class of their own key. Documents
    of equal shingles are one set from the start; sets are compared in blocks, so that neither
    copies nor large groups become rows of pairs. Repeated rows are documents like others. An empty
    table gives no rows.
    """
    found = _classes(documents, key, text, similarity)
    return found.select(F.col("doc").alias(key), "print", "class_id", "n_links")


def keep_one(documents: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The documents, all columns, with one document of each class of near_classes().

    The one with the smallest key stays, null keys last, and of equal keys one text; of repeated
    rows one stays. Documents without links stay as they are.
    """
    classes = _classes(documents, key, text, similarity).filter("n_links > 0")
    classes = stored(classes.select("doc", "print", "root"), "linked")
    first = F.min(F.struct(F.col("doc").isNull().alias("last"), "doc", "print")).alias("first")
    keepers = classes.groupBy("root").agg(first).select(F.col("first.doc").alias("_seg_doc"), F.col("first.print").alias("_seg_print"))
    linked = classes.select(F.col("doc").alias("_seg_doc"), F.col("print").alias("_seg_print")).distinct()
    same = F.col(key).eqNullSafe(F.col("_seg_doc")) & (F.col("_seg_text") == F.col("_seg_print"))
    marked = documents.withColumn("_seg_text", F.xxhash64(text_of(text)))
    possible, alone = split_by_keys(marked, "_seg_text", linked.select(F.col("_seg_print").alias("_seg_text")))
    unlinked = possible.join(linked, same, "left_anti")
    kept = possible.join(keepers, same).dropDuplicates(["_seg_doc", "_seg_print"]).drop("_seg_doc", "_seg_print")
    return alone.unionByName(unlinked).unionByName(kept).drop("_seg_text")


def _classes(documents: DataFrame, key: str, text: str, similarity: float) -> DataFrame:
    """doc, print, root (number of the class, null without links of any kind), class_id and n_links."""
    rows, sets = _sets(documents, key, text, similarity)
    linked = _links(documents, sets, key, text, similarity)
    edges = linked.select(F.col("set").alias("a"), F.col("other").alias("b"))
    roots = connected_components(edges)
    near = linked.groupBy("set").agg(F.sum("near").alias("near"))
    named = sets.select("set", "mark", "size", "copies", "least").join(roots.withColumnRenamed("node", "set"), "set", "left")
    named = stored(named.join(near, "set", "left").withColumn("root", F.coalesce("root", "set")), "named")
    classes = named.groupBy("root").agg(F.min("least").alias("class_id"), F.count("*").alias("n"))
    named = join_groups(named, classes, ["root"], "n", "inner")
    links = F.col("copies") - 1 + F.coalesce("near", F.lit(0))
    whole = stored(
        named.filter("size > 0").select("mark", "copies", "root", "class_id", links.cast("long").alias("n_links")), "classes"
    )
    found = join_groups(rows, whole, ["mark"], "copies")
    return found.select(
        "doc",
        "print",
        "root",
        F.when(F.col("n_links").isNull(), F.col("doc")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def _sets(documents: DataFrame, key: str, text: str, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Stored rows (doc, print, mark) and stored sets of distinct shingles, numbered by `set`."""
    forest, depth = Forest(), forest_depth(TREES, MAX_DEPTH, similarity, RECALL)
    rows = stored(shingle_rows(documents, key, text, forest, depth), "sketches")
    sets = rows.groupBy("mark").agg(
        F.count("*").alias("copies"),
        F.min("doc").alias("least"),
        F.min(F.struct("doc", "print")).alias("sample"),
        F.first("size").alias("size"),
        F.first("signature").alias("signature"),
        F.first("prefixes").alias("prefixes"),
    )
    sets = stored(stored(sets, "sets").withColumn("set", F.monotonically_increasing_id()), "sets")
    return rows.select("doc", "print", "mark"), sets


def _links(documents: DataFrame, sets: DataFrame, key: str, text: str, similarity: float) -> DataFrame:
    """Stored rows (set, other, near) of _verified for all families."""
    forest = Forest()
    values = forest.trees * forest.deepest
    least = similarity - SKETCH_MARGIN * float(np.sqrt(similarity * (1 - similarity) / values))
    edges = _candidate_edges(sets, forest, least)
    family = connected_components(edges).select(F.col("node").alias("set"), F.col("root").alias("family"))
    members = stored(sets.select("set", "copies", "size", "sample").join(family, "set"), "families")
    families = members.groupBy("family").agg(F.count("*").alias("n"), F.sum("size").alias("shingles"))
    families = stored(_blocks(families, "family", "n", "shingles"), "blocks")
    samples = members.select("set", F.col("sample.doc").alias("sample_doc"), F.col("sample.print").alias("sample_print"))
    same = F.col("doc").eqNullSafe(F.col("sample_doc")) & (F.col("print") == F.col("sample_print"))
    source = documents.select(F.col(key).alias("doc"), F.xxhash64(text_of(text)).alias("print"), text_of(text).alias("text"))
    possible, _ = split_by_keys(source, "print", samples.select(F.col("sample_print").alias("print")))
    texts = possible.join(samples, same).select("set", "text")
    if members.filter("copies > 1").limit(1).count():
        texts = texts.dropDuplicates(["set"])
    dealt = join_groups(members.select("set", "copies", "family"), families, ["family"], "n", "inner")
    return stored(_verified(dealt, texts, similarity), "links")
