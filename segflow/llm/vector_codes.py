"""Codes of a byte a part for vectors: integer product quantization whose assignments are Orchard searches."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.llm.tables import join_groups, stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Vectors that a task searches for at a time.
_BLOCK = 8192
#: Larger whole components could leave 64 bits when their squared differences are added.
_LARGEST = 1 << 26


class EntryLists:
    """One part's codebook, with each entry's other entries in order of their distance from it."""

    def __init__(self, book: np.ndarray):
        self.book = book
        between = ((book[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
        np.fill_diagonal(between, -1)
        order = np.argsort(between, axis=1, kind="stable")[:, 1:]
        end = np.full((len(book), 1), np.iinfo(np.int64).max)
        self.gaps = np.concatenate([np.take_along_axis(between, order, 1), end], axis=1)
        self.order = np.concatenate([order, np.zeros((len(book), 1), np.int64)], axis=1)
        self.by_sum = np.argsort(book.sum(axis=1), kind="stable")
        self.sums = book.sum(axis=1)[self.by_sum]

    def nearest(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each value's nearest entry, the lower index of equally near ones, and its squared distance.

        A search starts at an entry with a similar sum and walks along the list of the nearest entry
        it knows; a nearer one, or one as near of lower index, makes it jump to that one's list.
        Entries it has measured are marked and not measured again. It ends where an entry lies
        beyond twice the current distance from the list's owner: by the triangle inequality neither
        that entry nor a later one can be as near as the owner.
        """
        n = len(values)
        place = np.clip(np.searchsorted(self.sums, values.sum(axis=1)), 0, len(self.book) - 1)
        best = self.by_sum[place]
        distance = ((values - self.book[best]) ** 2).sum(axis=1)
        marked = np.zeros((n, len(self.book)), bool)
        marked[np.arange(n), best] = True
        at, going = np.zeros(n, np.int64), np.arange(n)
        while len(going):
            owner, step = best[going], at[going]
            inside = self.gaps[owner, step] <= 4 * distance[going]
            going, entry = going[inside], self.order[owner[inside], step[inside]]
            at[going] += 1
            new = ~marked[going, entry]
            fresh, entry = going[new], entry[new]
            marked[fresh, entry] = True
            measured = ((values[fresh] - self.book[entry]) ** 2).sum(axis=1)
            nearer = (measured < distance[fresh]) | ((measured == distance[fresh]) & (entry < best[fresh]))
            jump = fresh[nearer]
            best[jump], distance[jump], at[jump] = entry[nearer], measured[nearer], 0
        return best, distance


def whole_components(vectors: pa.Array, parts: int, scale: int = SCALE) -> np.ndarray:
    """Vectors as (part, row, component) of floor(scale * x)."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(flat * scale)
    if np.abs(whole).max(initial=0) >= _LARGEST:
        raise OverflowError(f"components times {scale} must stay below {_LARGEST}")
    return whole.astype(np.int64).reshape(len(vectors), parts, -1).transpose(1, 0, 2)


@dataclass(frozen=True)
class Codebooks:
    """(part, entry, component) of whole numbers, and the scale that vectors are multiplied by."""

    entries: np.ndarray
    scale: int = SCALE

    def sha256(self) -> str:
        """Hash of all components as decimal numbers joined by commas, by part, entry and component."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def usable(vectors: DataFrame, vector: str, dimension: int | None = None) -> DataFrame:
    """Rows whose vector is there, has components and only finite ones, and has `dimension` of them if that is given."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    size = F.size(vector)
    return vectors.filter(F.coalesce((size > 0 if dimension is None else size == dimension) & finite, F.lit(False)))


def fit_codebooks(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    *,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codebooks | None:
    """Codebooks refined in `rounds` from the vectors of the smallest keys; None if no vector is usable.

    Every round assigns all parts of all vectors and moves each entry to the floor of its parts'
    mean; entries without parts stay. Sums are added up in the tasks and by groups of (part, entry),
    so what a round brings to the driver is one row for each entry, however many vectors there are.
    Vectors of another length than the smallest key's are left out.
    """
    first = usable(vectors, vector).select(key, vector).orderBy(F.col(key).asc_nulls_last(), vector).limit(1).first()
    if first is None:
        return None
    dimension = len(first[1])
    if dimension % parts:
        raise ValueError(f"{dimension} components cannot be cut into {parts} equal parts")
    source = usable(vectors, vector, dimension).select(key, F.col(vector).cast("array<double>").alias("vector"))
    start = source.orderBy(F.col(key).asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    books = whole_components(pa.array([r[0] for r in start], pa.list_(pa.float64())), parts, scale)
    width = dimension // parts
    sums = [f"s{i}" for i in range(width)]

    for _ in range(rounds):

        def totals(batches: Iterator[pa.RecordBatch], books=books) -> Iterator[pa.RecordBatch]:
            lists = [EntryLists(book) for book in books]
            count = np.zeros(books.shape[:2], np.int64)
            total = np.zeros(books.shape, np.int64)
            for batch in batches:
                for at in range(0, batch.num_rows, _BLOCK):
                    for part, values in enumerate(whole_components(batch.column(0).slice(at, _BLOCK), parts, scale)):
                        best, _ = lists[part].nearest(values)
                        count[part] += np.bincount(best, minlength=books.shape[1])
                        np.add.at(total[part], best, values)
            part, entry = np.nonzero(count)
            columns = [part, entry, count[part, entry], *total[part, entry].T]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["part", "entry", "n", *sums])

        schema = ", ".join(f"{name} long" for name in ("part", "entry", "n", *sums))
        moved = source.select("vector").mapInArrow(totals, schema).groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in sums]
        )
        books = books.copy()
        for row in moved.collect():
            books[row["part"], row["entry"]] = [row[s] // row["n"] for s in sums]
    return Codebooks(books, scale)


def assign_codes(
    vectors: DataFrame, books: Codebooks, key: str = "vec_id", vector: str = "embedding", carried: tuple[str, ...] = ()
) -> DataFrame:
    """Key, carried columns, `code` (two hex digits for each part) and `error`, the squared distances summed over parts.

    Rows without a usable vector of the codebooks' length have no row.
    """
    parts, _, width = books.entries.shape
    entries, scale = books.entries, books.scale

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = [EntryLists(book) for book in entries]
        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK):
                block = batch.slice(at, _BLOCK)
                codes = np.zeros((block.num_rows, parts), np.uint8)
                error = np.zeros(block.num_rows, np.int64)
                for part, values in enumerate(whole_components(block.column(block.num_columns - 1), parts, scale)):
                    codes[:, part], distance = lists[part].nearest(values)
                    error += distance
                digits = [row.tobytes().hex() for row in codes]
                yield pa.RecordBatch.from_arrays(
                    [*block.columns[:-1], pa.array(digits, pa.string()), pa.array(error)], [*names, "code", "error"]
                )

    source = usable(vectors, vector, parts * width).select(
        F.col(key).alias("key"),
        *[F.col(c).alias(f"carried{i}") for i, c in enumerate(carried)],
        F.col(vector).cast("array<double>").alias("vector"),
    )
    names = source.columns[:-1]
    schema = ", ".join(f"{n} {source.schema[n].dataType.simpleString()}" for n in names)
    coded = source.mapInArrow(assign, f"{schema}, code string, error long")
    return coded.select(*[F.col(n).alias(c) for n, c in zip(names, (key, *carried))], "code", "error")


def vector_codes(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", **settings
) -> DataFrame:
    """Key, `code`, `error`, `label_error` (errors summed over equal labels, nulls together) and `codebooks_sha256`.

    Rows whose vector is null, empty, or holds a null or a number that is not finite are dropped, as
    are vectors of another length than that of the smallest key. Repeated keys keep a row each; a
    null key comes after all others. An empty table gives no rows.
    """
    books = fit_codebooks(vectors, key, vector, **settings)
    if books is None:
        types = vectors.schema[key].dataType.simpleString()
        schema = f"`{key}` {types}, code string, error long, label_error long, codebooks_sha256 string"
        return vectors.sparkSession.createDataFrame([], schema)
    coded = vectors.select(key, vector, F.col(label).alias("_label"))
    coded = stored(assign_codes(coded, books, key, vector, ("_label",)), "codes")
    # A label of null joins as an empty text, others as texts that are not empty.
    named = coded.withColumn("_group", F.coalesce(F.concat(F.lit("="), F.col("_label").cast("string")), F.lit("")))
    totals = named.groupBy("_group").agg(F.sum("error").alias("label_error"), F.count("*").alias("_n"))
    return join_groups(named, stored(totals, "labels"), ["_group"], "_n", "inner").select(
        key, "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
