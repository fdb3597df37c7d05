"""Near copies by SimHash: fingerprints linked by deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.llm.components import connected_components
from segflow.llm.tables import HOT_SHARE, join_groups, stored, text_of

BITS = 64
SHINGLE_WORDS = 4
SEED = 42
#: Most bits in which linked fingerprints differ.
DISTANCE = 4
#: Fingerprints of one variant that are compared directly; a variant that more of them share is cut further.
COMPARED = 8192
#: Cuts of the bits not yet fixed, one within the other. After the last one, at most 2 ** 15 fingerprints agree in all that is fixed.
CUTS = 5
#: Runs of a variant up to this long are compared for a whole batch at once.
_SHORT_RUN = 16
#: Shingles of a long text that are counted at a time.
_SHINGLES = 1 << 16


def text_fingerprint(text: str) -> int:
    """The SimHash of a text's shingles of SHINGLE_WORDS words, repeats included; 0 for a text without words.

    A-Z are lower-cased, words end at ASCII white space, a text of fewer words is one shingle. A bit
    is set if it is set in over half of the shingles' XXH64 values.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    width = min(SHINGLE_WORDS, len(words))
    spans = list(zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()))
    digest, counts = xxhash.xxh64_digest, np.zeros(BITS, np.int64)
    for at in range(0, len(spans), _SHINGLES):
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in spans[at : at + _SHINGLES]])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        counts += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(spans)).tobytes())


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and `fingerprint` of every row, the 64 bits as a signed long; null and empty texts give 0."""

    def fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((text_fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["key", "fingerprint"])

    source = documents.select(F.col(key).alias("key"), text_of(text).alias("text"))
    key_type = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(fingerprint, f"key {key_type}, fingerprint long").withColumnRenamed("key", key)


@lru_cache(maxsize=None)
def _segments(path: int, count: int) -> tuple[tuple[int, ...], ...]:
    """The bits still open on a path, cut into `count` segments. Path 0 has all bits; the child
    `path * count + s + 1` has those outside segment s."""
    if path == 0:
        open_bits = list(range(BITS))
    else:
        parent, taken = divmod(path - 1, count)
        open_bits = [b for s, part in enumerate(_segments(parent, count)) if s != taken for b in part]
    size, more = divmod(len(open_bits), count)
    ends = np.cumsum([size + (s < more) for s in range(count)]).tolist()
    return tuple(tuple(open_bits[a:b]) for a, b in zip([0, *ends], ends))


def _mask(bits: tuple[int, ...]) -> np.uint64:
    return np.uint64(sum(1 << b for b in bits))


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 bits scrambled, so that variants of different buckets and places do not meet."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _variants(bucket: np.ndarray, value: np.ndarray, path: int, segment: int, bits: tuple[int, ...]) -> Iterator[np.ndarray]:
    """For each bit of a segment, the signature of the segment's value without that bit."""
    for bit in bits:
        place = np.uint64((path * BITS + bit + 1) << 8 | segment)
        yield _mixed(_mixed(bucket + place) ^ (value & ~np.uint64(1 << bit)))


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in batch.columns]


def _batch(names: str, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names.split())


def _by_path(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """path, buckets and fingerprints of the members of each batch, path by path."""
    for batch in batches:
        bucket, path, prints = _columns(batch)
        for p in np.unique(path):
            at = path == p
            yield int(p), bucket[at].view(np.uint64), prints[at].view(np.uint64)


def _segment_values(members: DataFrame, count: int) -> DataFrame:
    """bucket, path, segment and value for each segment of each member."""

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, bucket, prints in _by_path(batches):
            for s, bits in enumerate(_segments(path, count)):
                same = np.full(len(prints), path, np.int32), np.full(len(prints), s, np.int32)
                yield _batch("bucket path segment value", bucket.view(np.int64), *same, (prints & _mask(bits)).view(np.int64))

    return members.mapInArrow(values, "bucket long, path int, segment int, value long")


def _value_variants(values: DataFrame, count: int) -> DataFrame:
    """The signatures that members with these segment values have."""

    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, path, segment, value = _columns(batch)
            for p, s in sorted(set(zip(path.tolist(), segment.tolist()))):
                at = (path == p) & (segment == s)
                for key in _variants(bucket[at].view(np.uint64), value[at].view(np.uint64), p, s, _segments(p, count)[s]):
                    yield _batch("signature", key.view(np.int64))

    return values.select("bucket", "path", "segment", "value").mapInArrow(signatures, "signature long").distinct()


def _member_variants(members: DataFrame, count: int) -> DataFrame:
    """The index: a row for each member and bit, with the path that a further cut of it would take."""

    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, bucket, prints in _by_path(batches):
            for s, bits in enumerate(_segments(path, count)):
                child, value = np.full(len(prints), path * count + s + 1, np.int32), prints & _mask(bits)
                for key in _variants(bucket, value, path, s, bits):
                    yield _batch("signature path fingerprint", key.view(np.int64), child, prints.view(np.int64))

    return members.mapInArrow(signatures, "signature long, path int, fingerprint long")


def spanning_links(prints: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join all fingerprints of an array that links join: each reached one is compared with those not yet reached."""
    found, rest = [], prints
    while len(rest):
        reached, rest = [rest[:1]], rest[1:]
        while reached and len(rest):
            for x in reached.pop():
                near = np.bitwise_count(rest ^ x) <= distance
                if near.any():
                    new, rest = rest[near], rest[~near]
                    found.append((np.full(len(new), x), new))
                    reached.append(new)
    return found


def _run_links(prints: np.ndarray, starts: np.ndarray, lengths: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within runs of fingerprints that share a signature."""
    run = np.repeat(np.where(lengths <= _SHORT_RUN, np.arange(len(lengths)), -1 - np.arange(len(lengths))), lengths)
    for k in range(1, min(_SHORT_RUN, int(lengths.max(initial=0)))):
        at = np.flatnonzero((run[k:] == run[:-k]) & (run[k:] >= 0))
        at = at[np.bitwise_count(prints[at] ^ prints[at + k]) <= distance]
        yield prints[at], prints[at + k]
    for i in np.flatnonzero(lengths > _SHORT_RUN):
        yield from spanning_links(prints[starts[i] : starts[i] + lengths[i]], distance)


def _verified(index: DataFrame, distance: int, limit: int | None) -> DataFrame:
    """Joins the index with itself on the signature: `a`, `b` of links, and members of signatures that more than
    `limit` share (`bucket`, `path`, `fingerprint`), which are passed on without being held."""
    links, members = "a b bucket path fingerprint", "bucket long, path int, fingerprint long"

    def as_links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        none = [pa.nulls(len(a), t) for t in (pa.int64(), pa.int32(), pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), *none], links.split())

    def as_members(rows: list[np.ndarray]) -> pa.RecordBatch:
        none = pa.nulls(len(rows[0]), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, *map(pa.array, rows)], links.split())

    def compared(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, _, prints = rows
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
        lengths = np.diff(np.r_[starts, len(key)])
        if limit is not None and (lengths > limit).any():
            large = np.repeat(lengths > limit, lengths)
            yield as_members([r[large] for r in rows])
            yield from compared([r[~large] for r in rows])
            return
        pairs = list(_run_links(prints.view(np.uint64), starts, lengths, distance))
        if pairs:
            a, b = (np.concatenate(side) for side in zip(*pairs))
            if len(a):
                both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
                yield as_links(both[0], both[1])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        passing = None
        for batch in batches:
            rows = _columns(batch)
            if passing is not None:
                n = int(np.searchsorted(rows[0], passing, "right"))
                yield as_members([r[:n] for r in rows])
                rows = [r[n:] for r in rows]
            if not len(rows[0]):
                continue
            passing = None
            if held is not None:
                rows = [np.concatenate(pair) for pair in zip(held, rows)]
            last = int(np.searchsorted(rows[0], rows[0][-1], "left"))
            yield from compared([r[:last] for r in rows])
            held = [r[last:] for r in rows]
            if limit is not None and len(held[0]) > limit:
                yield as_members(held)
                held, passing = None, rows[0][-1]
        if held is not None:
            yield from compared(held)

    ordered = index.repartition("signature").sortWithinPartitions("signature")
    return ordered.mapInArrow(verify, f"a long, b long, {members}")


def fingerprint_links(prints: DataFrame, distance: int = DISTANCE, compared: int = COMPARED) -> DataFrame:
    """`a`, `b`: links that join all distinct fingerprints that differ in at most `distance` bits, directly or by others.

    The bits are cut into distance // 2 + 1 segments, so that one of them differs in at most one
    bit. The index holds each segment's value with each of its bits deleted in turn: fingerprints
    that agree up to one bit in a segment meet under the variant without that bit, and are verified
    there. Where more than `compared` fingerprints meet, none is left out: the bits outside the
    segment differ in no more than `distance` places either, so they are cut and indexed in the same
    way, within that variant. Segment values held by more than one in HOT_SHARE fingerprints go on
    to that cut at once, before any shuffle, so no task reads a hot variant.
    """
    count = distance // 2 + 1
    members = prints.select(F.lit(0).cast("long").alias("bucket"), F.lit(0).alias("path"), "fingerprint")
    links = []
    for cut in range(CUTS):
        last = cut == CUTS - 1
        total = members.count()
        if not total:
            break
        index, waiting = _member_variants(members, count), None
        if not last:
            sizes = _segment_values(members, count).groupBy("bucket", "path", "segment", "value").count()
            hot = stored(_value_variants(sizes.filter(F.col("count") > max(compared, total / HOT_SHARE)), count), "hot")
            if not hot.isEmpty():
                waiting = index.join(F.broadcast(hot), "signature", "left_semi").withColumnRenamed("signature", "bucket")
                index = index.join(F.broadcast(hot), "signature", "left_anti")
        found = stored(_verified(index, distance, None if last else compared), "simhash")
        links.append(found.filter("a is not null").select("a", "b"))
        members = found.filter("a is null").select("bucket", "path", "fingerprint")
        if waiting is not None:
            members = stored(members.unionByName(waiting.select(*members.columns)), "members")
    if not links:
        return prints.sparkSession.createDataFrame([], "a long, b long")
    return reduce(DataFrame.unionByName, links)


def simhash_classes(
    documents: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE, compared: int = COMPARED
) -> DataFrame:
    """`key`, `fingerprint` (16 hex digits) and `component_id`, the smallest key that links of fingerprints reach.

    Every row has a result, rows that repeat included. Null and empty texts have the fingerprint 0
    and are linked like any other. A null key is not the smallest unless no other is reached. Equal
    fingerprints are one node of the graph, so copies add no links. An empty table gives no rows;
    other columns are not read.
    """
    prints = stored(fingerprints(documents, key, text), "fingerprints")
    nodes = stored(prints.groupBy("fingerprint").agg(F.min(key).alias("_least"), F.count("*").alias("_n")), "nodes")
    links = fingerprint_links(nodes.select("fingerprint"), distance, compared)
    roots = stored(connected_components(links).withColumnRenamed("node", "fingerprint"), "roots")
    named = roots.join(nodes, "fingerprint").groupBy("root").agg(F.min("_least").alias("_reached"), F.count("*").alias("_size"))
    reached = join_groups(roots, stored(named, "reached"), ["root"], "_size", "inner").select("fingerprint", "_reached")
    classes = nodes.join(reached, "fingerprint", "left").select(
        "fingerprint", F.coalesce("_reached", "_least").alias("component_id"), "_n"
    )
    joined = join_groups(prints, stored(classes, "classes"), ["fingerprint"], "_n", "inner")
    digits = F.lower(F.lpad(F.hex("fingerprint"), BITS // 4, "0"))
    return joined.select(key, digits.alias("fingerprint"), "component_id")
