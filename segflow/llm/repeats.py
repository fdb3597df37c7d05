"""Repeated byte strings: anchors bring equal strings together, suffix arrays tell which are equal."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.llm.anchors import anchored, gram_hashes, segment_hash
from segflow.llm.linear_grouping import suffix_array
from segflow.llm.near_duplicates import grouped
from segflow.llm.tables import join_groups, split_by_keys, stored, text_of

LENGTH = 400
ANCHOR = 160
#: Bytes at a phrase's start, and one in how many such strings starts a phrase.
TRIGGER, TRIGGER_SHARE = 8, 32
#: Bytes of segments that one suffix array covers, about, and of an anchor's segments at most.
CHUNK_BYTES, GROUP_BYTES = 1 << 19, 1 << 23


def _alpha_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes from each start to its stop."""
    factor = 0x9E3779B97F4A7C15
    up = np.full(len(data) + 1, factor, np.uint64)
    up[0] = 1
    np.multiply.accumulate(up, out=up)
    down = np.full(len(data) + 1, pow(factor, -1, 1 << 64), np.uint64)
    down[0] = 1
    np.multiply.accumulate(down, out=down)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return (sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64)


def repeated_starts(segments: list[bytes], n_starts: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each segment, which of its first n_starts places start a string of `length` bytes found at another listed place.

    Segments are cut into phrases where certain short strings occur, and the sequence of phrases,
    ranked by their bytes, is suffix-sorted. Phrases overlap by the string that ends them, so none
    is the beginning of another and the order of phrase suffixes is that of their bytes. A place is
    ordered by the bytes up to its next phrase and the rank of the suffix from there. Places that
    start equal strings are then neighbours, and neighbours are compared byte by byte. A string
    that holds no phrase start is ordered by all of its bytes.
    """
    whole = b"".join(segments)
    data = np.frombuffer(whole, np.uint8)
    sizes = np.fromiter(map(len, segments), np.int64, len(segments))
    bases = np.cumsum(sizes) - sizes
    marks = gram_hashes(data, TRIGGER) % np.uint64(TRIGGER_SHARE) == 0
    triggers = np.flatnonzero(marks)
    owner = np.searchsorted(bases, triggers, side="right") - 1
    triggers = triggers[triggers + TRIGGER <= bases[owner] + sizes[owner]]

    heads = np.unique(np.concatenate([bases, triggers]))
    owner = np.searchsorted(bases, heads, side="right") - 1
    segment_ends = bases[owner] + sizes[owner]
    stops = np.minimum(np.r_[heads[1:], len(data)] + TRIGGER, segment_ends)
    phrases = [whole[a:b] for a, b in zip(heads.tolist(), stops.tolist())]
    rank_of = {p: i + 1 for i, p in enumerate(sorted(set(phrases)))}
    # A zero, below all phrases, ends each segment.
    ends_segment = np.r_[owner[1:] != owner[:-1], True]
    shift = np.cumsum(ends_segment) - ends_segment
    symbols = np.zeros(len(heads) + len(segments), np.int64)
    places = np.arange(len(heads)) + shift
    symbols[places] = np.fromiter(map(rank_of.__getitem__, phrases), np.int64, len(phrases))
    rank = np.empty(len(symbols), np.int64)
    rank[np.array(suffix_array(symbols.tolist()), np.int64)] = np.arange(len(symbols))
    head_rank = rank[places]

    counts = np.array(n_starts, np.int64)
    starts = np.arange(counts.sum()) + np.repeat(bases - np.cumsum(counts) + counts, counts)
    is_trigger = np.zeros(len(heads), bool)
    is_trigger[np.searchsorted(heads, triggers)] = True
    trigger_heads = np.flatnonzero(is_trigger)
    following = np.searchsorted(heads[trigger_heads], starts)
    inside = following < len(trigger_heads)
    at = trigger_heads[np.minimum(following, len(trigger_heads) - 1)] if len(trigger_heads) else np.zeros(len(starts), np.int64)
    inside &= heads[at] + TRIGGER <= starts + length if len(trigger_heads) else False
    alpha_stop = np.where(inside, heads[at], starts + length)
    alpha = _alpha_hashes(data, starts, alpha_stop)
    order = np.lexsort((np.where(inside, head_rank[at], -1), alpha))
    ordered = starts[order]
    windows = _alpha_hashes(data, starts, starts + length)[order]
    likely = np.flatnonzero(windows[1:] == windows[:-1])
    equal = [whole[a : a + length] == whole[b : b + length] for a, b in zip(ordered[likely].tolist(), ordered[likely + 1].tolist())]
    likely = likely[np.array(equal, bool)] if len(likely) else likely
    twice = np.zeros(len(starts), bool)
    twice[order[likely]] = True
    twice[order[likely + 1]] = True
    return np.split(twice, np.cumsum(counts)[:-1])


def covered(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of bytes, as first and stop, that strings of `length` bytes from ascending starts cover."""
    if not len(starts):
        return starts, starts
    new = np.flatnonzero(np.r_[True, starts[1:] > starts[:-1] + length])
    return starts[new], np.r_[starts[new[1:] - 1], starts[-1]] + length


def _occurrences(source: DataFrame) -> DataFrame:
    """doc, print, anchor, segment, first (start of the segment), n_starts and offset of the anchor, in narrow rows."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, columns = [], [[], [], [], [], []]
            for i, value in enumerate(batch.column(2)):
                data = (value.as_py() or "").encode()
                anchors, place, first, last = anchored(data, LENGTH, ANCHOR)
                row.append(np.full(len(anchors), i))
                marks = [segment_hash(data, a, b, LENGTH, p)[:8] for a, b, p in zip(first.tolist(), last.tolist(), place.tolist())]
                marks = np.frombuffer(b"".join(marks), np.int64)
                for column, values in zip(columns, (anchors.view(np.int64), marks, first, last - first + 1, place - first)):
                    column.append(values)
                if len(row) >= 2048:
                    yield _narrow(batch, row, columns)
                    row, columns = [], [[], [], [], [], []]
            if row:
                yield _narrow(batch, row, columns)

    kind = source.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, print long, anchor long, segment long, first int, n_starts int, offset int"
    return source.select("doc", "print", "text").mapInArrow(find, schema)


def _narrow(batch: pa.RecordBatch, row: list, columns: list) -> pa.RecordBatch:
    rows = pa.array(np.concatenate(row))
    anchors, marks, *places = (np.concatenate(c) for c in columns)
    arrays = [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(anchors), pa.array(marks)]
    arrays += [pa.array(p.astype(np.int32)) for p in places]
    return pa.RecordBatch.from_arrays(arrays, ["doc", "print", "anchor", "segment", "first", "n_starts", "offset"])


_RUNS = "array<struct<a:int,b:int>>"


def _runs_array(runs: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    flat_a = np.concatenate([a for a, _ in runs]).astype(np.int32)
    flat_b = np.concatenate([b for _, b in runs]).astype(np.int32)
    offsets = np.r_[0, np.cumsum([len(a) for a, _ in runs])].astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([flat_a, flat_b], ["a", "b"]))


def _resolve(segments: DataFrame) -> DataFrame:
    """anchor, segment and runs of the segment that other segments of its anchor, or copies, repeat.

    The segments of an anchor, up to GROUP_BYTES, share a suffix array, several anchors to one.
    """

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches):
            anchor = table.column("anchor").to_numpy()
            sizes = table.column("size").to_numpy()
            cuts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1], True])
            start = 0
            total = np.r_[0, np.cumsum(sizes)]
            while start < len(cuts) - 1:
                stop = start + 1
                while stop < len(cuts) - 1 and total[cuts[stop + 1]] - total[cuts[start]] <= CHUNK_BYTES:
                    stop += 1
                part = table.slice(cuts[start], cuts[stop] - cuts[start])
                start = stop
                found = repeated_starts(part.column("bytes").to_pylist(), part.column("n_starts").to_pylist())
                copies = part.column("n").to_numpy() > 1
                runs = [covered(np.arange(len(t)) if c else np.flatnonzero(t), LENGTH) for t, c in zip(found, copies)]
                some = np.flatnonzero([len(a) > 0 for a, _ in runs])
                if len(some):
                    rows = part.take(pa.array(some)).combine_chunks()
                    yield pa.RecordBatch.from_arrays(
                        [
                            rows.column("anchor").combine_chunks(),
                            rows.column("segment").combine_chunks(),
                            rows.column("n").combine_chunks(),
                            _runs_array([runs[i] for i in some.tolist()]),
                        ],
                        ["anchor", "segment", "n", "runs"],
                    )

    ordered = segments.repartition("anchor").sortWithinPartitions("anchor", "segment")
    columns = ordered.select("anchor", "segment", "n", "n_starts", F.length("bytes").cast("long").alias("size"), "bytes")
    return columns.mapInArrow(resolve, f"anchor long, segment long, n long, runs {_RUNS}")


def _resolve_large(segments: DataFrame) -> DataFrame:
    """The same for anchors with more bytes of segments: their strings are counted by 128-bit hashes, one to a row."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data, n = batch.column(4)[i].as_py(), batch.column(3)[i].as_py()
                digests = [xxhash.xxh3_128_digest(data[s : s + LENGTH]) for s in range(n)]
                repeat = [batch.column(k).slice(i, 1).take(pa.array(np.zeros(n, np.int64))) for k in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [*repeat, pa.array(np.arange(n), pa.int32()), pa.array(digests, pa.binary())],
                    ["anchor", "segment", "n", "start", "string"],
                )

    rows = segments.select("anchor", "segment", "n", "n_starts", "bytes").mapInArrow(
        strings, "anchor long, segment long, n long, start int, string binary"
    )
    counts = rows.groupBy("anchor", "string").agg(F.sum("n").alias("times"), F.count("*").alias("rows")).filter("times > 1")
    hits = join_groups(rows, stored(counts, "strings"), ["anchor", "string"], "rows", "inner")
    starts = hits.groupBy("anchor", "segment", "n").agg(F.collect_set("start").alias("starts"))
    # A segment has at most LENGTH - ANCHOR + 1 starts.
    runs = F.transform("starts", lambda s: F.struct(s.alias("a"), (s + LENGTH).alias("b")))
    return starts.select("anchor", "segment", "n", runs.alias("runs"))


def remove_repeats(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_bytes, spans (array of start and stop, in UTF-8 bytes) and kept, the bytes outside them.

    A span is a longest run of bytes each covered by a LENGTH-byte string that also starts elsewhere,
    in the same or another document. Strings are judged on the input and do not cross documents.
    Null texts are empty; texts of fewer bytes have no spans; repeated rows of a key and text repeat
    each other. An empty table gives no rows.

    Equal strings have equal anchors, so they meet in the group of one anchor. Copies of a segment
    (the strings of one anchor in a place) are counted before anything moves; only segments of
    anchors that several different segments share need their bytes sorted.
    """
    source = documents.select(F.col(key).alias("doc"), F.xxhash64(text_of(text)).alias("print"), text_of(text).alias("text"))
    occurrences = stored(_occurrences(source), "anchors")
    sample = F.min(F.struct("doc", "print", "first", "n_starts", "offset")).alias("sample")
    segments = occurrences.groupBy("anchor", "segment").agg(F.count("*").alias("n"), sample)
    segments = stored(segments, "segments")
    size = F.col("sample.n_starts") + LENGTH - 1
    anchors = segments.groupBy("anchor").agg(
        F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum(size).alias("bytes")
    )
    anchors = stored(anchors.filter("total > 1"), "shared")

    # Anchors with one kind of segment: all of it is repeated, and nothing has to be compared.
    shared = join_groups(segments, anchors, ["anchor"], "kinds", "inner")
    whole = F.array(F.struct(F.lit(0).alias("a"), size.cast("int").alias("b"))).cast(_RUNS)
    copies = shared.filter("kinds = 1").select("anchor", "segment", "n", whole.alias("runs"))
    mixed = stored(
        shared.filter("kinds > 1").select(
            "anchor", "segment", "n", "bytes",
            F.col("sample.doc").alias("s_doc"), F.col("sample.print").alias("s_print"),
            F.col("sample.first").alias("s_first"), F.col("sample.n_starts").alias("n_starts"),
        ),
        "mixed",
    )
    same = F.col("doc").eqNullSafe(F.col("s_doc")) & (F.col("print") == F.col("s_print"))
    wanted = F.struct("anchor", "segment", "n", "bytes", "s_first", "n_starts")
    by_doc = mixed.groupBy("s_doc", "s_print").agg(F.collect_list(wanted).alias("wanted"))
    cut = F.expr(f"substring(cast(text AS binary), w.s_first + 1, w.n_starts + {LENGTH - 1})")
    bytes_of = (
        split_by_keys(source, "print", mixed.select(F.col("s_print").alias("print")))[0]
        .join(by_doc, same)
        .select("text", F.explode("wanted").alias("w"))
        .select("w.anchor", "w.segment", "w.n", "w.n_starts", F.col("w.bytes").alias("group_bytes"), cut.alias("bytes"))
        .dropDuplicates(["anchor", "segment"])
    )
    bytes_of = stored(bytes_of, "bytes")
    resolved = _resolve(bytes_of.filter(F.col("group_bytes") <= GROUP_BYTES))
    large = _resolve_large(bytes_of.filter(F.col("group_bytes") > GROUP_BYTES))
    runs = stored(copies.unionByName(resolved).unionByName(large), "runs")

    found = join_groups(occurrences.select("doc", "print", "anchor", "segment", "first"), runs, ["anchor", "segment"], "n", "inner")
    # Rows of one key and text have the same runs: one of each is enough.
    runs_of = found.groupBy("doc", "print", "first").agg(F.first("runs").alias("runs"))
    spans = runs_of.groupBy(F.col("doc").alias("s_doc"), F.col("print").alias("s_print")).agg(
        F.collect_list(F.struct("first", "runs")).alias("runs")
    )
    spans = stored(spans, "spans")
    possible, whole_texts = split_by_keys(source, "print", spans.select(F.col("s_print").alias("print")))
    none = F.lit(None).cast(spans.schema["runs"].dataType)
    rows = possible.join(spans, same, "left").select("doc", "text", "runs")
    return _cut(rows.unionByName(whole_texts.select("doc", "text", none.alias("runs"))), key)


def _cut(rows: DataFrame, key: str) -> DataFrame:
    """Unites each document's runs and takes them out."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for text, runs in zip(batch.column(1), batch.column(2)):
                data = (text.as_py() or "").encode()
                pieces = sorted((r["first"] + x["a"], r["first"] + x["b"]) for r in runs.as_py() or () for x in r["runs"])
                united: list[list[int]] = []
                for a, b in pieces:
                    if united and a <= united[-1][1]:
                        united[-1][1] = max(united[-1][1], b)
                    else:
                        united.append([a, b])
                bounds = [0, *(x for span in united for x in span), len(data)]
                sizes.append(len(data))
                spans.append([{"start": a, "stop": b} for a, b in united])
                kept.append(b"".join(data[a:b] for a, b in zip(bounds[::2], bounds[1::2])))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                ["doc", "n_bytes", "spans", "kept"],
            )

    kind = rows.schema["doc"].dataType.simpleString()
    out = rows.mapInArrow(cut, f"doc {kind}, n_bytes long, spans array<struct<start:bigint,stop:bigint>>, kept binary")
    return out.withColumnRenamed("doc", key)
