"""Token files: each shard's ids are compressed by a Re-Pair grammar and can be read from any document on."""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from segflow.llm.rank_bpe import byte_symbols, chunks, ragged
from segflow.llm.tables import parts_for, stored, text_of, text_slices, totals_before

#: Ids of a shard, at least, unless its task has no more documents.
SHARD_IDS = 1_000_000
#: Rows of a range of keys, on average.
RANGE_ROWS = 8_000
#: Pairs that one round replaces, at most, and how often a pair must occur, in shards of any size.
ROUND_PAIRS, LEAST_COUNT = 8192, 8
#: Rounds that tell pairs apart by a hash of so many bits.
HASHED_ROUNDS, HASH_BITS = 2, 18
_MAGIC = b"RPG1"
_HEADER = struct.Struct("<4sIIIQQ")
#: Fixed value: what a text is cut into before the merges, as byte-level files of this kind have it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

class ByteBpe:
    """The ids of a byte-level BPE file of the tokenizers library, names of special tokens in a text included."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"] or merged != sorted(merged):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        code = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        ranks = {bytes(code[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        # Ids rise in the order of merges, so they serve as ranks.
        self.encoding = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and how many each has."""
        found = [self.encoding.encode_to_numpy(text, allowed_special="all") for text in texts]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.concatenate([np.zeros(0, np.uint32), *found]).astype(np.uint32), counts


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def _pairs(symbols: np.ndarray, at: np.ndarray, exact: bool, salt: int) -> tuple[np.ndarray, ...]:
    """Of the pairs of adjacent symbols at these positions: positions, pair numbers, the numbers' symbols and counts."""
    left, right = symbols[at], symbols[at + 1]
    if exact:
        pairs, place, counts = np.unique(left.astype(np.uint64) << np.uint64(32) | right, return_inverse=True, return_counts=True)
        return at, place, np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)]).astype(np.uint32), counts
    factors = [np.uint32(x | 1) for x in np.random.default_rng(salt).integers(1 << 20, 1 << 32, 2)]
    place = (left * factors[0] + right * factors[1]) >> np.uint32(32 - HASH_BITS)
    shown = np.zeros((2, 1 << HASH_BITS), np.uint32)
    shown[0, place], shown[1, place] = left, right
    same = (shown[0, place] == left) & (shown[1, place] == right)
    return at[same], place[same], shown, np.bincount(place[same], minlength=1 << HASH_BITS)


def re_pair(ids: np.ndarray, ends: np.ndarray, first_rule: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, which of them end a document, and the rules (left, right), numbered from first_rule.

    Each round replaces the most frequent pairs by new symbols, until no pair is frequent. After a
    round only pairs with one of its new symbols are counted, as all others have grown no more
    frequent; when none of these is left, all pairs are counted once more. The first rounds are
    large and tell pairs apart by a hash, which stands for the last pair that has it and hides others;
    later ones count every pair.
    Where occurrences overlap, every second one in such a run is replaced. No rule reaches across
    the end of a document.
    """
    symbols, last, rules, n_rounds = ids.astype(np.uint32), ends.copy(), [], 0
    fresh, complete = 0, False
    while len(symbols) > 1:
        exact = n_rounds >= HASHED_ROUNDS
        counted = ~last[:-1]
        if fresh:
            new = symbols >= fresh
            counted &= new[:-1] | new[1:]
        at, place, shown, counts = _pairs(symbols, np.flatnonzero(counted), exact, n_rounds)
        n_rounds += 1
        frequent = np.flatnonzero(counts >= LEAST_COUNT)
        chosen = frequent[np.argsort(-counts[frequent], kind="stable")][:ROUND_PAIRS]
        if not len(chosen):
            if exact and (complete or not fresh):
                break
            fresh, n_rounds = 0, max(n_rounds, HASHED_ROUNDS)
            continue
        # Every frequent pair is known from then on, unless there are more than a round takes.
        complete = exact and len(frequent) <= ROUND_PAIRS and (complete or not fresh)
        fresh = first_rule + len(rules)
        rule_of = np.full(len(counts), -1, np.int32)
        rule_of[chosen] = first_rule + len(rules) + np.arange(len(chosen))
        rule = rule_of[place]
        at, rule = at[rule >= 0], rule[rule >= 0]
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
        offset = np.arange(len(at)) - np.repeat(starts, np.diff(np.r_[starts, len(at)]))
        at, rule = at[offset % 2 == 0], rule[offset % 2 == 0]
        rules.extend(zip(shown[0, chosen].tolist(), shown[1, chosen].tolist()))
        symbols[at] = rule
        last[at] = last[at + 1]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, last = symbols[keep], last[keep]
    return symbols, last, np.array(rules, np.uint32).reshape(-1, 2)


def pack_shard(keys: np.ndarray, valid: np.ndarray, ids: np.ndarray, counts: np.ndarray, first_rule: int) -> bytes:
    """A shard's bytes: header, rules, expansion lengths, keys, symbols and ids of each document, symbols."""
    ends = np.zeros(len(ids), bool)
    ends[np.cumsum(counts) - 1] = True
    symbols, last, rules = re_pair(ids, ends, first_rule)
    lengths = np.ones(first_rule + len(rules), np.uint64)
    for i, (a, b) in enumerate(rules.tolist()):
        lengths[first_rule + i] = lengths[a] + lengths[b]
    symbol_counts = np.diff(np.r_[0, np.flatnonzero(last) + 1])
    return b"".join(
        (
            _HEADER.pack(_MAGIC, first_rule, len(rules), len(keys), len(symbols), len(ids)),
            rules.astype("<u4").tobytes(),
            lengths[first_rule:].astype("<u4").tobytes(),
            keys.astype("<i8").tobytes(),
            valid.astype("u1").tobytes(),
            symbol_counts.astype("<u4").tobytes(),
            counts.astype("<u4").tobytes(),
            symbols.astype("<u2" if first_rule + len(rules) <= 1 << 16 else "<u4").tobytes(),
        )
    )


class Shard:
    """A packed shard; documents are decoded on demand."""

    def __init__(self, data: bytes):
        magic, self.first_rule, n_rules, n_docs, n_symbols, self.n_ids = _HEADER.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a token shard")
        at = _HEADER.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        self.rules = take("<u4", 2 * n_rules).reshape(-1, 2)
        self.rule_lengths = take("<u4", n_rules)
        self.keys, self.valid = take("<i8", n_docs), take("u1", n_docs).astype(bool)
        self.symbol_starts = np.r_[0, np.cumsum(take("<u4", n_docs), dtype=np.int64)]
        self.id_starts = np.r_[0, np.cumsum(take("<u4", n_docs), dtype=np.int64)]
        self.symbols = take("<u2" if self.first_rule + n_rules <= 1 << 16 else "<u4", n_symbols)
        lengths = np.r_[np.ones(self.first_rule, np.int64), self.rule_lengths.astype(np.int64)]
        starts = np.cumsum(lengths) - lengths
        flat = np.zeros(int(lengths.sum()), np.uint32)
        flat[: self.first_rule] = np.arange(self.first_rule)
        for i, (a, b) in enumerate(self.rules.tolist()):
            s = starts[self.first_rule + i]
            flat[s : s + lengths[a]] = flat[starts[a] : starts[a] + lengths[a]]
            flat[s + lengths[a] : s + lengths[a] + lengths[b]] = flat[starts[b] : starts[b] + lengths[b]]
        self.lengths, self.starts, self.flat = lengths, starts, flat

    def ids(self, first: int, stop: int) -> np.ndarray:
        """The ids of documents first to stop - 1; no other document is decoded."""
        symbols = self.symbols[self.symbol_starts[first] : self.symbol_starts[stop]]
        return self.flat[ragged(self.starts[symbols], self.lengths[symbols])]


def write_tokens(documents: DataFrame, path: str, out: str, end_id: int = 2, key: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text, append end_id, and write shards in ascending key order to `out`.

    `out` becomes a Parquet table with a row for each shard: its number in order (range, part),
    how many documents and ids it has, and its packed bytes. Null keys come first; equal keys are
    ordered by text; null and empty texts have the end id alone. Keys are integers. An empty table
    gives no shards.
    """
    first_rule = Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, place = byte_bpe(path), 0, TaskContext.get().partitionId()
        held: list[tuple[np.ndarray, ...]] = []
        n_held = 0

        def flush() -> pa.RecordBatch:
            nonlocal part, held, n_held
            keys, valid, ids, counts = (np.concatenate(x) for x in zip(*held))
            data = pack_shard(keys, valid, ids, counts, first_rule)
            row = [[place], [part], [len(keys)], [len(ids)], [data]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            part, held, n_held = part + 1, [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds)], ["range", "part", "n_docs", "n_ids", "data"]
            )

        for batch in text_slices(batches, 1):
            keys = batch.column(0)
            valid = np.array(keys.is_valid())
            numbers = keys.fill_null(0).to_numpy(zero_copy_only=False)
            done = 0
            for texts in chunks(batch.column(1)):
                ids, counts = bpe.encode(texts)
                ended = np.insert(ids, np.cumsum(counts), end_id)
                span = slice(done, done + len(texts))
                held.append((numbers[span], valid[span], ended, counts + 1))
                done, n_held = done + len(texts), n_held + len(ended)
                if n_held >= SHARD_IDS:
                    yield flush()
        if held:
            yield flush()

    source = documents.select(F.col(key).cast("long").alias("key"), text_of(text).alias("text"))
    ranges = max(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), parts_for(documents.count(), RANGE_ROWS))
    # A key held by many rows is split by its texts' hashes, equal rows by their place in the table.
    marks = {"mark": F.xxhash64("text"), "place": F.monotonically_increasing_id()}
    ordered = source.withColumns(marks).repartitionByRange(ranges, F.asc_nulls_first("key"), "mark", "place")
    ordered = ordered.sortWithinPartitions(F.asc_nulls_first("key"), "mark", "text").select("key", "text")
    ordered.mapInArrow(pack, "range int, part int, n_docs long, n_ids long, data binary").write.parquet(out)


def read_tokens(spark: SparkSession, out: str, key: str = "doc_id") -> DataFrame:
    """From written shards, per document: key, start (ids before it in the whole order), ids as little-endian 32-bit."""
    shards = spark.read.parquet(out)
    names = stored(shards.select("range", "part", "n_ids"), "shards")
    ranges = names.groupBy("range").agg(F.sum("n_ids").alias("n"))
    before = totals_before(ranges, "range", "n", "range_start")
    inside = totals_before_within(names)
    starts = stored(
        inside.join(before.select("range", "range_start"), "range").select(
            "range", "part", (F.col("range_start") + F.col("inside")).alias("shard_start")
        ),
        "starts",
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.column(2)[i].as_py())
                n, step = len(shard.keys), 256
                for a in range(0, n, step):
                    b = min(n, a + step)
                    whole = shard.ids(a, b).astype("<u4")
                    cut = shard.id_starts[a : b + 1] - shard.id_starts[a]
                    ids = [whole[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(b - a, batch.column(0)[i].as_py()), pa.int32()),
                            pa.array(np.full(b - a, batch.column(1)[i].as_py()), pa.int32()),
                            pa.array(shard.keys[a:b], pa.int64(), mask=~shard.valid[a:b]),
                            pa.array(shard.id_starts[a:b], pa.int64()),
                            pa.array(ids, pa.binary()),
                        ],
                        ["range", "part", "key", "offset", "ids"],
                    )

    rows = shards.select("range", "part", "data").mapInArrow(decode, "range int, part int, key long, offset long, ids binary")
    return rows.join(starts, ["range", "part"]).select(
        F.col("key").alias(key), (F.col("shard_start") + F.col("offset")).alias("start"), "ids"
    )


def totals_before_within(shards: DataFrame) -> DataFrame:
    """For each shard the ids of earlier shards of its range."""
    earlier = Window.partitionBy("range").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("inside", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))
