"""Alignment of two tokenizers' tokens over the same bytes."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.llm.rank_bpe import byte_symbols
from segflow.llm.tables import stored

#: Characters of documents whose id pairs are numbered together, and whose tokens are aligned together. No text is cut.
CHUNK_CHARS = 16_000_000
BATCH_CHARS = 400_000
#: Columns of a document's row in the first step.
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class TokenizerPair:
    """Byte-level BPE (A) and a piece vocabulary with byte fallback (B), with the bytes of each of their tokens."""

    def __init__(self, byte_path: str, piece_path: str, pattern: str):
        with open(byte_path, encoding="utf-8") as file:
            spec = json.load(file)
        code = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        ranks = {bytes(code[c] for c in token): i for token, i in self._plain(spec).items()}
        self.bpe = tiktoken.Encoding("A", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_a: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.bytes_b = [self._piece_bytes(i) for i in range(self.pieces.get_piece_size())]
        self.lengths_a = np.fromiter(map(len, self.bytes_a), np.int64, len(self.bytes_a))
        self.lengths_b = np.fromiter(map(len, self.bytes_b), np.int64, len(self.bytes_b))
        self.digits_a = self._digits(len(self.bytes_a), "|")
        self.digits_b = self._digits(len(self.bytes_b), ";")

    @staticmethod
    def _plain(spec: dict) -> dict[str, int]:
        """Tokens without the special ones, whose names in a text are plain text. Ids must rise in the order of merges, as ranks do."""
        model, special = spec["model"], {t["id"] for t in spec["added_tokens"]}
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"] or merged != sorted(merged):
            raise ValueError("the first tokenizer is not a plain byte-level BPE vocabulary")
        return {token: i for token, i in model["vocab"].items() if i not in special}

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()

    @staticmethod
    def _digits(n: int, end: str) -> tuple[np.ndarray, np.ndarray]:
        """Decimal ids followed by a comma, and by the sign that ends a group."""
        return tuple(np.array([f"{i}{sign}" for i in range(n)], object) for sign in (",", end))

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """A and B ids of each text; none where the tokens do not spell out a blank and the text."""
        found = []
        for text, pieces in zip(texts, self.pieces.encode(texts, num_threads=1)):
            spaced = f" {text}"
            a, b = self.bpe.encode_ordinary(spaced), pieces
            raw = spaced.encode()
            if not text or b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
                a, b = [], []
            found.append((np.array(a, np.int64), np.array(b, np.int64)))
        return found


@lru_cache(maxsize=1)
def tokenizer_pair(byte_path: str, piece_path: str, pattern: str) -> TokenizerPair:
    """One pair per Python worker."""
    return TokenizerPair(byte_path, piece_path, pattern)


def overlaps(tokens_a: pd.DataFrame, tokens_b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all A and B tokens that share bytes, from `document`, `start` and `at` of both sides.

    Each token's start finds the other side's token that covers it, in both directions. Tokens
    that overlap hold one another's start on at least one side; those that start together are found
    twice and kept once.
    """
    a, b = tokens_a.rename(columns={"at": "a"}), tokens_b.rename(columns={"at": "b"})
    a["start_a"], b["start_b"] = a["start"], b["start"]
    of_a = pd.merge_asof(a, b, on="start", by="document")
    of_b = pd.merge_asof(b, a, on="start", by="document")
    of_b = of_b[of_b["start_a"] < of_b["start_b"]]
    return (
        np.concatenate([of_a["a"].to_numpy(np.int64), of_b["a"].to_numpy(np.int64)]),
        np.concatenate([of_a["b"].to_numpy(np.int64), of_b["b"].to_numpy(np.int64)]),
    )


class Aligned:
    """Tokens, groups and links of a batch of texts, laid end to end."""

    def __init__(self, pair: TokenizerPair, texts: list[str]):
        ids = pair.encode(texts)
        self.pair = pair
        self.n_a = np.array([len(a) for a, _ in ids], np.int64)
        self.n_b = np.array([len(b) for _, b in ids], np.int64)
        none = np.zeros(0, np.int64)
        self.a = np.concatenate([none, *(a for a, _ in ids)])
        self.b = np.concatenate([none, *(b for _, b in ids)])
        document = np.arange(len(texts))
        self.of_a, self.of_b = np.repeat(document, self.n_a), np.repeat(document, self.n_b)
        ends_a, ends_b = np.cumsum(pair.lengths_a[self.a]), np.cumsum(pair.lengths_b[self.b])
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        self.group_a, self.group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        # Both sides spell out the same bytes, so the texts' offsets agree and every text ends with a cut.
        self.n_groups = np.zeros(len(texts), np.int64)
        last = self.group_a[np.flatnonzero(np.r_[self.of_a[1:] != self.of_a[:-1], True][: len(self.a)])]
        self.n_groups[self.n_a > 0] = np.diff(np.r_[-1, last])
        left, right = overlaps(
            pd.DataFrame({"document": self.of_a, "start": ends_a - pair.lengths_a[self.a], "at": np.arange(len(self.a))}),
            pd.DataFrame({"document": self.of_b, "start": ends_b - pair.lengths_b[self.b], "at": np.arange(len(self.b))}),
        )
        order = np.argsort(self.of_a[left], kind="stable")
        self.links = self.a[left[order]] * len(pair.bytes_b) + self.b[right[order]]
        self.n_links = np.bincount(self.of_a[left], minlength=len(texts))

    def groups(self) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` of each text: the ids of a group, A before B, groups in order; '' without tokens."""
        before_b = np.searchsorted(self.group_b, self.group_a, "left")
        before_a = np.searchsorted(self.group_a, self.group_b, "right")
        out = np.empty(len(self.a) + len(self.b), object)
        for ids, group, place, (inner, end) in (
            (self.a, self.group_a, before_b, self.pair.digits_a),
            (self.b, self.group_b, before_a, self.pair.digits_b),
        ):
            ending = np.r_[group[1:] != group[:-1], True][: len(ids)]
            out[np.arange(len(ids)) + place] = np.where(ending, end[ids], inner[ids])
        ends = np.cumsum(self.n_a + self.n_b)
        return ["".join(out[a:b].tolist())[:-1] for a, b in zip(np.r_[0, ends[:-1]], ends)]


class _Chunk:
    """Documents whose links are numbered together."""

    def __init__(self, number: int):
        self.number = number
        self.chars = 0
        self.keys: list = []
        self.counts: list[np.ndarray] = []
        self.hashes: list[str] = []
        self.pairs: list[np.ndarray] = []
        self.numbers: list[np.ndarray] = []

    def add(self, pair: TokenizerPair, keys: list, texts: list[str]) -> None:
        aligned = Aligned(pair, texts)
        self.chars += sum(map(len, texts))
        self.keys += keys
        self.counts.append(np.stack([getattr(aligned, c) for c in _COUNTS]))
        self.hashes += [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in aligned.groups()]
        pairs, numbers = np.unique(aligned.links, return_inverse=True)
        self.pairs.append(pairs)
        self.numbers.append(numbers.astype(np.int32))

    def rows(self, key_type: pa.DataType) -> pa.RecordBatch:
        """A row for each document, and a last one with the chunk's pairs, their counts, and the links as pair numbers."""
        pairs = np.unique(np.concatenate(self.pairs))
        numbers = [np.searchsorted(pairs, p)[n].astype("<i4") for p, n in zip(self.pairs, self.numbers)]
        links = np.concatenate(numbers)
        times = np.bincount(links, minlength=len(pairs))
        n, counts = len(self.keys), np.concatenate(self.counts, axis=1)
        packed = pa.compress(links.tobytes(), codec="zstd", asbytes=True)
        columns = {
            "chunk": pa.array(np.full(n + 1, self.number)),
            "at": pa.array(np.r_[np.arange(n), -1].astype(np.int32)),
            "key": pa.array([*self.keys, None], key_type),
            **{c: pa.array(np.r_[counts[i], len(links) if c == "n_links" else 0]) for i, c in enumerate(_COUNTS)},
            "groups_sha256": pa.array([*self.hashes, None], pa.string()),
            "links": pa.array([None] * n + [packed], pa.binary()),
            "pairs": pa.array([None] * n + [pairs], pa.list_(pa.int64())),
            "times": pa.array([None] * n + [times], pa.list_(pa.int64())),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _aligned_chunks(documents: DataFrame, key: str, text: str, paths: tuple[str, str, str]) -> DataFrame:
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(*paths)
        number = TaskContext.get().partitionId() << 32
        chunk, keys, texts, chars = _Chunk(number), [], [], 0
        for batch in batches:
            for k, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                held = value.as_py() or ""
                keys.append(k)
                texts.append(held)
                chars += len(held) + 1
                if chars < BATCH_CHARS:
                    continue
                chunk.add(pair, keys, texts)
                keys, texts, chars = [], [], 0
                if chunk.chars >= CHUNK_CHARS:
                    yield chunk.rows(batch.schema.field(0).type)
                    number += 1
                    chunk = _Chunk(number)
        if texts:
            chunk.add(pair, keys, texts)
        if chunk.keys:
            yield chunk.rows(batch.schema.field(0).type)

    source = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = source.schema["key"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    schema = f"chunk long, at int, key {key_type}, {counts}, groups_sha256 string, links binary, pairs array<long>, times array<long>"
    return source.mapInArrow(align, schema)


def _with_counts(documents: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of a chunk with what their links' counts add up to."""
    documents = documents.sort_by("at")
    chunk, documents = documents.slice(0, 1), documents.slice(1)
    links = np.frombuffer(
        pa.decompress(chunk["links"][0].as_py(), decompressed_size=4 * chunk["n_links"][0].as_py(), codec="zstd", asbytes=True), "<i4"
    )
    number = pairs["number"].to_numpy()
    count, best = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
    count[number], best[number] = pairs["count"].to_numpy(), pairs["best"].to_numpy()
    ends = np.r_[0, np.cumsum(documents["n_links"].to_numpy())]
    columns = {c: documents[c] for c in ("key", *_COUNTS)}
    for name, values in (("n_best", best), ("count_sum", count)):
        totals = np.r_[0, np.cumsum(values[links])]
        columns[name] = pa.array(totals[ends[1:]] - totals[ends[:-1]])
    return pa.table({**columns, "groups_sha256": documents["groups_sha256"]})


def align_tokens(
    documents: DataFrame, byte_path: str, piece_path: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Key, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document.

    A encodes a blank and the text with the byte-level BPE file, B the text with the piece model,
    which adds the blank. Offsets at which tokens of both end cut the text into groups; tokens that
    share bytes are linked. An id pair's count is the number of links in all documents; `n_best`
    counts a document's links whose pair has the highest count of its B id, `count_sum` adds up the
    counts of its links.

    Texts are read once: a task numbers the distinct pairs of a chunk of documents, so that what is
    shuffled for counting is a row for each pair of a chunk instead of one for each link. A chunk's
    links come back together with the counts of its own pairs only. Null and empty texts, and texts
    that tokens do not spell out, have no tokens: zeros and an empty hash. Repeated and null keys
    keep a row each, an empty table gives none, other columns are not read. The paths must name the
    files on every executor.
    """
    chunks = stored(_aligned_chunks(documents, key, text, (byte_path, piece_path, pattern)), "aligned")
    width = sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()
    # Arrays side by side, so that a number, its pair and its times are one row.
    numbered = chunks.filter("at = -1").select("chunk", F.posexplode(F.arrays_zip("pairs", "times")).alias("number", "entry"))
    numbered = numbered.select("chunk", "number", F.col("entry.pairs").alias("pair"), F.col("entry.times").alias("times"))
    counts = numbered.groupBy("pair").agg(F.sum("times").alias("count")).withColumn("b", F.col("pair") % width)
    counts = stored(counts, "pair-counts")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    rated = counts.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).cast("long").alias("best"))
    known = numbered.select(F.col("chunk").alias("of"), "number", "pair").join(rated, "pair").select("of", "number", "count", "best")
    rows = chunks.drop("pairs", "times")
    key_type = documents.schema[key].dataType.simpleString()
    longs = ", ".join(f"{c} long" for c in (*_COUNTS, "n_best", "count_sum"))
    together = rows.groupBy("chunk").cogroup(known.groupBy("of"))
    return together.applyInArrow(_with_counts, f"key {key_type}, {longs}, groups_sha256 string").withColumnRenamed("key", key)
