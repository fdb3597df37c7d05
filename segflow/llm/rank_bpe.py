"""Byte-pair encoding by contiguous rank arrays, and decoding."""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.llm.tables import release_memory, text_slices

#: No merge for a pair of parts.
_NONE = np.iinfo(np.int32).max
#: Words of more bytes are merged with a heap, whose time does not grow with the square of the length.
SHORT_WORD = 256
#: Distinct words whose ids a task remembers, and characters of text it encodes at a time: what they take, workers keep.
CACHED_WORDS, ENCODED_CHARS = 64_000, 250_000
#: Characters of text in a list of `chunks`.
CHUNK_CHARS = 1_000_000
#: The words of lower-case text of the first 256 characters, by the same rule as WordBpe.pattern.
_LATIN_WORDS = re.compile(
    r"[a-zªµºß-öø-ÿ]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9²³¹¼½¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+"
).findall


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves, the others are numbered from U+0100.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[i], starts[i]+1, ... (lengths[i] of them) for every i, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class WordBpe:
    """Encodes and decodes with a tokenizer file of the word-end kind: lower case, white space dropped.

    A word's parts are held side by side with the rank of each adjacent pair; the smallest rank is
    scanned for, its boundary deleted and the neighbouring ranks looked up again, until no pair has
    a rank. Words of the same number of parts go through this together as rows of one array.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        if model["type"] != "BPE" or not suffix or spec["decoder"] is not None:
            raise ValueError(f"{path} is not a BPE vocabulary with word ends")
        vocab = model["vocab"]
        self.size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + suffix] for s in symbols], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [""] * self.size
        for token, i in [*vocab.items(), *self.special.items()]:
            tokens[i] = token
        self.tokens = [f"{t} ".encode() for t in tokens]
        names = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.specials = regex.compile(f"({names})") if names else None
        self.pattern = regex.compile(
            r"\p{L}++|'s|'t|'re|'ve|'m|'ll|'d|\p{N}|[^\p{White_Space}\p{L}\p{N}]++", regex.V1
        )
        self._forget()

    def _forget(self) -> None:
        """Start the memory of words anew, with the special tokens in it."""
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int64)
        self.used = 0
        self.starts: list[int] = []
        self.lengths: list[int] = []
        for name, i in self.special.items():
            self._remember([f"\0{name}"], np.array([i]), np.array([1]))

    def _remember(self, words: Sequence[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        first = len(self.starts)
        self.known.update(zip(words, range(first, first + len(words))))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts.extend((self.used + np.cumsum(lengths) - lengths).tolist())
        self.lengths.extend(lengths.tolist())
        self.used += len(ids)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, _NONE for pairs that never merge."""
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], _NONE)

    def _merge_rows(self, parts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of words with equally many parts, a word per row: (row numbers, ids) for each final length."""
        rows, done = np.arange(len(parts)), []
        ranks = self._rank(parts[:, :-1], parts[:, 1:])
        while len(rows):
            n = parts.shape[1]
            if n == 1:
                done.append((rows, parts))
                break
            at = ranks.argmin(axis=1)
            best = np.take_along_axis(ranks, at[:, None], 1)[:, 0]
            going = best < _NONE
            if not going.all():
                done.append((rows[~going], parts[~going]))
                rows, parts, ranks, at, best = rows[going], parts[going], ranks[going], at[going], best[going]
                if not len(rows):
                    break
            every = np.arange(len(rows))
            parts[every, at] = self.merged[best]
            columns = np.arange(n - 1)[None, :]
            parts = np.take_along_axis(parts, columns + (columns > at[:, None]), 1)
            if n > 2:
                columns = np.arange(n - 2)[None, :]
                ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), 1)
                before = np.flatnonzero(at > 0)
                ranks[before, at[before] - 1] = self._rank(parts[before, at[before] - 1], parts[before, at[before]])
                after = np.flatnonzero(at < n - 2)
                ranks[after, at[after]] = self._rank(parts[after, at[after]], parts[after, at[after] + 1])
            else:
                ranks = np.zeros((len(rows), 0), np.int32)
        return done

    def _merge_long(self, parts: np.ndarray) -> np.ndarray:
        """Ids of one long word: the same merges in the same order, from a heap of (rank, place)."""
        ids, n = parts.tolist(), len(parts)
        following, preceding = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self._rank(parts[:-1], parts[1:]).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(ranks) if r < _NONE]
        heapq.heapify(heap)
        lookup = dict(zip(self.keys.tolist(), self.ranks.tolist()))

        def offer(i: int, j: int) -> None:
            rank = lookup.get(ids[i] * self.size + ids[j])
            if rank is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = following[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = int(self.merged[rank]), -1
            following[i] = following[j]
            if following[j] < n:
                preceding[following[j]] = i
                offer(i, following[j])
            if preceding[i] >= 0:
                offer(preceding[i], i)
        return np.array([x for x in ids if x >= 0], np.int64)

    def encode_words(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after another, and how many each has."""
        raw = [w.encode() for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        found: list[np.ndarray | None] = [None] * len(raw)
        for n in np.unique(lengths):
            group = np.flatnonzero(lengths == n)
            codes = np.frombuffer(b"".join([raw[i] for i in group]), np.uint8).reshape(len(group), n)
            parts = np.concatenate([self.inner[codes[:, :-1]], self.last[codes[:, -1:]]], axis=1)
            if n > SHORT_WORD:
                for i, row in zip(group, parts):
                    found[i] = self._merge_long(row)
            else:
                for rows, ids in self._merge_rows(parts):
                    for i, row in zip(group[rows].tolist(), ids):
                        found[i] = row
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return (np.concatenate(found) if found else np.zeros(0, np.int64)), counts

    def words(self, text: str) -> list[str]:
        """The words of a text; a special token is marked by a leading NUL, which no word begins with alone."""
        if self.specials is not None and "<|" in text:
            out = []
            for piece in self.specials.split(text):
                out.extend([f"\0{piece}"] if piece in self.special else self._plain_words(piece))
            return out
        return self._plain_words(text)

    def _plain_words(self, text: str) -> list[str]:
        if not text.isascii():
            # Lower case is taken character by character: a capital sigma never becomes a final one.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.pattern.findall(text)
        return _LATIN_WORDS(text)

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The ids of each text."""
        by_text = [self.words(t) for t in texts]
        if len(self.known) > CACHED_WORDS:
            self._forget()
        new = list(set().union(*by_text).difference(self.known))
        if new:
            self._remember(new, *self.encode_words(new))
        n_words = np.fromiter(map(len, by_text), np.int64, len(by_text))
        places: list[int] = []
        for ws in by_text:
            places.extend(map(self.known.__getitem__, ws))
        index = np.array(places, np.int64)
        starts, lengths = np.array(self.starts, np.int64)[index], np.array(self.lengths, np.int64)[index]
        ids = self.flat[ragged(starts, lengths)]
        ends = np.r_[0, np.cumsum(lengths)][np.r_[0, np.cumsum(n_words)]]
        return [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens of ids with a blank between them, in UTF-8."""
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))[:-1]


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """One encoder per Python worker and file."""
    bpe = WordBpe(path)
    release_memory()  # what reading the file took
    return bpe


def chunks(column: pa.ChunkedArray | pa.Array, size: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """The texts, null as empty, in lists of about `size` characters; no text is cut."""
    held, n = [], 0
    for value in column:
        text = value.as_py() or ""
        held.append(text)
        n += len(text)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def encode_documents(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and `ids`, the token ids of the whole text as little-endian unsigned 32-bit integers.

    Ids are those of the tokenizer file, special tokens in a text included. Null and empty texts
    have no ids; repeated keys and rows stay as they are; an empty table gives no rows. `path` must
    name the tokenizer file on every executor.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in text_slices(batches, 1):
            ids = [x.astype("<u4").tobytes() for texts in chunks(batch.column(1), ENCODED_CHARS) for x in bpe.encode(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["key", "ids"])

    source = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(encode, f"key {key_type}, ids binary").withColumnRenamed("key", key)


def decode_documents(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Key, ids and the text of the ids, which joins their tokens by blanks; null and empty ids give an empty text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in text_slices(batches, 1):
            texts = [bpe.decode(np.frombuffer(x.as_py() or b"", "<u4")) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.binary()).cast(pa.string())], ["key", "ids", "text"]
            )

    source = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    key_type = source.schema["key"].dataType.simpleString()
    decoded = source.mapInArrow(decode, f"key {key_type}, ids binary, text string")
    return decoded.select(F.col("key").alias(key), F.col("ids").alias(ids), F.col("text").alias(out))


def encode_and_decode(
    documents: DataFrame, path: str, key: str = "doc_id", text: str = "text", out: str = "decoded"
) -> DataFrame:
    """The rows of decode_documents(encode_documents(...)) from one pass, so a task has one Python worker and one vocabulary."""

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in text_slices(batches, 1):
            ids = [x.astype("<u4").tobytes() for texts in chunks(batch.column(1), ENCODED_CHARS) for x in bpe.encode(texts)]
            texts = [bpe.decode(np.frombuffer(x, "<u4")) for x in ids]
            columns = [batch.column(0), pa.array(ids, pa.binary()), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "ids", "text"])

    source = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = source.schema["key"].dataType.simpleString()
    coded = source.mapInArrow(both, f"key {key_type}, ids binary, text string")
    return coded.select(F.col("key").alias(key), "ids", F.col("text").alias(out))
