"""A counting quotient filter over 64-bit fingerprints."""

from __future__ import annotations

import struct

import numpy as np

_HEADER = struct.Struct("<BBIII")


class CountingQuotientFilter:
    """Counts of fingerprints of `bits` bits, stored as runs of sorted remainders.

    The upper `quotient_bits` of a fingerprint are its quotient. Each quotient has one run: the
    distinct remainders that occur with it, in ascending order, each with its count. A bit for each
    quotient tells whether it has a run, a bit for each remainder whether its run ends there.
    Nothing is lost: the fingerprints and counts can be read back.
    """

    def __init__(self, bits: int, quotient_bits: int, occupied, run_ends, remainders, counts):
        self.bits, self.quotient_bits = bits, quotient_bits
        self.occupied, self.run_ends, self.remainders, self.counts = occupied, run_ends, remainders, counts

    @classmethod
    def of(cls, fingerprints: np.ndarray, bits: int, quotient_bits: int, counts: np.ndarray | None = None):
        """A filter of fingerprints (uint64, below 2**bits), each counted once or `counts` times."""
        order = np.argsort(fingerprints, kind="stable")
        ordered = fingerprints[order].astype(np.uint64)
        weights = np.ones(len(ordered), np.int64) if counts is None else counts[order]
        first = np.ones(len(ordered), bool)
        first[1:] = ordered[1:] != ordered[:-1]
        starts = np.flatnonzero(first)
        distinct = ordered[starts]
        summed = np.add.reduceat(weights, starts) if len(starts) else np.zeros(0, np.int64)
        shift = np.uint64(bits - quotient_bits)
        quotients = (distinct >> shift).astype(np.int64)
        remainders = distinct & np.uint64((1 << int(shift)) - 1)
        run_ends = np.ones(len(distinct), bool)
        run_ends[:-1] = quotients[1:] != quotients[:-1]
        occupied = np.zeros(1 << quotient_bits, bool)
        occupied[quotients] = True
        return cls(bits, quotient_bits, occupied, run_ends, remainders, summed)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """All fingerprints in ascending order, and their counts."""
        runs = np.cumsum(self.run_ends) - self.run_ends
        quotients = np.flatnonzero(self.occupied)[runs] if len(runs) else np.zeros(0, np.int64)
        shift = np.uint64(self.bits - self.quotient_bits)
        return (quotients.astype(np.uint64) << shift) | self.remainders, self.counts

    def count(self, fingerprint: int) -> int:
        """How often a fingerprint was added."""
        shift = self.bits - self.quotient_bits
        quotient, remainder = fingerprint >> shift, fingerprint & ((1 << shift) - 1)
        if not self.occupied[quotient]:
            return 0
        run = int(self.occupied[:quotient].sum())
        ends = np.flatnonzero(self.run_ends)
        start, stop = (int(ends[run - 1]) + 1 if run else 0), int(ends[run]) + 1
        at = start + int(np.searchsorted(self.remainders[start:stop], np.uint64(remainder)))
        return int(self.counts[at]) if at < stop and int(self.remainders[at]) == remainder else 0

    @classmethod
    def merged(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """One filter of what all filters hold; equal remainders of a quotient add their counts."""
        pairs = [f.items() for f in filters]
        return cls.of(
            np.concatenate([p[0] for p in pairs]),
            filters[0].bits,
            filters[0].quotient_bits,
            np.concatenate([p[1] for p in pairs]),
        )

    def to_bytes(self) -> bytes:
        """Bit vectors, then remainders in as few bytes as hold them, then the counts above one."""
        width = 4 if self.bits - self.quotient_bits <= 32 else 8
        more = np.flatnonzero(self.counts > 1)
        return b"".join(
            (
                _HEADER.pack(self.bits, self.quotient_bits, len(self.remainders), len(more), width),
                np.packbits(self.occupied).tobytes(),
                np.packbits(self.run_ends).tobytes(),
                self.remainders.astype(f"<u{width}").tobytes(),
                more.astype("<u4").tobytes(),
                self.counts[more].astype("<i8").tobytes(),
            )
        )

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        bits, quotient_bits, n, n_more, width = _HEADER.unpack_from(data)
        at = _HEADER.size

        def take(size: int) -> bytes:
            nonlocal at
            at += size
            return data[at - size : at]

        occupied = np.unpackbits(np.frombuffer(take(-(-(1 << quotient_bits) // 8)), np.uint8))[: 1 << quotient_bits]
        run_ends = np.unpackbits(np.frombuffer(take(-(-n // 8)), np.uint8))[:n]
        remainders = np.frombuffer(take(n * width), f"<u{width}").astype(np.uint64)
        more = np.frombuffer(take(4 * n_more), "<u4")
        counts = np.ones(n, np.int64)
        counts[more] = np.frombuffer(take(8 * n_more), "<i8")
        return cls(bits, quotient_bits, occupied.astype(bool), run_ends.astype(bool), remainders, counts)
