"""Fingerprint links, vector codes and token alignment on small tables, against brute force."""

import bisect
import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

from segflow.llm import token_alignment
from segflow.llm.queries import BYTE_BPE, PIECE_BPE
from segflow.llm.rank_bpe import byte_symbols
from segflow.llm.simhash import fingerprint_links, simhash_classes, text_fingerprint
from segflow.llm.token_alignment import align_tokens
from segflow.llm.vector_codes import EntryLists, fit_codebooks, vector_codes
from test_operators import CLASHING, corpus


def plain(rows):
    return Counter(tuple(r) for r in rows.collect())


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(k, t, "x", None, 1, "y", None, "z", None) for k, t in corpus()]
    return spark.createDataFrame(rows, CLASHING).repartition(5)


def roots_of(n, linked):
    """For each of n nodes the smallest number its links reach."""
    names = list(range(n))
    while True:
        new = [min([names[i], *(names[j] for j in linked(i))]) for i in range(n)]
        if new == names:
            return names
        names = new


# Fingerprints


def slow_fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_the_definition():
    rng = random.Random(2)
    texts = ["", " \n", "One", "one", "É É x", "a b c", "A b\tC\x0bd", "a b c d e f"]
    texts += [" ".join(rng.choice("abcde") for _ in range(n)) for n in (5, 400, 70_000)]
    assert [text_fingerprint(t) for t in texts] == [slow_fingerprint(t) for t in texts]
    assert text_fingerprint("One Two") == text_fingerprint("one two") != 0


def near_values(rng, n, flips):
    base = rng.getrandbits(64)
    return [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, flips))) for _ in range(n)]


def groups_of(values, linked):
    """The values split into what links join."""
    roots = roots_of(len(values), lambda i: linked[values[i]])
    groups = defaultdict(set)
    for v, r in zip(values, roots):
        groups[r].add(v)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("distance,compared", [(4, 8192), (4, 20), (1, 9)])
def test_links_join_what_lies_within_the_distance(spark, distance, compared):
    rng = random.Random(distance)
    values = [rng.getrandbits(64) for _ in range(40)] + [0, 2**64 - 1, 1, 0b11111, 0b111110000]
    for flips in (1, 2, 3, 4, 9):
        values += near_values(rng, 25, flips)
    # One segment with a single value in all of them, as a hot one has.
    values += [rng.getrandbits(40) << 24 | 0xABCDE for _ in range(60)]
    values = sorted(set(values))
    place = {v: i for i, v in enumerate(values)}
    near = {v: [place[w] for w in values if (v ^ w).bit_count() <= distance] for v in values}
    frame = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fingerprint long").repartition(3)
    found = [(r["a"] % 2**64, r["b"] % 2**64) for r in fingerprint_links(frame, distance, compared).collect()]
    assert all((a ^ b).bit_count() <= distance for a, b in found)
    linked = defaultdict(list)
    for a, b in found:
        linked[a].append(place[b])
        linked[b].append(place[a])
    assert groups_of(values, linked) == groups_of(values, near)


def test_simhash_classes(spark, documents):
    rows = [(k, text_fingerprint(t or "")) for k, t in corpus()]
    roots = roots_of(len(rows), lambda i: [j for j, (_, f) in enumerate(rows) if (f ^ rows[i][1]).bit_count() <= 4])
    least = {r: min((rows[i][0] for i in range(len(rows)) if roots[i] == r and rows[i][0] is not None), default=None) for r in roots}
    wanted = Counter((k, f"{f:016x}", least[r]) for (k, f), r in zip(rows, roots))
    assert plain(simhash_classes(documents)) == wanted and max(Counter(roots).values()) > 3
    assert simhash_classes(documents.filter("doc_id < -1")).count() == 0


# Vectors


def slow_codes(rows, parts=4, entries=256, rounds=4):
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0]))
    whole = [[math.floor(1024 * x) for x in r[1]] for r in kept]
    width = len(whole[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in whole]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for v in cut:
                held[nearest(p, v[p])[1]].append(v[p])
            for i, vs in held.items():
                books[p][i] = [sum(c) // len(vs) for c in zip(*vs)]
    found = [[nearest(p, v[p]) for p in range(parts)] for v in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for r, e in zip(kept, errors):
        by_label[r[2]] += e
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return Counter((r[0], "".join(f"{i:02x}" for _, i in f), e, by_label[r[2]], sha) for r, f, e in zip(kept, found, errors))


def vector_rows():
    rng = random.Random(5)
    rows = [(i, [rng.choice((-1.5, -0.25, 0.0, 0.1, 0.7)) * rng.choice((1, 1, 9)) for _ in range(8)], rng.choice((None, 1, 2))) for i in range(330)]
    rows[3] = (3, None, 1)
    rows[7] = (7, [*rows[7][1][:7], None], 1)
    rows[9] = (9, [*rows[9][1][:7], float("nan")], None)
    rows[11] = (11, [float("-inf"), *rows[11][1][1:]], 2)
    rows[13] = (13, [], 2)
    rows += [(400 + i, rows[0][1], None) for i in range(20)] + [(20, rows[20][1], rows[20][2]), (None, rows[21][1], 1)]
    return rows


def test_vector_codes(spark):
    rows = vector_rows()
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, code string, error long")
    rows = [(k, v and [None if x is None else float(np.float32(x)) for x in v], c) for k, v, c in rows]
    assert plain(vector_codes(frame.repartition(4))) == slow_codes(rows)
    few = [r for r in rows if r[0] is not None and r[0] < 5]
    assert plain(vector_codes(frame.filter("vec_id < 5"))) == slow_codes(few)
    nothing = vector_codes(frame.filter("vec_id = 3"))
    assert nothing.count() == 0 and nothing.columns == vector_codes(frame.filter("vec_id < 5")).columns
    with pytest.raises(ValueError, match="equal parts"):
        fit_codebooks(frame, parts=3)


def test_a_search_measures_few_entries_and_finds_the_lowest_of_the_nearest():
    rng = np.random.default_rng(1)
    for width, spread in ((1, 5), (2, 40), (16, 900)):
        book = rng.integers(-spread, spread, (256, width))
        values = rng.integers(-2 * spread, 2 * spread, (500, width))
        best, distance = EntryLists(book).nearest(values)
        every = ((values[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
        assert (best == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    alone = EntryLists(np.zeros((1, 3), np.int64)).nearest(np.ones((2, 3), np.int64))
    assert alone[0].tolist() == [0, 0] and alone[1].tolist() == [3, 3]


# Alignment


def slow_alignment(rows):
    first = Tokenizer.from_file(BYTE_BPE)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    code = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
    size = second.get_piece_size()
    pieces = [second.id_to_piece(i) for i in range(size)]
    bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    found, counts = [], Counter()
    for key, text in rows:
        text = text or ""
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        bytes_a = [bytes(code[c] for c in first.id_to_token(i)) for i in a]
        spelt = [bytes_b[i] for i in b]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(spelt) != (" " + text).encode():
            a, b, bytes_a, spelt = [], [], [], []
        spans_a, spans_b = [], []
        for tokens, spans in ((bytes_a, spans_a), (spelt, spans_b)):
            at = 0
            for t in tokens:
                spans.append((at, at + len(t)))
                at += len(t)
        links, j = [], 0
        for i, (start, end) in enumerate(spans_a):
            while j and spans_b[j - 1][1] > start:
                j -= 1
            while j < len(b) and spans_b[j][0] < end:
                if spans_b[j][1] > start:
                    links.append((a[i], b[j]))
                j += 1
        ends = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
        sides = [[[] for _ in ends] for _ in range(2)]
        for side, ids, spans in zip(sides, (a, b), (spans_a, spans_b)):
            for t, (_, e) in zip(ids, spans):
                side[bisect.bisect_left(ends, e)].append(str(t))
        groups = [",".join(x) + "|" + ",".join(y) for x, y in zip(*sides)]
        found.append((key, len(a), len(b), len(ends), links, ";".join(groups)))
        counts.update(links)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return Counter(
        (key, n_a, n_b, n, len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        for key, n_a, n_b, n, links, groups in found
    )


def test_alignment(spark, documents):
    assert plain(align_tokens(documents, BYTE_BPE, PIECE_BPE, public_tokenizers.PATTERN)) == slow_alignment(corpus())


def test_alignment_of_odd_texts(spark):
    texts = ["<|endoftext|> <s> </s> <unk>", "a▁b", "▁", "x\x00y", "　é中😀 é", " ", "\n\n", "<0x41>", "é" * 900, None, "", "don't 1234 ﬁ"]
    rows = [*enumerate(texts), (0, texts[0]), (None, "again")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = plain(align_tokens(frame.repartition(3), BYTE_BPE, PIECE_BPE, public_tokenizers.PATTERN))
    assert found == slow_alignment(rows)
    assert any(r[0] == 1 and r[1] == 0 for r in found) and any(r[0] == 0 and r[1] > 0 for r in found)
    assert align_tokens(frame.filter("doc_id < 0"), BYTE_BPE, PIECE_BPE, public_tokenizers.PATTERN).count() == 0


def test_pairs_of_several_chunks_add_up():
    pair = token_alignment.tokenizer_pair(BYTE_BPE, PIECE_BPE, public_tokenizers.PATTERN)
    rows = [(k, t or "") for k, t in corpus()]
    totals = []
    for n in (1, 3):
        pairs = Counter()
        for i in range(n):
            chunk = token_alignment._Chunk(i)
            for k, t in rows[i::n]:
                chunk.add(pair, [k], [t])
            last = chunk.rows(pa.int64()).to_pylist()[-1]
            pairs.update(dict(zip(last["pairs"], last["times"])))
        totals.append(pairs)
    assert totals[0] == totals[1] and sum(totals[0].values()) > 10_000
