"""The parts that need no Spark, against brute force."""

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from segflow.llm.anchors import anchored, window_minima
from segflow.llm.chat import (
    END_COST,
    FOLLOWS,
    INSERT,
    LAST,
    MERGE,
    RELABEL,
    START,
    boundary_states,
    run_cost,
    run_states,
)
from segflow.llm.containment import ALL_SHINGLES, MISS, bins_for
from segflow.llm.linear_grouping import suffix_array
from segflow.llm.near_duplicates import Shingler, forest_depth, forest_edges, similar_pairs
from segflow.llm.quotient_filter import CountingQuotientFilter
from segflow.llm.rank_bpe import WordBpe
from segflow.llm.repeats import repeated_starts
from segflow.llm.sharding import _wide_draw, communication_matrix
from segflow.llm.site_style_tree import PageParser, host_of
from segflow.llm.token_files import ByteBpe, Shard, pack_shard
from segflow.llm.toxicity import FOLDS, Sparse, best_threshold, fit_chain

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = "aAbΣσß İıé \x1c\x85\t\n'sS1٣½中😀\0<-_.ǅﬁ 　"


def odd_texts(n, specials=("<|endoftext|>", "'re", "'LL", "  x")):
    rng = random.Random(1)
    texts = []
    for _ in range(n):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 30)))
        texts.append(text + rng.choice(specials) + text if rng.random() < 0.2 else text)
    return texts


def test_word_bpe_equals_the_library():
    mine, library = WordBpe(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    texts = [*odd_texts(2000), "a" * 3000, "ab" * 400 + "x", "the" * 100, "<|startoftext|>"]
    found = mine.encode(texts)
    for text, ids in zip(texts, found):
        wanted = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == wanted
        assert mine.decode(ids).decode() == library.decode(wanted, skip_special_tokens=False)


def test_byte_bpe_equals_the_library():
    mine, library = ByteBpe(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    texts = [*odd_texts(2000), "plain words here", " lead", "trail  "]
    ids, counts = mine.encode(texts)
    for text, part in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert part.tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("kind", ["random", "repeated", "unary", "empty documents"])
def test_re_pair_shards_are_read_back(kind):
    rng = np.random.default_rng(3)
    ids = {
        "random": rng.integers(0, 50, 20_000),
        "repeated": np.tile(rng.integers(0, 1000, 50), 400),
        "unary": np.full(20_000, 7),
        "empty documents": np.full(64, 2),
    }[kind].astype(np.uint32)
    counts = np.ones(64, np.int64) if kind == "empty documents" else np.full(200, 100)
    keys, valid = np.arange(len(counts)), np.arange(len(counts)) % 7 > 0
    data = pack_shard(keys, valid, ids, counts, 1000)
    shard = Shard(data)
    assert (shard.ids(0, len(counts)) == ids).all() and (shard.valid == valid).all()
    ends = np.r_[0, np.cumsum(counts)]
    for k in (0, 3, len(counts) - 1):
        assert (shard.ids(k, k + 1) == ids[ends[k] : ends[k + 1]]).all()
    if kind in ("repeated", "unary"):
        assert len(shard.symbols) < len(ids) / 4 and len(shard.rules)
    with pytest.raises(ValueError):
        Shard(b"x" * 64)


def test_quotient_filters_merge_without_loss():
    rng = np.random.default_rng(5)
    parts = [rng.integers(0, 300, n).astype(np.uint64) * np.uint64(1 << 50) for n in (0, 1, 500, 800)]
    filters = [CountingQuotientFilter.from_bytes(CountingQuotientFilter.of(p, 64, 6).to_bytes()) for p in parts]
    values, counts = CountingQuotientFilter.merged(filters).items()
    wanted = np.unique(np.concatenate(parts), return_counts=True)
    assert (values == wanted[0]).all() and (counts == wanted[1]).all()
    whole = CountingQuotientFilter.merged(filters)
    assert all(whole.count(int(v)) == c for v, c in zip(*wanted)) and whole.count(12345) == 0


def test_suffix_arrays():
    rng = random.Random(3)
    for _ in range(3000):
        s = [rng.randint(0, rng.choice([0, 1, 2, 4])) for _ in range(rng.randint(0, 14))] * rng.choice([1, 1, 1, 3])
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_window_minima_take_the_first():
    rng = np.random.default_rng(2)
    for _ in range(300):
        values, width = rng.integers(0, 4, rng.integers(1, 30)).astype(np.uint64), int(rng.integers(1, 8))
        wanted = [i + int(np.argmin(values[i : i + width])) for i in range(len(values) - width + 1)]
        assert window_minima(values, width).tolist() == wanted


def test_equal_strings_have_equal_anchors():
    rng = random.Random(9)
    shared = bytes(rng.randrange(97, 101) for _ in range(90))
    texts = [bytes(rng.randrange(97, 101) for _ in range(n)) + shared + bytes(rng.randrange(97, 101) for _ in range(9)) for n in (0, 17, 333)]
    seen = []
    for text in texts:
        anchors, place, first, last = anchored(text, 60, 20)
        assert first[0] == 0 and (first[1:] == last[:-1] + 1).all() and last[-1] == len(text) - 60
        at = text.index(shared)
        seen.append([(int(a), int(p) - s) for s in range(at, at + 31) for a, p, f, e in zip(anchors, place, first, last) if f <= s <= e])
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 31
    assert len(anchored(b"short", 60, 20)[0]) == 0


def test_repeated_starts_against_all_windows():
    rng = random.Random(4)
    for _ in range(60):
        base = bytes(rng.randrange(97, 97 + rng.choice([1, 2, 26])) for _ in range(300))
        segments = [base[rng.randrange(100) : 200 + rng.randrange(100)] + bytes([rng.randrange(97, 123)]) * 3 for _ in range(rng.randint(1, 6))]
        starts = [max(0, len(s) - 40 + 1) for s in segments]
        windows = [s[i : i + 40] for s, n in zip(segments, starts) for i in range(n)]
        wanted = [windows.count(w) > 1 for w in windows]
        assert np.concatenate(repeated_starts(segments, starts, 40)).tolist() == wanted


def test_similar_pairs_are_exact():
    rng = random.Random(6)
    sets = [np.unique(np.array([rng.randrange(12) for _ in range(rng.randint(1, 12))], np.uint64)) for _ in range(40)]
    left, right = similar_pairs(sets, 0.8)
    plain = [set(s.tolist()) for s in sets]
    wanted = {(i, j) for i in range(40) for j in range(i) if len(plain[i] & plain[j]) >= 0.8 * len(plain[i] | plain[j]) - 1e-9}
    assert {(max(p), min(p)) for p in zip(left.tolist(), right.tolist())} == wanted
    assert forest_edges(5, np.array([4, 3]), np.array([3, 1])).tolist() == [0, 1, 2, 1, 1]


def test_shingles_and_depth():
    s = Shingler()
    assert len(s.shingles("")) == 0 and len(s.shingles("one two")) == 1 and len(s.shingles("a b c d e f")) == 2
    assert (s.shingles("A, b; c d e!") == s.shingles("a b c d e")).all()
    assert len(set(s.shingles("a b").tolist()) & set(s.shingles("a b c").tolist())) == 0
    depth = forest_depth(24, 6, 0.8, 0.9999)
    assert 1 - (1 - 0.8**depth) ** 24 >= 0.9999 > 1 - (1 - 0.8 ** (depth + 1)) ** 24
    assert forest_depth(1, 6, 0.5, 0.9999) == 1


def test_bins_keep_the_chance_of_a_miss():
    for size_class in range(1, 20):
        for item in (1, 5, 30, 200):
            log = bins_for(size_class, item, 0.8)
            if log != ALL_SHINGLES:
                load = 2.0 ** (size_class - log)
                assert (1 - (1 - math.exp(-load)) / load) ** math.ceil(0.8 * item - 1e-9) <= MISS
    assert bins_for(10, 1, 0.8) == ALL_SHINGLES


def test_communication_matrix():
    rows, shards = [10, 0, 7, 3], [7, 7, 6]
    total = np.zeros((4, 3))
    for seed in range(2000):
        m = communication_matrix(rows, shards, seed)
        assert m.sum(axis=1).tolist() == rows and m.sum(axis=0).tolist() == shards and (m >= 0).all()
        total += m
    assert np.allclose(total / 2000, np.outer(rows, shards) / 20, atol=0.15)
    rng = np.random.default_rng(1)
    draws = [_wide_draw(rng, 2_000_000_000, 1_000_000_000, 900) for _ in range(2000)]
    assert abs(np.mean(draws) - 600) < 2 and abs(np.std(draws) - math.sqrt(200)) < 1


def least_cost(roles):
    """Dijkstra over (turns read, last role), one message or merge at a time."""
    best = {(0, START): 0.0}
    for i in range(len(roles) + 1):
        for _ in range(6):
            for (at, s), cost in list(best.items()):
                if at == i:
                    for r in FOLLOWS[s]:
                        best[i, r] = min(best.get((i, r), math.inf), cost + INSERT)
        if i < len(roles):
            for (at, s), cost in list(best.items()):
                if at == i:
                    for r in FOLLOWS[s]:
                        key = (i + 1, r)
                        best[key] = min(best.get(key, math.inf), cost + (RELABEL if r != roles[i] else 0))
                    if s != START:
                        key = (i + 1, s)
                        best[key] = min(best.get(key, math.inf), cost + MERGE + (RELABEL if s != roles[i] else 0))
    return best[len(roles), LAST]


def test_role_repair_is_cheapest_in_one_run_or_many():
    rng = random.Random(8)
    for _ in range(300):
        roles = np.array([rng.randrange(5) for _ in range(rng.randint(1, 9))])
        cost = run_cost(roles)[START] + END_COST
        assert cost.min() == least_cost(roles.tolist())
        cuts = sorted(rng.sample(range(1, len(roles)), rng.randint(0, len(roles) - 1)))
        runs = np.split(roles, cuts)
        leaving = boundary_states([run_cost(r) for r in runs])
        total = 0.0
        for run, entry, out in zip(runs, [START, *leaving], leaving):
            states = run_states(run, entry, out)
            assert states[-1] == out
            total += run_cost(run)[entry, out]
        assert total + END_COST[leaving[-1]] == cost.min()


def page(body):
    texts, _, marks, _ = PageParser().parse(body)
    return list(zip(texts, marks))


def test_pages():
    html = (
        "<!DOCTYPE html><html><head><title>T</title><script>var t='<p>no</p>'</script></head><body class='comments-on'>"
        "<header>H</header><nav><ul><li>m</ul></nav><div class='cookie-notice'>c</div><main><p>before</p>"
        "<article><header>Head</header><h1>T &amp; t</h1><p>one <b>bold</b>\n x<br>y<p>two<div class=Ad>ad</div>"
        "<span hidden>h</span><section id='comments'><p>reader</p></section>tail</article></main><form>f</form><footer>F"
    )
    assert page(html) == [
        ("before", "main"), ("Head", "article"), ("T & t", "article"), ("one bold x y", "article"), ("two", "article"), ("tail", "article")
    ]
    assert page("") == [] and page("plain &lt;text") == [("plain <text", "")]
    assert page("<p>a <unclosed") == [("a", "")] and page("x <!-- <p>no") == [("x", "")] and page("1 < 2") == [("1 < 2", "")]
    assert len(page("<div>" * 3000 + "deep")) == 1
    assert host_of("HTTP://A.b:80/x") == "a.b" and host_of(None) == "" and host_of("http://[") == ""


def test_chain_of_classifiers_uses_earlier_categories():
    rng = np.random.default_rng(0)
    n = 600
    features = rng.random((n, 4)) < 0.3
    first = features[:, 0] | features[:, 1]
    both = first & ~features[:, 2]
    rows, columns = np.nonzero(features)
    x = Sparse(rows, columns, np.ones(len(rows)), (n, 4))
    chain, held_out = fit_chain(x, np.column_stack([first, both]).astype(float), np.ones(n), np.arange(n) % FOLDS)
    assert ((held_out[:, 0] > 0.5) == first).mean() > 0.98
    assert chain[1].earlier[0] > 0 and all((link.weights >= 0).all() for link in chain)
    constant, _ = fit_chain(x, np.zeros((n, 1)), np.ones(n), np.arange(n) % FOLDS)
    assert constant[0].probability(np.zeros(3), np.zeros((3, 0))).max() < 1e-6
    labels = np.array([0, 0, 1, 1.0])
    assert 0.2 < best_threshold(np.array([0.1, 0.2, 0.8, 0.9]), labels, np.ones(4)) < 0.8
    assert best_threshold(np.zeros(0), np.zeros(0), np.zeros(0)) == 0.5


def test_crc_of_an_empty_document():
    ids, counts = ByteBpe(BYTE_BPE).encode([""])
    assert len(ids) == 0 and counts.tolist() == [0] and zlib.crc32(np.array([2], "<u4").tobytes()) > 0
