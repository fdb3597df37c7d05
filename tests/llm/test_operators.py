"""The operators on small tables: nulls, empty texts, repeated rows, clashing columns, empty tables; against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as registered
import compare
import corpus_pipeline
from segflow.llm import queries, rank_bpe
from segflow.llm.chat import format_chats
from segflow.llm.components import connected_components
from segflow.llm.containment import contaminated, decontaminate
from segflow.llm.exact_dedup import exact_dedup, exact_groups
from segflow.llm.near_duplicates import keep_one, near_classes
from segflow.llm.rank_bpe import decode_documents, encode_and_decode, encode_documents
from segflow.llm.repeats import LENGTH, remove_repeats
from segflow.llm.sharding import shuffled_shards
from segflow.llm.site_style_tree import main_text
from segflow.llm.tables import join_groups, split_by_keys, totals_before
from segflow.llm.token_files import read_tokens, write_tokens
from segflow.llm.toxicity import fit_toxicity, keep_clean, score_toxicity
from segflow.scratch import new_scratch_dir

SF = "/root/testdata/sf0.001"
WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
CLASHING = "doc_id long, text string, key string, print string, row long, set string, runs string, value string, n long"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def near_copy(rng, text, changes=1):
    parts = text.split(" ")
    for _ in range(changes):
        parts[rng.randrange(len(parts))] = "changed" + str(rng.randrange(1000))
    return " ".join(parts)


def corpus():
    """Rows (doc_id, text) with copies, near copies, nulls, empty and long texts, repeated and null keys."""
    rng = random.Random(11)
    base, other, long = words(rng, 120), words(rng, 90), words(rng, 6000)
    texts = [base, base.replace(" ", "  ", 5), base, other, near_copy(rng, other), near_copy(rng, other), None, "", " \t\n ", "one two"]
    texts += ["one two", long, long + " tail", words(rng, 200) + " " + other + " " + words(rng, 200), "é中😀 " * 200, "a" * 900]
    texts += [near_copy(rng, base, 1) for _ in range(12)] + [words(rng, rng.randint(1, 150)) for _ in range(20)]
    rows = list(enumerate(texts))
    return [*rows, rows[0], rows[4], (None, base), (None, None), (None, "only this one is without a key here")]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(k, t, "x", None, 1, "y", None, "z", None) for k, t in corpus()]
    return spark.createDataFrame(rows, CLASHING).repartition(5)


@pytest.fixture(scope="module")
def nothing(documents):
    return documents.filter("doc_id < -1")


def shingle_set(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def plain(rows):
    return Counter(tuple(r) for r in rows.collect())


def test_queries_are_registered():
    assert {int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES} == set(range(1, 14))
    assert set(registered.queries()) >= {*queries.QUERIES, "pipeline"} and set(queries.ORACLES) <= set(queries.QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "toxicity" and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert compare.compare(spark, compare.connect(SF), name, SF) is None


def test_exact_groups(documents, nothing):
    texts = [(k, re.sub(r"[ \t-\r]+", " ", t or "")) for k, t in corpus()]
    sizes = Counter(t for _, t in texts)
    least = {t: min((k for k, x in texts if x == t and k is not None), default=None) for _, t in texts}
    found = exact_groups(documents).collect()
    assert Counter((r[0], r[1], r[2], r[4]) for r in found) == Counter(
        (k, least[t], sizes[t], hashlib.sha256(t.encode()).hexdigest()) for k, t in texts
    )
    assert Counter(r["text_sha256"] for r in found if r["kept"]) == Counter({hashlib.sha256(t.encode()).hexdigest(): 1 for t in sizes})
    kept = exact_dedup(documents)
    assert kept.columns == documents.columns
    assert Counter((r["doc_id"], re.sub(r"[ \t-\r]+", " ", r["text"] or "")) for r in kept.collect()) == Counter((k, t) for t, k in least.items())
    assert exact_groups(nothing).count() == 0 and exact_dedup(nothing).count() == 0


def test_near_classes(spark, documents, nothing):
    rows = [(k, shingle_set(t)) for k, t in corpus()]
    n = len(rows)
    linked = [[i != j and bool(rows[i][1]) and len(rows[i][1] & rows[j][1]) >= 0.8 * len(rows[i][1] | rows[j][1]) for j in range(n)] for i in range(n)]
    names = list(range(n))
    for _ in range(n):
        names = [min([names[i], *(names[j] for j in range(n) if linked[i][j])]) for i in range(n)]
    least = {c: min((rows[i][0] for i in range(n) if names[i] == c and rows[i][0] is not None), default=None) for c in names}
    wanted = Counter((rows[i][0], least[names[i]] if sum(linked[i]) else rows[i][0], sum(linked[i])) for i in range(n))
    found = near_classes(documents).select("doc_id", "class_id", "n_links")
    assert plain(found) == wanted and max(r[2] for r in wanted) > 10
    kept = keep_one(documents)
    assert kept.columns == documents.columns
    alone = Counter(rows[i][0] for i in range(n) if not sum(linked[i]))
    assert Counter(r["doc_id"] for r in kept.select("doc_id").collect()) == alone + Counter(
        least[c] for c in {names[i] for i in range(n) if sum(linked[i])}
    )
    assert near_classes(nothing).count() == 0 and keep_one(nothing).count() == 0


def test_large_group_of_near_copies_is_counted_in_blocks(spark, monkeypatch):
    from segflow.llm import near_duplicates

    monkeypatch.setattr(near_duplicates, "BLOCK_SETS", 7)
    rng = random.Random(2)
    base = words(rng, 200)
    texts = [near_copy(rng, base) for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingle_set(t) for t in texts]
    wanted = {i: sum(i != j and len(a & b) >= 0.8 * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)}
    assert {r["doc_id"]: r["n_links"] for r in near_classes(rows).collect()} == wanted


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(500, i) for i in range(501, 560)] + [(i, i + 1) for i in range(600, 640)]
    found = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {v: v for e in edges if e[0] != e[1] for v in e}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert found == root


def test_contamination(spark, documents, nothing):
    rng = random.Random(11)
    items = [(1, corpus()[3][1]), (2, words(rng, 7)), (2, corpus()[16][1]), (3, None), (4, ""), (5, "one two"), (None, corpus()[11][1]), (1, corpus()[3][1])]
    table = spark.createDataFrame([(k, t, "c") for k, t in items], "item_id long, text string, doc_id string")
    wanted = set()
    for k, t in corpus():
        for i, x in items:
            a, b = shingle_set(x), shingle_set(t)
            if a and len(a & b) / len(a) >= 0.8:
                wanted.add((k, i, len(a & b), len(a & b) / len(a)))
    found = [tuple(r) for r in contaminated(documents, table).collect()]
    assert set(found) == wanted and len(wanted) > 5
    hit = {k for k, *_ in wanted}
    clean = decontaminate(documents, table)
    assert clean.columns == documents.columns
    expected = Counter((k, t) for k, t in corpus() if not any(shingle_set(x) and len(shingle_set(x) & shingle_set(t)) >= 0.8 * len(shingle_set(x)) for _, x in items))
    assert Counter((r["doc_id"], r["text"]) for r in clean.collect()) == expected and hit
    assert contaminated(nothing, table).count() == 0 and contaminated(documents, table.filter("item_id > 9")).count() == 0
    assert decontaminate(documents, table.filter("item_id > 9")).count() == documents.count()


def test_bpe(documents, nothing):
    library = Tokenizer.from_file(WORD_BPE)
    rows = decode_documents(encode_documents(documents, WORD_BPE), WORD_BPE).collect()
    wanted = Counter()
    for k, t in corpus():
        ids = library.encode(t or "", add_special_tokens=False).ids
        wanted[k, np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in rows) == wanted
    together = encode_and_decode(documents, WORD_BPE).collect()
    assert Counter((r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in together) == wanted
    assert encode_documents(nothing, WORD_BPE).count() == encode_and_decode(nothing, WORD_BPE).count() == 0


def test_bpe_remembers_a_bounded_number_of_words(spark):
    rng = random.Random(9)
    texts = ["".join(f"{rng.getrandbits(40):x} " for _ in range(25_000)) for _ in range(4)]
    encoder = rank_bpe.WordBpe(corpus_pipeline.WORD_BPE)
    expected = Tokenizer.from_file(corpus_pipeline.WORD_BPE)
    for text in texts:
        (ids,) = encoder.encode([text])
        assert ids.tolist() == expected.encode(text, add_special_tokens=False).ids
    assert len(encoder.known) < 110_000


def test_token_files(spark, documents, nothing):
    library = Tokenizer.from_file(BYTE_BPE)
    out = new_scratch_dir(spark, "test-tokens")
    write_tokens(documents, BYTE_BPE, out)
    found = sorted(read_tokens(spark, out).collect(), key=lambda r: r["start"])
    coded = {t: np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for _, t in corpus()}
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in found) == Counter((k, coded[t]) for k, t in corpus())
    keys = [r["doc_id"] for r in found]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    starts = np.cumsum([0, *(len(r["ids"]) // 4 for r in found)])[:-1]
    assert [r["start"] for r in found] == starts.tolist()
    empty = new_scratch_dir(spark, "test-tokens")
    write_tokens(nothing, BYTE_BPE, empty)
    assert read_tokens(spark, empty).count() == 0


@pytest.mark.parametrize("rows_each", [500_000, 9])
def test_shards(spark, documents, nothing, monkeypatch, rows_each):
    from segflow.llm import sharding

    monkeypatch.setattr(sharding, "PART_ROWS", rows_each)
    found = shuffled_shards(documents, 5).collect()
    sizes = {t: (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in corpus()}
    assert Counter(r[:3] for r in map(tuple, found)) == Counter((k, *sizes[t]) for k, t in corpus())
    counts = Counter(r["shard"] for r in found)
    assert set(counts) == set(range(5)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(5):
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(counts[s]))
    again = shuffled_shards(documents, 5)
    assert plain(again) == Counter(map(tuple, found))
    assert shuffled_shards(nothing, 5).count() == 0


def removed(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append((len(d), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), bytes(b for b, g in zip(d, gone) if not g)))
    return out


@pytest.mark.parametrize("group_bytes", [1 << 23, 0])
def test_repeats(documents, nothing, monkeypatch, group_bytes):
    from segflow.llm import repeats

    monkeypatch.setattr(repeats, "GROUP_BYTES", group_bytes)
    wanted = Counter((k, *r) for (k, _), r in zip(corpus(), removed([t for _, t in corpus()], LENGTH)))
    found = remove_repeats(documents).collect()
    mine = Counter((r["doc_id"], r["n_bytes"], sum(s["stop"] - s["start"] for s in r["spans"]), len(r["spans"]), bytes(r["kept"])) for r in found)
    assert mine == wanted and any(r[2] for r in wanted)
    assert remove_repeats(nothing).count() == 0


def test_main_text(spark):
    menu = "<div class='top'><span>Home</span> <span>About us</span></div>"
    rows = [(i, "http://h/x", f"<body>{menu}<div class='c'><p>Text of page number {i}.</p><p>More {i * 7}</p></div></body>") for i in range(20)]
    rows += [(100, None, None), (101, "http://h/y", ""), (102, "http://h/z", menu), (3, "http://h/x", rows[3][2])]
    rows += [(200 + i, "http://same/", "<article><p>Copied article</p></article>") for i in range(9)]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, path string")
    found = {r["page_id"]: (r["text"], r["n_chars"]) for r in main_text(pages).collect()}
    assert main_text(pages).count() == len(rows) and main_text(pages.filter("page_id < 0")).count() == 0
    for i in range(20):
        text = f"Text of page number {i}.\nMore {i * 7}"
        assert found[i] == (text, len(text))
    assert found[100] == ("", 0) and found[101] == ("", 0)
    assert found[102] == ("Home About us", 13)  # nothing but the menu: it stays
    assert all(found[200 + i][0] == "Copied article" for i in range(9))


def test_texts_of_pages_stay_where_they_were_parsed(spark):
    """Verdicts come to the pages; a page without any, among others of its block, is whole."""
    rows = [(i, "http://h/x", f"<div class='top'>Menu of all</div><div class='c'><p>Story {i * 31} of h</p></div>") for i in range(600)]
    rows += [(1000 + i, f"http://only{i}/", f"<div class='c'><p>Alone {i}</p></div>") for i in range(600)]
    pages = spark.createDataFrame([r for two in zip(rows[:600], rows[600:]) for r in two], "page_id long, url string, html string")
    texts = main_text(pages)
    plan = plan_of(texts)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1, plan
    found = {r["page_id"]: r["text"] for r in texts.collect()}
    assert found == {i: f"Story {i * 31} of h" for i in range(600)} | {1000 + i: f"Alone {i}" for i in range(600)}


def test_main_text_judges_blocks_in_articles(spark):
    notice = "Subscribe to our weekly letter."
    pages = [
        (i, "http://h/x", f"<body><article><h1>Title {words(rng, 3)}</h1>{''.join(f'<p>{words(rng, 9)}</p>' for _ in range(1 + i % 4))}<p>{notice}</p></article></body>")
        for rng in [random.Random(5)] for i in range(12)
    ]
    found = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i, _, html in pages:
        assert found[i] == "\n".join(t for t in re.findall(r"<(?:p|h1)>(.*?)</", html) if t != notice)


@pytest.mark.parametrize("wrap", [
    "<div class='content-sidebar-wrap'><article>{}</article></div>", "<div class='with-sidebar'>{}</div><p>That is all.</p>",
    "<body class='no-comments'><div class='page has-banner'><main>{}</main></div>", "<article class='post related'>{}</article>",
    "<form id='login'><div>{}</div></form><p>That is all.</p>",
])
def test_main_text_of_pages_in_named_wrappers(spark, wrap):
    rng = random.Random(6)
    texts = {i: words(rng, 30) for i in range(8)}
    rows = [(i, f"http://h{i % 2}/x", wrap.format(f"<p>{t}</p>") + "<div class='comments'><p>First!</p></div>") for i, t in texts.items()]
    found = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(t in found[i].split("\n") and "First!" not in found[i] for i, t in texts.items())


@pytest.mark.parametrize("story", ["<main><div>{}</div></main>", "<div class='story'>{}</div>"])
@pytest.mark.parametrize("hosts", [1, 8])
def test_main_text_beside_article_cards(spark, story, hosts):
    rng = random.Random(7)
    rows, wanted = [], {}
    for i in range(8):
        wanted[i] = words(rng, 40)
        cards = "".join(f"<article><h3>{words(rng, 3)}</h3></article>" for _ in range(3))
        rows.append((i, f"http://h{i % hosts}/x", "<body>" + story.format(f"<p>{wanted[i]}</p>") + cards))
    rows += [(10 + i, "http://lead/", f"<div class='lead'>Lead {words(rng, 4)}</div><article><p>{words(rng, 30)}</p></article>") for i in range(8)]
    found = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[i] == t for i, t in wanted.items())
    assert all(found[10 + i].startswith("Lead ") and found[10 + i].count("\n") == 1 for i in range(8))


@pytest.mark.parametrize("counter", ["", "<p>Read {} times</p>"])
def test_main_text_of_copied_articles(spark, counter):
    rng = random.Random(8)
    texts = [words(rng, 20), words(rng, 20)]
    rows = [(i, "http://h/x", f"<body><div class='c'>{texts[i % 2]}</div>{counter.format(i)}<div class='top'>Menu</div>") for i in range(10)]
    # Copies do not keep the menu of the host's other pages either.
    rows += [(100 + i, "http://k/x", f"<div class='top'>Menu</div><div class='c'><p>{t}</p></div>") for i, t in enumerate([texts[0]] * 5 + [words(rng, 20) for _ in range(9)])]
    found = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(texts[i % 2] in found[i] for i in range(10))
    assert all(found[100 + i] == re.search("<p>(.*)</p>", rows[10 + i][2])[1] for i in range(14))


def test_chats(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "user", "there"), (2, 0, "assistant", "first"), (3, 0, "Human", "q"), (3, 1, "gpt", "a"), (4, 0, None, None),
            (5, 0, "system", "s"), (5, 1, "user", "<|im_end|>"), (5, 2, "assistant", "a"), (5, 3, "system", "late"), (None, 0, "user", "no key"),
            (6, None, "assistant", "last"), (6, 1, "user", "u"), (7, 0, "user", "same"), (7, 0, "user", "same")]
    rows += [(9, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(400)]
    turns = spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, part string")
    found = format_chats(turns).collect()
    assert len(found) == len(rows)
    by_conv = {}
    for r in sorted(found, key=lambda r: (r["conv_id"] or -1, r["turn"] is None, r["turn"] or 0)):
        by_conv.setdefault(r["conv_id"], []).append(r)
    render = {k: "".join(r["piece"] for r in rs) for k, rs in by_conv.items()}
    message = "<|im_start|>{}\n{}<|im_end|>\n".format
    assert render[1] == message("user", "hi\n\nthere") + message("assistant", "")
    assert render[2] == message("user", "") + message("assistant", "first")
    assert render[3] == message("user", "q") + message("assistant", "a")
    assert render[5].startswith(message("system", "s") + message("user", "< |im_end|>"))
    assert render[6] == message("user", "u") + message("assistant", "last")
    assert render[9] == "".join(message(("user", "assistant")[i % 2], f"t{i}") for i in range(400))
    for text in render.values():
        roles = re.findall(r"<\|im_start\|>(\w+)", text)
        assert roles[-1] == "assistant" and all(a != b for a, b in zip(roles, roles[1:])) and "system" not in roles[1:]
    assert format_chats(turns.filter("turn > 999")).count() == 0


def test_toxicity(spark, nothing):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        bad = i % 5 == 0
        insert = rng.choice(["vilestuff", "vileword", "vilething"]) if bad else "fine"
        rows.append((i, words(rng, 40) + f" {insert} {insert}x " + words(rng, 40), rng.choice(["en", None])))
        if i < 300:
            labels.append((i, 1, int(bad)))
    labels += [(None, 1, 1), (5, None, None), (9999, 0, 1)]
    rows += [(1000, None, "en"), (1001, "", "de"), (1002, "clean " * 5000, "fr")]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, lang string, key string")
    truth = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = fit_toxicity(docs, truth)
    found = {r["doc_id"]: r["toxic"] for r in score_toxicity(docs, model).collect()}
    assert found == {k: k < 400 and k % 5 == 0 for k, *_ in rows}
    clean = keep_clean(docs, model)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {k for k, bad in found.items() if not bad}
    unlabelled = fit_toxicity(docs, truth.filter("toxic > 5"))
    assert score_toxicity(docs, unlabelled).filter("toxic").count() == 0
    assert score_toxicity(docs.filter("doc_id < 0"), model).count() == 0


def test_pipeline_against_single_steps(spark):
    """Each stage's decisions, checked on what the stage before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = new_scratch_dir(spark, "test-stage")
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        out.write.parquet(path)
        after = spark.read.parquet(path)
        before_ids = [r[0] for r in docs.select("doc_id").collect()]
        rows = after.select("doc_id", "text").collect()
        assert set(r[0] for r in rows) <= set(before_ids) and len(rows) == len(set(r[0] for r in rows))
        sets = [shingle_set(r[1]) for r in rows]
        if name == "exact dedup":
            texts = {re.sub(r"[ \t-\r]+", " ", r[0] or "") for r in docs.select("text").collect()}
            assert len(rows) == len(texts)
        if name == "n-gram Jaccard join":
            assert not any(len(a & b) >= 0.8 * len(a | b) for i, a in enumerate(sets) for b in sets[:i] if a and b)
        if name == "benchmark decontamination":
            items = [shingle_set(r[0]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
            before = [(r[0], shingle_set(r[1])) for r in docs.select("doc_id", "text").collect()]
            assert {r[0] for r in rows} == {k for k, s in before if not any(i and len(i & s) >= 0.8 * len(i) for i in items)}
        docs = after
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert tokens.count() == docs.count() and tokens.filter("n_tokens = 0").count() == 0


def test_hot_keys_join_and_totals(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    joined = join_groups(rows, groups, ["k"], "n", "inner")
    assert joined.count() == 20_000 and joined.filter("k = 0").agg(F.max("top")).first()[0] == 19_998
    possible, rest = split_by_keys(rows, "id", spark.range(7))
    assert possible.count() + rest.count() == 20_000 and rest.filter("id < 7").count() == 0
    parts = spark.range(9000).select(F.col("id").alias("p"), (F.col("id") % 3).alias("n"))
    found = totals_before(parts, "p", "n", "before", block=100).orderBy("p").collect()
    assert [r["before"] for r in found] == np.r_[0, np.cumsum(np.arange(9000) % 3)][:-1].tolist()
