"""Main text of web pages: a style tree merged from a host's pages tells common branches from content."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segflow.llm.tables import join_groups, split_by_keys, stored, stored_by

#: What an element's place and names say of it, before its host's pages do.
PLAIN, IN_MAIN, NAMED, IN_ARTICLE = 0, 1, 2, 3
#: Branches and texts of lower importance, by their prior, are removed, if the host shows them on so many pages at least.
IMPORTANCE, LEAST_PAGES = {PLAIN: 0.4, IN_MAIN: 0.2, NAMED: 0.8, IN_ARTICLE: 0.2}, 5
#: Branches outside articles stay beside an article if the tree finds them so important.
KEPT_IMPORTANCE = 0.8
#: How much the variety of layouts counts against content, for each layout more.
ATTENUATION = 0.9

#: A task numbers its pages with so many bits below its own number; pages that share all but the last few are a block.
PART_BITS, BLOCK_BITS = 33, 8

#: Element names of HTML by what they mean for the text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER_TEXT = frozenset(
    "head noscript template iframe svg math button select textarea object canvas audio video script style title".split()
)
NAMED_ELEMENTS = frozenset("nav footer aside form dialog menu".split())
#: Roles, and words in class names and ids, of parts that are not the article.
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NEVER_NAMES = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice "
    "notification pager pagination popup promo promoted promotion related replies reply respond share sharing sidebar "
    "signup social sponsor sponsored subscribe subscription toolbar widget".split()
)

_TOKENS = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|svg|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-z][^\s/>]*)([^>]*)>"
    r"|<[!?/a-z][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTES = re.compile(r"(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")
_OTHER = re.compile(r"[\W\d_]")


def _hash(text: str) -> int:
    value = xxhash.xxh64_intdigest(text)
    return value - (1 << 64) if value >> 63 else value


class PageParser:
    """Blocks of text of a page, each with the chain of its elements, and the layouts of its elements.

    An element is known by its own and its ancestors' names and classes, so that equal parts of a
    host's pages meet in one node of the style tree. The last two bits of its number tell its prior:
    PLAIN, IN_MAIN or IN_ARTICLE by its place, or NAMED as something else. Remembers how start
    tags are to be read.
    """

    def __init__(self):
        self.tags: dict[tuple[str, str], tuple[str, bool, bool, str]] = {}
        self.paths: dict[tuple[int, str], int] = {}

    def _tag(self, name: str, attributes: str) -> tuple[str, bool, bool, str]:
        """Label, whether the element is never shown as text, whether it is named as other than content, and landmark."""
        found = self.tags.get((name, attributes))
        if found is None:
            values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTES.finditer(attributes)}
            names = {x.lower() for x in _NAMES.findall(f"{values.get('class', '')} {values.get('id', '')}")}
            role = values.get("role", "").lower()
            style = values.get("style", "").replace(" ", "").lower()
            never = (
                name in NEVER_TEXT
                or "hidden" in values
                or values.get("aria-hidden", "").lower() == "true"
                or "display:none" in style
            )
            named = name in NAMED_ELEMENTS or role in NEVER_ROLES or bool(names & NEVER_NAMES) and name not in ("html", "body", "main")
            landmark = "article" if name == "article" or role == "article" else "main" if name == "main" or role == "main" else ""
            label = _DIGITS.sub("0", f"{name}.{' '.join(sorted(values.get('class', '').lower().split()))}")
            found = (label, never, named, landmark)
            if len(self.tags) > 50_000:
                self.tags = {}
            self.tags[name, attributes] = found
        return found

    def _path(self, parent: int, label: str) -> int:
        found = self.paths.get((parent, label))
        if found is None:
            if len(self.paths) > 50_000:
                self.paths = {}
            found = self.paths[parent, label] = _hash(f"{parent}/{label}")
        return found

    def parse(self, page: str) -> tuple[list[str], list[list[int]], list[str], list[tuple[int, int]]]:
        """Texts, chains and landmarks ("article", "main" or "") of blocks without a name, and (path, layout) of each element."""
        texts, chains, marks, named, _, layouts = self.read(page)
        plain = [i for i, x in enumerate(named) if not x]
        return [texts[i] for i in plain], [chains[i] for i in plain], [marks[i] for i in plain], layouts

    def read(self, page: str, root: int = 0):
        """Of all blocks the texts, chains, landmarks, the outermost branch that is named as other than content (or 0) and
        whether they are table cells; and (path, layout) of each element. Paths begin at `root`."""
        texts: list[str] = []
        holders: list[int] = []
        # Of each element: path, parent, named, landmark, layout, name
        paths, parents, names, marks, layouts, tags = [root], [-1], [False], [""], [None], [""]
        # name, element, never text, names of children
        stack: list[tuple[str, int, bool, list[str]]] = [("", 0, False, [])]
        # Text of the innermost block, and of the named inline elements open in it; later, of those closed in it.
        held: list[tuple[int, list[str]]] = [(0, [])]
        closed: list[tuple[int, list[str]]] = []

        def emit(element: int, pieces: list[str]) -> None:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                texts.append(text)
                holders.append(element)

        def flush() -> None:
            for element, pieces in held:
                if pieces:
                    emit(element or next(s[1] for s in reversed(stack) if s[0] not in INLINE), pieces)
            for element, pieces in closed:
                emit(element, pieces)
            closed.clear()

        def pop() -> None:
            _, element, never, children = stack.pop()
            if not never:
                layouts[element] = _hash(" ".join(children))
            if held[-1][0] and held[-1][0] == element:
                closed.append(held.pop())

        def close(name: str) -> None:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    if name not in INLINE or depth < len(stack) - 1:
                        flush()
                    while len(stack) > depth:
                        pop()
                    return

        at = 0
        for token in _TOKENS.finditer(page):
            start = token.start()
            if start > at and not stack[-1][2]:
                held[-1][1].append(page[at:start])
            at = token.end()
            name = token[3] or token[6]
            if name is None:
                continue
            name = name.lower()
            if token[2] or token[5]:
                if name == "p" and not any(s[0] == "p" for s in stack):
                    flush()
                elif name not in INLINE or any(s[0] == name for s in stack):
                    close(name)
                continue
            label, never, named, landmark = self._tag(name, token[4] or token[7] or "")
            if name in VOID:
                if name == "hr":
                    flush()
                elif name == "br" and not stack[-1][2]:
                    held[-1][1].append(" ")
                continue
            if name in INLINE and not never and not named:
                continue
            if name not in INLINE:
                flush()
                if stack[-1][0] == "p":
                    pop()
                if name == "li" and stack[-1][0] == "li":
                    pop()
                if name == "body" and stack[-1][0] == "head":
                    pop()
            above = stack[-1][1]
            inside = landmark or marks[above]
            if marks[above] == "article":
                inside = "article"
            never = never or stack[-1][2]
            stack[-1][3].append(name)
            element = len(paths)
            paths.append(self._path(paths[above], label))
            parents.append(above)
            names.append(named or name == "header" and not marks[above])
            marks.append(inside)
            layouts.append(None)
            tags.append(name)
            stack.append((name, element, never, []))
            if name in INLINE and named and not never:
                held.append((element, []))
        if at < len(page) and not stack[-1][2]:
            held[-1][1].append(page[at:])
        flush()
        while len(stack) > 1:
            pop()
        flush()
        # A name says nothing of an element that holds the greater part of the text in article and main elements.
        inside = [0] * len(paths)
        holds = [False] * len(paths)
        for element, text in zip(holders, texts):
            inside[element] += len(text) if marks[element] else 0
        for i in range(len(paths) - 1, 0, -1):
            holds[i] = holds[i] or bool(marks[i]) and marks[i] != marks[parents[i]]
            inside[parents[i]] += inside[i]
            holds[parents[i]] = holds[parents[i]] or holds[i]
        for i in range(1, len(paths)):
            names[i] = names[i] and not (holds[i] and 2 * inside[i] >= inside[0])
        numbers = [root]
        branches = [0]
        for i in range(1, len(paths)):
            names[i] = names[i] or names[parents[i]]
            prior = NAMED if names[i] else {"": PLAIN, "main": IN_MAIN, "article": IN_ARTICLE}[marks[i]]
            numbers.append(paths[i] & ~3 | prior)
            branches.append(branches[parents[i]] or (numbers[i] if names[i] else 0))
        chains = []
        for element in holders:
            chain = []
            while element > 0:
                if tags[element] not in ("html", "body"):
                    chain.append(numbers[element])
                element = parents[element]
            chains.append(chain[::-1])
        return (
            texts, chains, [marks[e] for e in holders], [branches[e] for e in holders],
            [tags[e] in ("td", "th") for e in holders],
            [(numbers[i], x) for i, x in enumerate(layouts) if x is not None and tags[i] not in ("html", "body")],
        )


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


_PARSED = (
    "row long, page_id {key}, url string, host long, texts array<string>, letters array<int>, features array<long>, "
    "owns array<long>, chains array<array<long>>, marks array<string>, named array<long>, paths array<long>, layouts array<long>"
)


def parsed_pages(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Each page with a row number, a hash of its host, its blocks and its elements' layouts.

    `features` stand for the blocks' texts, `owns` for the texts as parts of their innermost elements
    (0 for table cells, whose words recur by nature); like the paths they are a host's own.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, row = PageParser(), TaskContext.get().partitionId() << PART_BITS
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                urls = part.column(1).to_pylist()
                out: list[list] = [[] for _ in range(11)]
                for url, page in zip(urls, part.column(2)):
                    host = _hash(host_of(url))
                    texts, chains, marks, named, cells, layouts = parser.read(page.as_py() or "", host)
                    layouts = sorted(set(layouts))
                    features = [_hash(f"{host}/{t}") for t in texts]
                    owns = [0 if x or not c else _hash(f"{c[-1]}/{f}") for x, c, f in zip(cells, chains, features)]
                    letters = [len(t) - len(_OTHER.findall(t)) for t in texts]
                    values = (
                        row, host, texts, letters, features, owns, chains, marks, named,
                        [x for x, _ in layouts], [x for _, x in layouts],
                    )
                    for column, value in zip(out, values):
                        column.append(value)
                    row += 1
                longs, strings = pa.list_(pa.int64()), pa.list_(pa.string())
                kinds = [
                    pa.int64(), pa.int64(), strings, pa.list_(pa.int32()), longs, longs, pa.list_(longs), strings,
                    longs, longs, longs,
                ]
                arrays = [pa.array(v, k) for v, k in zip(out, kinds)]
                yield pa.RecordBatch.from_arrays(
                    [arrays[0], part.column(0), part.column(1), *arrays[1:]],
                    ["row", "page_id", "url", "host", "texts", "letters", "features", "owns", "chains", "marks", "named", "paths", "layouts"],
                )

    source = pages.select(F.col(key).alias("page_id"), "url", "html")
    kind = source.schema["page_id"].dataType.simpleString()
    return source.mapInArrow(parse, _PARSED.format(key=kind))


def part_of(row: str) -> Column:
    """The task that parsed the page of a row number."""
    return F.shiftright(row, PART_BITS).cast("int")


def threshold(path: Column) -> Column:
    """The importance below which a branch is removed, by the prior in its number."""
    return F.element_at(F.array(*[F.lit(IMPORTANCE[x]) for x in range(4)]), (prior_of(path) + 1).cast("int"))


def prior_of(path: Column) -> Column:
    return path.bitwiseAND(F.lit(3))


def recurring_texts(parsed: DataFrame) -> DataFrame:
    """feature, host and pages of texts that more than one page of a host holds."""
    features = parsed.select("host", F.explode(F.array_distinct("features")).alias("feature"))
    return features.groupBy("feature").agg(F.first("host").alias("host"), F.count("*").alias("pages")).filter("pages > 1")


def distinct_pages(parsed: DataFrame, recurring: DataFrame) -> DataFrame:
    """One page of each content that a host has.

    Pages of equal blocks are copies. So are pages that share texts found on no more than half of
    the host's pages, if all else that is only theirs, such as a date or a counter, has at most
    half as many letters.
    """
    hosts = parsed.groupBy("host").agg(F.count("*").alias("all_pages"))
    shared = stored(
        join_groups(recurring, hosts, ["host"], "all_pages", "inner")
        .select("feature", "pages", (2 * F.col("pages") <= F.col("all_pages")).alias("shared")),
        "shared",
    )
    blocks = parsed.select("row", F.explode(F.array_distinct(F.arrays_zip("features", "letters"))).alias("b"))
    blocks = blocks.select("row", F.col("b.features").alias("feature"), F.col("b.letters").alias("letters"))
    found = join_groups(split_by_keys(blocks, "feature", shared)[0], shared, ["feature"], "pages", "inner")
    sums = found.groupBy("row").agg(
        F.sum("letters").alias("recurring"),
        F.sum(F.when(F.col("shared"), F.col("letters")).otherwise(0)).alias("common"),
        F.collect_set(F.when(F.col("shared"), F.col("feature"))).alias("features"),
    )
    sums = sums.select("row", "recurring", "common", F.xxhash64(F.sort_array("features")).alias("common_print"))
    total = F.aggregate(
        F.array_distinct(F.arrays_zip("features", "letters")), F.lit(0).cast("long"), lambda n, b: n + b["letters"]
    )
    prints = parsed.select("row", "host", total.alias("total"), F.xxhash64("features").alias("print")).join(sums, "row", "left")
    alike = (F.col("common") > 0) & (2 * (F.col("total") - F.col("recurring")) <= F.col("common"))
    prints = stored(
        prints.select("row", F.xxhash64("host", F.when(alike, F.col("common_print")).otherwise(F.col("print")), F.coalesce(alike, F.lit(False))).alias("print")),
        "prints",
    )
    contents = prints.groupBy("print").agg(F.min("row").alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    copies = join_groups(prints, stored(contents, "contents"), ["print"], "copies", "inner").filter("row <> first").select("row")
    copies = stored(copies, "copies")
    possible, single = split_by_keys(parsed.select("row", "features", "owns", "chains", "paths", "layouts"), "row", copies)
    return possible.join(copies, "row", "left_anti").unionByName(single)


def judged_branches(parsed: DataFrame, recurring: DataFrame) -> DataFrame:
    """path, pages and `low` of the style tree's branches, and of texts in them, whose importance is below their
    threshold (`low`), and of branches outside articles that are important enough to stay beside them.

    A branch's presentation is as important as its layouts differ between pages (their entropy, with
    the number of pages as base), its content as its texts do: a text on every page has entropy 1
    and no importance, one on a single page has entropy 0. The more layouts a branch has, the more
    its presentation counts. A text that stands in one branch with others, as a notice among an
    article's paragraphs, is judged by its own entropy there. All sums are taken before rows move,
    so a host with a third of all pages is no larger a group than its distinct texts; texts of one
    page have entropy 0 and are only counted. Copies of a page count once.
    """
    parsed = distinct_pages(parsed, recurring)
    layouts = parsed.select(F.explode(F.arrays_zip("paths", "layouts")).alias("e"))
    layouts = layouts.groupBy(F.col("e.paths").alias("path"), F.col("e.layouts").alias("layout")).agg(F.count("*").alias("n"))
    styles = layouts.groupBy("path").agg(
        F.sum("n").alias("elements"), F.sum(F.col("n") * F.log("n")).alias("n_log_n"), F.count("*").alias("kinds")
    )
    presence = parsed.select(F.explode(F.array_distinct(F.flatten("chains"))).alias("path"))
    presence = presence.groupBy("path").agg(F.count("*").alias("pages")).filter(F.col("pages") >= LEAST_PAGES)
    presence = stored(presence, "presence")

    # Once for each page, path and text: how often the page has the text there.
    blocks = parsed.select("row", F.explode(F.arrays_zip("features", "owns", "chains")).alias("b"))
    blocks = blocks.select("row", F.col("b.features").alias("feature"), F.col("b.owns").alias("own"), F.col("b.chains").alias("chain"))
    repeated, single = split_by_keys(blocks, "feature", recurring)
    alone = single.select(F.explode(F.array_distinct("chain")).alias("path")).groupBy("path").agg(F.count("*").alias("texts"))
    alone = alone.withColumn("spreads", F.lit(0.0))
    paths = repeated.select("row", "feature", F.explode(F.array_distinct("chain")).alias("path"))

    def entropies(rows: DataFrame, *keys: str) -> DataFrame:
        counts = rows.groupBy(*keys, "row").agg(F.count("*").alias("c"))
        sums = counts.groupBy(*keys).agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.log("c")).alias("c_log_c"), F.count("*").alias("on"))
        return sums.withColumn("spread", F.log("n") - F.col("c_log_c") / F.col("n"))

    several = entropies(paths, "path", "feature").groupBy("path").agg(F.count("*").alias("texts"), F.sum("spread").alias("spreads"))
    content = alone.unionByName(several).groupBy("path").agg((F.sum("spreads") / F.sum("texts")).alias("spread"))

    base = F.log("pages")
    presentation = (F.log("elements") - F.col("n_log_n") / F.col("elements")) / base
    weight = F.pow(F.lit(ATTENUATION), F.col("kinds"))
    importance = (1 - weight) * F.coalesce(presentation, F.lit(0.0)) + weight * (1 - F.col("spread") / base)
    branches = (
        presence.join(content, "path")
        .join(styles, "path", "left")
        .withColumn("importance", F.when(F.col("kinds").isNull(), 1 - F.col("spread") / base).otherwise(importance))
        .withColumn("low", F.col("importance") < threshold(F.col("path")))
        .filter(F.col("low") | prior_of(F.col("path")).isin(PLAIN, IN_MAIN) & (F.col("importance") >= KEPT_IMPORTANCE))
        .select("path", "pages", "low")
    )
    owns = repeated.filter("own <> 0").select("row", "own", F.element_at("chain", -1).alias("path"))
    texts = (
        entropies(owns, "own", "path")
        .filter(F.col("on") >= LEAST_PAGES)
        .join(presence, "path")
        .filter(1 - F.col("spread") / base < threshold(F.col("path")))
        .select(F.col("own").alias("path"), F.col("on").alias("pages"), F.lit(True).alias("low"))
    )
    return branches.unionByName(texts)


def verdict_blocks(met: DataFrame, buckets: int) -> DataFrame:
    """of_part, first, last and met: what the pages `first` to `last` of a task have met, ready for a join with its bucket."""
    block = F.shiftright("row", BLOCK_BITS)
    dealt = met.withColumn("of_part", part_of("row")).repartition(buckets, "of_part")
    blocks = dealt.groupBy("of_part", block.alias("block")).agg(F.collect_list(F.struct("row", "removed", "sides")).alias("met"))
    first = F.shiftleft("block", BLOCK_BITS)
    return blocks.select("of_part", first.alias("first"), (first + ((1 << BLOCK_BITS) - 1)).alias("last"), "met").hint("shuffle_hash")


def main_text(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Key, url, text and n_chars of each page: the article's blocks in order, joined by line feeds.

    All elements are judged by the host's style tree, those in article and main elements and those
    whose element, role, class or id names them as menus, headers, footers, sidebars, notices,
    adverts, forms or comments too; place and names only shift the importance that is asked for.
    Branches and texts that the tree finds unimportant are removed, unless nothing would be left of
    the page. Named branches are left out, unless one holds more text than all without a name, and
    of what is left an article or main element keeps out text that is not in it, if it holds as much
    and the tree does not find that text important; articles with less than half of the text
    elsewhere, as teasers beside a story, give way to it. Null and empty pages give an empty text; pages
    without a host form one group; repeated keys and rows stay as they are; an empty table gives no
    rows.
    """
    # A page lies in the bucket of the task that parsed it, so its texts stay where they are when verdicts come to it.
    parsed, buckets = stored_by(parsed_pages(pages, key).withColumn("part", part_of("row")), "pages", "part")
    recurring = stored(recurring_texts(parsed), "recurring")
    verdicts = stored(judged_branches(parsed, recurring), "branches")
    blocks = F.arrays_zip("texts", "owns", "chains", "marks", "named")

    def meet(branches: Column, low: bool) -> DataFrame:
        """Of each page that has any, those of its branches on which the tree has that verdict."""
        rows = parsed.select("row", F.explode(F.array_distinct(branches)).alias("path"))
        some = verdicts.filter(F.col("low") == low).drop("low")
        found = join_groups(split_by_keys(rows, "path", some)[0], some, ["path"], "pages", "inner")
        return found.select("row", "path", F.lit(low).alias("low"))

    # Beside an article: the innermost branches of blocks outside it.
    outside = F.filter(blocks, lambda b: (b["marks"] != "article") & (b["named"] == 0) & (F.size(b["chains"]) > 0))
    outside = F.when(F.array_contains("marks", "article"), F.transform(outside, lambda b: F.element_at(b["chains"], -1)))
    found = meet(F.concat(F.flatten("chains"), "owns"), True).unionByName(meet(outside, False))
    removed = F.collect_set(F.when(F.col("low"), F.col("path"))).alias("removed")
    sides = F.collect_set(F.when(~F.col("low"), F.col("path"))).alias("sides")
    met = stored(found.groupBy("row").agg(removed, sides), "met")
    none = F.array().cast("array<bigint>")
    # Spark leaves the pages in place for a join by `part` alone, so verdicts come in blocks of a range of pages each.
    pages_read = parsed.select("part", "row", "page_id", "url", "texts", "owns", "chains", "marks", "named")
    judged = pages_read.join(verdict_blocks(met, buckets), (F.col("part") == F.col("of_part")) & F.col("row").between(F.col("first"), F.col("last")), "left")
    mine = F.get(F.filter("met", lambda m: m["row"] == F.col("row")), F.lit(0))
    judged = judged.select("page_id", "url", "texts", "owns", "chains", "marks", "named", mine.alias("mine"))
    judged = judged.withColumns({x: F.coalesce(F.col("mine")[x], none) for x in ("removed", "sides")}).drop("mine")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                lists = zip(*(part.column(x).to_pylist() for x in ("texts", "owns", "chains", "marks", "named", "removed", "sides")))
                texts = pa.array(["\n".join(chosen(*x)) for x in lists], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), texts], ["page_id", "url", "text"])

    kind = parsed.schema["page_id"].dataType.simpleString()
    found = judged.mapInArrow(finish, f"page_id {kind}, url string, text string")
    return found.select(F.col("page_id").alias(key), "url", "text").withColumn("n_chars", F.length("text").cast("long"))


def chosen(
    texts: list[str], owns: list[int], chains: list[list[int]], marks: list[str], named: list[int], removed: list[int], sides: list[int]
) -> list[str]:
    """Those of a page's blocks that are its main text, given the branches and texts that its host's tree removes, and the
    branches that it finds important beside an article.

    A named branch that the tree does not find unimportant stays left out only if the blocks without
    a name hold as much text.
    """
    gone, beside = set(removed), set(sides)
    every = range(len(texts))
    important = [i for i in every if owns[i] not in gone and gone.isdisjoint(chains[i])] if gone else every
    lengths: Counter[int] = Counter()
    for i in important:
        lengths[named[i]] += len(texts[i])
    left = [i for i in important if not named[i] or lengths[named[i]] > lengths[0]]
    left = left or [i for i in every if not named[i]] or every

    held: Counter[str] = Counter()
    for i in left:
        held[marks[i]] += len(texts[i])
    article, main, other = held["article"], held["main"], held[""]
    stays = {"article": 2 * article >= max(main, other), "main": main >= article, "": other >= article + main}
    return [texts[i] for i in left if stays[marks[i]] or chains[i] and chains[i][-1] in beside]
