"""Main text of web pages by deducing the template that pages of a host share.

Tags of a page, told apart by name, class, role and the containers around them, are tokens. Tokens with the
same occurrence vector over the pages of a group form an equivalence class. The class that
occurs once on every page, as far as its tokens follow each other in the same order everywhere, is the
template's skeleton; a class that occurs more often is valid if it stays in one gap of the
skeleton, and nests there. What lies between the tokens of the template are its slots, and text that is not the same on
all pages fills them. The main region is sought among the containers of the template, those of the skeleton
and nested ones: from the body inwards, the one that holds more than half of the varying text, until text
stands in it directly or no single one holds so much. Article and main elements are a hint: together they
are the region if they hold a quarter of the varying text where they stand. All text of the region is
taken; without a region, the slots whose text varies. A page without text in the region falls back to the containers
around it. Text in elements for menus, headers, footers, sidebars, forms and the like is left out wherever it stands. An
element of any kind whose class or id is a name for a sidebar, notice, advert or comment, and nothing else, is left
out, too, unless it is the body or main element, holds the article, or nothing would be left. Only an element that is
closed can be trusted for where it ends: one that isn't ends where the element around it ends, and doesn't
hide an article.

Pages of a host are dealt into groups of about ``GROUP`` pages by the hash of their id, so a
large host is spread over tasks; a group is held in one task. Rows that repeat more often than that are dealt by the part of the
table they were read from, too, and a task holds equal rows once.

Defined cases: null or empty html gives an empty text; a null url has the empty host; repeated page ids are pages of their
own; a page alone in its group is its own template; a very long page is parsed whole, in time in proportion to its length;
an empty table gives no rows; ties between regions go to the larger token; other columns are not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.shared import on_workers, shuffle_partitions

GROUP = 64
BROADCAST_BYTES = 16 << 20

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
RAW = frozenset("script style noscript template iframe svg math textarea select object canvas title".split())
CONTAINERS = frozenset(
    "html head body div section article main nav header footer aside form ul ol dl table thead tbody tr td th "
    "figure fieldset details dialog blockquote menu".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT_TAGS = frozenset("head nav header footer aside form menu dialog button fieldset".split())
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
LEFT_OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription share sharing social related recommended comment comments respond reply "
    "replies disqus footer header masthead topbar toolbar login signup search pagination pager widget skip".split()
)
#: words that say nothing beside one of these
NEUTRAL_WORDS = frozenset(
    "box bar block container wrapper wrap list item items link links button buttons area section inner outer slot unit units "
    "posts articles left right top bottom site page global main primary secondary body content group row col column "
    "title heading text small large fixed sticky author meta thread form panel".split()
)
MAIN_TAGS = frozenset(["article", "main"])
MAIN_WORDS = frozenset("article post entry content story articlebody".split())
ROOTS = frozenset(["html", "body"])
HINT = 0.25
WORD = re.compile(r"[A-Za-z]+")


#: what an element is to be left out for
BY_NAME, BY_KIND = 1, 2


@dataclass
class Page:
    """Tokens with their places, and text runs: (place, number of the block, containers, text).

    ``holds_main`` has the paths of elements that hold an article and are left out by name, or weren't closed;
    ``unclosed`` those of all that weren't closed.
    """

    tokens: list[tuple] = field(default_factory=list)
    texts: list[tuple[int, int, tuple, str]] = field(default_factory=list)
    holds_main: set[tuple] = field(default_factory=set)
    unclosed: set[tuple] = field(default_factory=set)

    def left_out(self, path: tuple) -> bool:
        return any(c[2] and path[: d + 1] not in self.holds_main for d, c in enumerate(path))

    def shown(self) -> list[tuple[int, int, tuple, str]]:
        """The texts that aren't left out; if there are none, those that are by their names only."""
        out = {path: self.left_out(path) for path in {x[2] for x in self.texts}}
        texts = [x for x in self.texts if not out[x[2]]]
        if any(not x[3].isspace() for x in texts):
            return texts
        return [
            x
            for x in self.texts
            if not any(c[2] == BY_KIND and x[2][: d + 1] not in self.unclosed for d, c in enumerate(x[2]))
        ]


def named_for_junk(label: str) -> bool:
    """Whether one of the names says sidebar, advert, comment or the like, and nothing else."""
    for name in label.split():
        words = {w.lower() for w in WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name))}
        if words & LEFT_OUT_WORDS and words <= LEFT_OUT_WORDS | NEUTRAL_WORDS:
            return True
    return False


def named(tag: str, attributes: str) -> tuple[str, str, int, bool]:
    """An element's name for the template, its classes, what it is left out for, and whether it is main."""
    if not attributes or "=" not in attributes:
        hidden = " hidden" in attributes.lower() if attributes else False
        return tag, "", BY_KIND if tag in LEFT_OUT_TAGS or hidden else 0, tag in MAIN_TAGS
    values = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
    label = " ".join(values.get(k, "") for k in ("class", "id"))
    role = values.get("role", "").lower()
    hidden = values.get("aria-hidden", "").lower() == "true" or re.search(r"\shidden(\s|$|=)", attributes.lower())
    out = BY_KIND if tag in LEFT_OUT_TAGS or role in LEFT_OUT_ROLES or hidden else 0
    if not out and tag not in ROOTS and tag != "main" and named_for_junk(label):
        out = BY_NAME
    words = {w.lower() for w in WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", label))}
    main = tag in MAIN_TAGS or role in ("main", "article") or bool(words & MAIN_WORDS)
    main = main or values.get("itemprop", "") == "articleBody"
    return tag, re.sub(r"[0-9]+", "0", values.get("class", "")) + "|" + role, out, main and tag not in ROOTS


class Open:
    """The elements that are open at a place of a page: containers, and others that are to be left out."""

    def __init__(self, page: Page):
        self.page = page
        self.stack: list[tuple[str, str, int, bool]] = []
        self.holds: list[bool] = []  # whether an article stands in it
        self.path: tuple = ()

    def push(self, one: tuple[str, str, int, bool]) -> None:
        if one[3] and not one[2]:
            self.holds = [True] * len(self.holds)
        self.stack.append(one)
        self.holds.append(False)
        self.path = tuple(self.stack)

    def drop(self, depth: int, closed: bool = True) -> None:
        """Leave everything from ``depth`` on, of which the outermost is closed by its own tag, or not."""
        for d in range(depth, len(self.stack)):
            own, path = closed and d == depth, self.path[: d + 1]
            if not own:
                self.page.unclosed.add(path)
            if self.holds[d] and self.stack[d][2] and (self.stack[d][2] == BY_NAME or not own):
                self.page.holds_main.add(path)
        del self.stack[depth:], self.holds[depth:]
        self.path = tuple(self.stack)

    def find(self, tag: str, containers: bool) -> int | None:
        """Where the innermost element of this name is open; for others than containers, inside the innermost of these."""
        for d in range(len(self.stack) - 1, -1, -1):
            if self.stack[d][0] == tag:
                return d
            if not containers and self.stack[d][0] in CONTAINERS:
                return None
        return None

    def small(self, tag: str, slash: str, attributes: str) -> None:
        """A tag that is no container: its element matters if it is to be left out."""
        depth = self.find(tag, False)
        if slash:
            if depth is not None:
                self.drop(depth)
            return
        if tag not in INLINE and self.stack and self.stack[-1][0] in ("p", tag) and self.stack[-1][0] not in CONTAINERS:
            self.drop(len(self.stack) - 1)  # a paragraph or list item ends where the next begins
            depth = self.find(tag, False)
        one = named(tag, attributes) if attributes else (tag, "", 0, False)
        if one[2] or depth is not None:
            self.push((one[0], one[1], one[2], False))


def parse(html: str) -> Page:
    page = Page()
    now = Open(page)
    place, block, at, end = 0, 0, 0, len(html)
    while at < end:
        found = TAG.search(html, at)
        begin = found.start() if found else end
        if begin > at:
            page.texts.append((place, block, now.path, html[at:begin]))
        if not found:
            break
        at = found.end()
        if found[2] is not None:
            slash, tag, attributes = found[1], found[2].lower(), found[3]
        elif found[5] is not None:
            slash, tag, attributes = found[4], found[5].lower(), found[6]
        else:
            continue
        if tag == "br":
            page.texts.append((place, block, now.path, " "))
            continue
        if tag in INLINE:
            if tag not in VOID:
                now.small(tag, slash, attributes)
            continue
        block += 1
        place += 1
        if not slash and tag in RAW:
            close = re.compile(f"</{tag}\\b[^>]*(?:>|\\Z)", re.I).search(html, at)
            at = close.end() if close else end
            page.tokens.append((now.path, tag, "", False))
            continue
        if tag in VOID:
            continue
        if tag in CONTAINERS or tag == "button":
            if now.stack and now.stack[-1][0] == "p":  # a paragraph holds no container
                now.drop(len(now.stack) - 1)
            if slash:
                depth = now.find(tag, True)
                if depth is not None:
                    one = now.stack[depth]
                    now.drop(depth)
                    page.tokens.append((now.path, tag, one[1], True))
            else:
                if tag == "body" and (depth := now.find("head", True)) is not None:
                    now.drop(depth)
                one = named(tag, attributes)
                page.tokens.append((now.path, tag, one[1], False))
                now.push(one)
        else:
            page.tokens.append((now.path, tag, "", bool(slash)))
            now.small(tag, slash, attributes)
        place = len(page.tokens)
    now.drop(0, closed=False)
    return page


def same_order(sequences: list[list]) -> list:
    """Tokens, each once in every sequence, that follow each other alike in all: longest rising runs in turn."""
    kept = sequences[0]
    for other in sequences[1:]:
        where = {t: i for i, t in enumerate(other)}
        tails: list[int] = []
        last: list[int] = []
        before: list[int] = [-1] * len(kept)
        for i, t in enumerate(kept):
            k = bisect_left(tails, where[t])
            if k == len(tails):
                tails.append(where[t])
                last.append(i)
            else:
                tails[k], last[k] = where[t], i
            before[i] = last[k - 1] if k else -1
        i, picked = (last[-1] if last else -1), []
        while i >= 0:
            picked.append(kept[i])
            i = before[i]
        kept = picked[::-1]
    return kept


@dataclass
class Template:
    skeleton: list[tuple]
    nested: dict[int, list[tuple]]  # gap of the skeleton -> tokens of the classes nested there
    regions: list[frozenset]  # from the outermost to the main one: the container tokens of each
    slots: set[int]  # gaps whose text varies


def gaps_of(page: Page, skeleton: set) -> list[int]:
    """Places of the skeleton's tokens on a page."""
    return [i for i, t in enumerate(page.tokens) if t in skeleton]


def containers_of(path: tuple) -> list[tuple]:
    """Opening tokens of a path's containers and whether each is an article or the like."""
    return [((path[:d], c[0], c[1], False), c[3]) for d, c in enumerate(path) if c[0] not in ROOTS]


def regions_of(sizes: Counter, known: set) -> list[frozenset]:
    """Regions from the body inwards; ``sizes`` has the varying characters of each path, ``known`` the template's tokens."""
    held = {path: [c for c in containers_of(path) if c[0] in known] for path in sizes}
    found: list[frozenset] = []
    while held:
        depth, total = len(found), sum(sizes[p] for p in held)
        within: Counter = Counter()
        for path, chain in held.items():
            within[chain[depth] if len(chain) > depth else None] += sizes[path]
        direct = within.pop(None, 0)
        hinted = [c for c in within if c[1]]
        if hinted and sum(within[c] for c in hinted) >= HINT * total:
            return [*found, frozenset(token for token, _ in hinted)]
        largest = max(within, key=lambda c: (within[c], c), default=None)
        if largest is None or (found and direct) or 2 * within[largest] <= total:
            return found
        found.append(frozenset([largest[0]]))
        held = {p: chain for p, chain in held.items() if len(chain) > depth and chain[depth] == largest}
    return found


def deduce(pages: list[Page]) -> Template:
    counts = [Counter(p.tokens) for p in pages]
    classes: dict[tuple, list[tuple]] = defaultdict(list)
    for token in set().union(*counts):
        classes[tuple(c[token] for c in counts)].append(token)
    once = set(classes.pop((1,) * len(pages), []))
    skeleton = same_order([[t for t in p.tokens if t in once] for p in pages])
    inside = set(skeleton)
    places = [gaps_of(p, inside) for p in pages]
    where: dict[tuple, set[int]] = defaultdict(set)
    for page, marks in zip(pages, places, strict=True):
        for i, token in enumerate(page.tokens):
            if token not in inside:
                where[token].add(bisect_right(marks, i))
    nested: dict[int, list[tuple]] = defaultdict(list)
    for tokens in [*classes.values(), *([t] for t in once - inside)]:
        gaps = set().union(*(where[t] for t in tokens))
        if len(gaps) == 1:
            nested[gaps.pop()] += tokens
    runs = [
        [(bisect_left(marks, place), path, text) for place, _, path, text in page.shown() if text and not text.isspace()]
        for page, marks in zip(pages, places, strict=True)
    ]
    copies = Counter(x for run in runs for x in {(gap, text) for gap, _, text in run})
    every = [x for run in runs for x in run]
    varying = [x for x in every if copies[x[0], x[2]] < len(pages)] or every
    sizes: Counter = Counter()
    for _, path, text in varying:
        sizes[path] += len(text)
    known = inside.union(*nested.values())
    return Template(skeleton, dict(nested), regions_of(sizes, known), {gap for gap, _, _ in varying})


def extract(page: Page, template: Template) -> str:
    """The text in the template's main region, or in its slots."""
    texts = page.shown()
    around = {path: {token for token, _ in containers_of(path)} for path in {x[2] for x in texts}}
    marks = gaps_of(page, set(template.skeleton))
    choices = [[x for x in texts if region & around[x[2]]] for region in reversed(template.regions)]
    choices += [[x for x in texts if bisect_left(marks, x[0]) in template.slots], texts]
    taken = next((c for c in choices if any(not x[3].isspace() for x in c)), [])
    blocks: dict[int, list[str]] = defaultdict(list)
    for _, block, _, text in taken:
        blocks[block].append(text)
    cleaned = (" ".join(unescape("".join(parts)).split()) for parts in blocks.values())
    return " ".join(x for x in cleaned if x)


def group_texts(htmls: list[str]) -> list[str]:
    pages = [parse(h) for h in htmls]
    template = deduce(pages)
    return [extract(p, template) for p in pages]


def few(df: DataFrame) -> DataFrame:
    """Broadcast if it has few bytes; otherwise Spark plans the join."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def extract_pages(pages: DataFrame, group: int = GROUP) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    spark = pages.sparkSession
    on_workers(spark)
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(
        F.col("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host.alias("host")
    )
    kind = rows.schema["page_id"].dataType.simpleString()
    sizes = rows.groupBy("host").count().where(F.col("count") > group)
    sizes = few(sizes.select("host", F.ceil(F.col("count") / group).alias("groups")))
    rows = rows.withColumn("hash", F.xxhash64("page_id", "html"))
    copies = rows.groupBy("hash").count().where(F.col("count") > group)
    copies = few(copies.select("hash", F.lit(True).alias("often")))
    dealt = rows.withColumn("read_in", F.spark_partition_id()).join(sizes, "host", "left").join(copies, "hash", "left")
    apart = F.when(F.col("often"), F.xxhash64("hash", "read_in")).otherwise(F.col("hash"))
    salt = F.pmod(apart, F.coalesce("groups", F.lit(1)))
    dealt = dealt.withColumn("salt", salt).drop("groups", "often", "read_in", "hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key = None
        seen: dict[str, int] = {}  # equal pages of a group are held once

        def done() -> pa.RecordBatch:
            found = group_texts(list(seen))
            texts = [found[x[2]] for x in held]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in held], page_type[0]),
                    pa.array([x[1] for x in held], pa.string()),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

        page_type = [None]
        for batch in batches:
            page_type[0] = batch.column("page_id").type
            columns = [batch.column(c).to_pylist() for c in ("host", "salt", "page_id", "url", "html")]
            for h, s, page, url, html in zip(*columns, strict=True):
                if (h, s) != key:
                    if held:
                        yield done()
                    key, held, seen = (h, s), [], {}
                held.append((page, url, seen.setdefault(html or "", len(seen))))
        if held:
            yield done()

    return (
        dealt.repartition(shuffle_partitions(spark), "host", "salt")
        .sortWithinPartitions("host", "salt")
        .mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
    )
