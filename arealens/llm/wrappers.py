"""Main text of web pages by wrappers inferred per host.

A *wrapper* is a union-free regular expression over a host's token streams:
nested groups of tags, each once, optional (``?``) or repeated (``+``/``*``),
with constant texts and text slots.  It starts as the first page's own stream
and is generalised by all distinct pages of the host: tags that match are aligned, a tag
that recurs beside itself becomes a repeated group, one that some page lacks an
optional group, and texts that differ become a slot.  A host's pages are dealt
by their content to buckets, each bucket's pages are aligned one by one, and the
buckets' wrappers are aligned with one another ``FAN`` at a time.

The wrapper then decides what is main text: its region is every article element
(else every main element) that holds text, and where no element marks the
article the group that holds most of the slots' text outside links.  Every page
is read by aligning its own token stream with the wrapper: at each element the
next group of that signature is taken, optional groups are passed over,
repeated ones may be taken again, and what the region's groups cover is read.
Menus, adverts, notices, forms and comments inside are left out by what their
element says.  A page in which no group of the region occurs is read with a
wrapper of its own.

Where no element marks the article, the region also loses the host's constant
texts: blocks that are in nearly all of its distinct pages, counted over every
page, of at least ``LEAST_PAGES``.

Buckets are bounded, the wrappers are small, and every page is read whole by
itself, so a host with a third of the pages costs no more than its pages.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

SAMPLE_PAGES = 4  # pages of a host where its wrapper is asked for of a few only
BUCKET_PAGES, BUCKET_CHARS = 64, 8 << 20  # distinct pages of a host that one task aligns, about
FAN = 16  # wrappers aligned with one another at a time
LEAST_PAGES = 5  # distinct pages of a host before any text counts as constant
NEARLY_ALL = 0.95  # share of them that a constant text is in (all, under 20 pages)
BROADCAST_BYTES = 16 << 20

# Every token may end with the page and every repeat is possessive: a page is read once
# from left to right, whatever it leaves open.  A quote counts after "=" only.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)"
                    r"((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?:>|\Z)", re.S)
_MARK = re.compile(r"\b(class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.I)
_DIGITS = re.compile(r"[0-9]+")
_SPACE = re.compile(r"\s+")
_RAW = frozenset("script style noscript template textarea title iframe svg".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary
table tbody td tfoot th thead tr ul caption legend option""".split())
#: An opening tag ends these open elements, up to the nearest of their containers.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
         "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_CLOSES_P = _BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "legend"}
# What is not main text, by tag and by the words of class, id and role.
_NOT_TEXT = frozenset("head nav footer aside form button select dialog menu".split()) | _RAW
_NOT_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promoted
nav navbar navigation menu breadcrumb breadcrumbs sidebar footer cookie cookies consent notice notices alert
newsletter subscribe share sharing social comment comments disqus related recommended popup modal login signup
search pagination pager skip complementary contentinfo toolbar""".split())
# Words that only place or shape such a part; any other word makes a class the article's own ("social-history").
_PLACES = frozenset("""area articles bar block bottom bottoms box button buttons container content form group header
icon icons inner item items left links list main media module outer page panel posts primary right row secondary section site slot
stories text title top unit user widget wrap wrapper reader readers article post story""".split())
_HEADS = frozenset("header masthead topbar".split())  # only outside the article
_ARTICLE = frozenset("article main".split())


class Group:
    """One group of a wrapper, or one element of a page."""

    __slots__ = ("sig", "low", "high", "kids", "text", "chars", "linked", "seen", "usual", "lead")

    def __init__(self, sig: str):
        self.sig, self.low, self.high = sig, 1, 1
        self.kids: list[Group] = []
        self.text: str | None = ""  # constant text; None: a slot
        self.chars, self.linked = 0, False  # of a text: its length on all pages, whether in a link
        self.seen = 1  # how many were aligned (of the root: pages)
        # of a text: the one text that may be most of them, and by how many at least it outnumbers the others
        self.usual: str | None = None
        self.lead = 0

    def walk(self) -> Iterator[tuple[Group, bool]]:
        """Every group before (True) and after (False) its kids, without recursion."""
        stack = [(self, True)]
        while stack:
            node, before = stack.pop()
            yield node, before
            if before:
                stack.append((node, False))
                stack += [(k, True) for k in reversed(node.kids)]

    def constant(self) -> bool:
        """One text in nearly all places: always if it has ``NEARLY_ALL`` of them, never under 2 * ``NEARLY_ALL`` - 1."""
        return self.lead >= (2 * NEARLY_ALL - 1) * self.seen

    def merge_text(self, other: Group) -> None:
        self.chars += other.chars
        self.linked = self.linked and other.linked
        if self.text != other.text:
            self.text = None
        if self.usual == other.usual:
            self.lead += other.lead
        else:  # each place of one text makes up for a place of another
            if other.lead > self.lead:
                self.usual = other.usual
            self.lead = abs(self.lead - other.lead)
            if not self.lead:
                self.usual = None

    def dump(self) -> str:
        """The wrapper as flat rows, each group with its depth."""
        rows, depth = [], 0
        for node, before in self.walk():
            if before:
                leaf = [node.text, node.chars, node.linked, node.lead, 0 if node.usual == node.text else node.usual]
                rows.append([depth, node.sig, node.low, node.high, node.seen, *(leaf if node.sig == "#" else [])])
            depth += 1 if before else -1
        return json.dumps(rows, separators=(",", ":"))

    def pattern(self) -> str:
        """The wrapper as an expression."""
        out = []
        for node, before in self.walk():
            sign = {(1, 1): "", (0, 1): "?"}.get((node.low, node.high), "*" if node.low == 0 else "+")
            if node.sig == "#":
                if before:
                    inner = "(.*)" if node.text is None else re.escape(node.text)
                    out.append(f"(?:{inner}){sign}" if sign else inner)
            elif before:
                out.append(f"(?:<{re.escape(node.sig)}>" if sign else f"<{re.escape(node.sig)}>")
            else:
                out.append(f"</>){sign}" if sign else "</>")
        return "".join(out)


def load(rows: str) -> Group:
    """The wrapper that ``Group.dump`` wrote."""
    path: list[Group] = []
    for depth, sig, low, high, seen, *leaf in json.loads(rows):
        node = Group(sig)
        node.low, node.high, node.seen = low, high, seen
        if leaf:
            node.text, node.chars, node.linked, node.lead, usual = leaf
            node.usual = node.text if usual == 0 else usual
        del path[depth:]
        if path:
            path[-1].kids.append(node)
        path.append(node)
    return path[0]


def signature(tag: str, attributes: str) -> str:
    """Tag and the words of class, id and role; numbers in them are one (``row-12`` is ``row-0``)."""
    if not attributes:
        return tag
    words = {w for x in _MARK.findall(attributes) for w in (x[1] or x[2] or x[3]).lower().split()}
    return " ".join([tag, *sorted({_DIGITS.sub("0", w) for w in words})])


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("open", tag, signature), ("close", tag, "") and ("text", text, ""), well nested."""
    stack: list[str] = []
    places: dict[str, list[int]] = defaultdict(list)  # places of every tag that is open

    def close(n: int) -> Iterator[tuple[str, str, str]]:
        while len(stack) > n:
            tag = stack.pop()
            places[tag].pop()
            yield "close", tag, ""

    def nearest(tags) -> int:
        return max((places[t][-1] for t in tags if places[t]), default=-1)

    at = 0
    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            yield "text", page[at:], ""
            break
        if m.start() > at:
            yield "text", page[at:m.start()], ""
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if places[tag]:
                yield from close(places[tag][-1])
            continue
        ends, within = _ENDS.get(tag, ((), ()))
        if ends and (i := nearest(ends)) > nearest(within):
            yield from close(i)
        if tag in _CLOSES_P and places["p"]:
            yield from close(places["p"][-1])
        yield "open", tag, signature(tag, m[3])
        if tag in _VOID or m[3].endswith("/") and tag not in _BLOCK:
            yield "close", tag, ""
        elif tag in _RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            yield "close", tag, ""
        else:
            places[tag].append(len(stack))
            stack.append(tag)
    yield from close(0)


def tree(page: str, grouped: bool = True) -> Group:
    """The page's own stream as a wrapper; ``grouped``: neighbours with one signature are a repeated group."""
    root = Group("")
    stack, linked = [root], 0
    for kind, value, sig in tokens(page):
        if kind == "open":
            node = Group(sig)
            stack[-1].kids.append(node)
            stack.append(node)
            linked += value == "a"
        elif kind == "close":
            node = stack.pop()
            linked -= value == "a"
            if grouped:
                _repeat(node)
        elif text := _SPACE.sub(" ", entities.unescape(value)).strip():
            leaf = Group("#")
            leaf.text, leaf.chars, leaf.linked = text, len(text), linked > 0
            leaf.usual, leaf.lead = text, 1
            stack[-1].kids.append(leaf)
    if grouped:
        _repeat(root)
    return root


def _repeat(node: Group) -> None:
    """Neighbouring kids with one signature become one repeated group."""
    _generalise(_merged(node))


def _merged(node: Group) -> list[tuple[Group, Group, bool]]:
    """Merge neighbouring kids; returns what is to be aligned for that."""
    kids: list[Group] = []
    todo = []
    for k in node.kids:
        if kids and kids[-1].sig == k.sig and k.sig != "#":
            todo.append((kids[-1], k, False))
            kids[-1].low, kids[-1].high = max(kids[-1].low, k.low), 2  # more than once
        else:
            kids.append(k)
    node.kids = kids
    return todo


def _common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a common subsequence: a longest one, found along the equal pairs; where
    the lists repeat themselves so often that these are far more than both lists
    are long, each of ``b`` takes the next equal one of ``a``."""
    if a == b:
        return list(zip(range(len(a)), range(len(b))))
    places: dict[str, list[int]] = defaultdict(list)
    for i, sig in enumerate(a):
        places[sig].append(i)
    if sum(len(places.get(sig, ())) for sig in b) > 64 * (len(a) + len(b)):
        out, at = [], 0
        for j, sig in enumerate(b):
            own = places.get(sig, ())
            k = bisect_left(own, at)
            if k < len(own):
                out.append((own[k], j))
                at = own[k] + 1
        return out
    tails: list[int] = []  # least last place of a chain of each length, with its last link
    heads: list[int] = []
    links: list[tuple[int, int, int]] = []  # (place in a, place in b, link before)
    for j, sig in enumerate(b):
        for i in reversed(places.get(sig, ())):
            k = bisect_left(tails, i)
            links.append((i, j, heads[k - 1] if k else -1))
            if k == len(tails):
                tails.append(i)
                heads.append(len(links) - 1)
            else:
                tails[k], heads[k] = i, len(links) - 1
    out, at = [], heads[-1] if heads else -1
    while at >= 0:
        i, j, at = links[at]
        out.append((i, j))
    return out[::-1]


def align(into: Group, other: Group) -> None:
    """Generalise ``into`` so that it also covers ``other`` (same signature)."""
    _generalise([(into, other, False)])


def _generalise(todo: list[tuple[Group, Group, bool]]) -> None:
    """Align pairs of groups, deepest first, with a stack of their own (pages nest as deep as they like)."""
    while todo:
        x, y, aligned = todo.pop()
        if aligned:  # its kids are generalised: neighbours may have become one group
            todo += _merged(x)
            continue
        x.seen += y.seen
        if x.sig == "#":
            x.merge_text(y)
            continue
        pairs = _common([k.sig for k in x.kids], [k.sig for k in y.kids])
        kids: list[Group] = []
        todo.append((x, y, True))
        i = j = 0
        for a, b in [*pairs, (len(x.kids), len(y.kids))]:
            for lone in x.kids[i:a] + y.kids[j:b]:  # groups that one of the two lacks: optional
                lone.low = 0
                kids.append(lone)
            if a < len(x.kids):
                mine, theirs = x.kids[a], y.kids[b]
                mine.low, mine.high = min(mine.low, theirs.low), max(mine.high, theirs.high)
                todo.append((mine, theirs, False))
                kids.append(mine)
            i, j = a + 1, b + 1
        x.kids = kids


def infer(pages: Iterable[str], read: Callable[[str], Group] = tree) -> Group:
    """The wrapper of some pages of a host (``read``: of what else wrappers are read from)."""
    first, *others = pages
    wrapper = read(first)
    for page in others:
        align(wrapper, read(page))
    return wrapper


@lru_cache(maxsize=1 << 14)
def _kind(sig: str, inside: bool) -> str:
    """``drop``, ``article``, ``main`` or ``plain``."""
    tag, *words = sig.split(" ")
    if tag in _NOT_TEXT:
        return "drop"
    if tag in ("html", "body", "main"):  # their classes say what else a page has
        return "main" if tag == "main" else "plain"
    named = [{p for p in re.split(r"[-_]+", w) if p and not p.isdigit()} for w in words]
    if any(parts & _NOT_WORDS and parts <= _NOT_WORDS | _PLACES for parts in named):
        return "drop"
    if not inside and (tag in _HEADS or any(parts & _HEADS for parts in named)):
        return "drop"
    if tag in _ARTICLE:
        return tag
    return "main" if "main" in words else "plain"


def describe(wrapper: Group, varied: bool = True) -> dict:
    """What the extraction needs of a wrapper: the groups of its region with their
    ancestors, as [parent, signature, whether of the region], and the mark of the
    region ("article", "main" or "" where no element marks it).

    ``varied``: the wrapper covers several pages, so that text of slots counts
    and constant text doesn't where no element marks the article."""
    nodes: list[tuple[Group, int, str]] = []  # (group, parent, kind); dropped groups and what is below them are left out
    own: list[int] = []
    path: list[int] = []
    dropped = 0
    for node, before in wrapper.walk():
        if not before:
            if dropped:
                dropped -= 1
            else:
                top = path.pop()
                if path:
                    own[path[-1]] += own[top]
            continue
        kind = "plain" if node.sig in ("", "#") else _kind(node.sig, False)
        if dropped or kind == "drop":
            dropped += 1
            continue
        nodes.append((node, path[-1] if path else -1, kind))
        counts = node.sig == "#" and not node.linked and not (varied and node.constant())
        own.append(node.chars if counts else 0)
        path.append(len(nodes) - 1)
    if varied and not own[0]:  # nothing varies: all text counts
        return describe(wrapper, False)

    def inside(i: int, chosen: set[int]) -> bool:
        while (i := nodes[i][1]) >= 0:
            if i in chosen:
                return True
        return False

    for mark in ("article", "main"):
        chosen: set[int] = set()
        texts = {i for i, (n, _, _) in enumerate(nodes) if n.sig == "#"}
        full = set()  # groups that hold any text
        for i in texts:
            while i >= 0 and i not in full:
                full.add(i)
                i = nodes[i][1]
        outer = [False] * len(nodes)  # below a chosen group already
        for i, (_, parent, kind) in enumerate(nodes):
            outer[i] = parent >= 0 and (outer[parent] or parent in chosen)
            if kind == mark and i in full and not outer[i]:
                chosen.add(i)
        if chosen:
            return {"marked": mark, "nodes": _paths(nodes, chosen)}
    # No element marks the article: go down to the group with most text outside links.
    at = 0
    kids: dict[int, list[int]] = defaultdict(list)
    for i, (_, parent, _) in enumerate(nodes):
        kids[parent].append(i)
    while own[at]:
        inner = [i for i in kids[at] if nodes[i][0].sig.split(" ")[0] not in ("#", "p", "b", "a", "span")]
        best = max(inner, key=own.__getitem__, default=None)
        if best is None or own[best] < 0.6 * own[at] or nodes[best][0].high > 1:
            break
        at = best
    return {"marked": "", "nodes": _paths(nodes, {at} if at else set())}


def _paths(nodes: list[tuple[Group, int, str]], chosen: set[int]) -> list[list]:
    """The chosen groups and their ancestors, numbered anew; the root is left out."""
    wanted = set()
    for i in chosen:
        while i > 0 and i not in wanted:
            wanted.add(i)
            i = nodes[i][1]
    number = {0: -1}
    out = []
    for i in sorted(wanted):
        number[i] = len(out)
        out.append([number[nodes[i][1]], nodes[i][0].sig, i in chosen])
    return out


class Region:
    """The region of a wrapper, ready to be aligned with pages."""

    def __init__(self, rules: dict):
        self.marked = rules["marked"]
        self.chosen = [n[2] for n in rules["nodes"]]
        self.kids: dict[int, dict[str, list[int]]] = defaultdict(lambda: defaultdict(list))
        for i, (parent, sig, _) in enumerate(rules["nodes"]):
            self.kids[parent][sig].append(i)
        self.whole = not rules["nodes"]  # no group stands out: the page as it is

    def group(self, parent: int | None, sig: str, last: int) -> int | None:
        """The group that an element of that signature takes: the one taken last or
        the next one, else the first; None where the wrapper has none."""
        own = self.kids[parent].get(sig) if parent is not None and parent in self.kids else None
        if not own:
            return None
        k = bisect_left(own, last)
        return own[k] if k < len(own) else own[0]


def region_blocks(page: str, region: Region) -> list[str] | None:
    """Texts of the blocks that the region's groups cover; None where none of them occurs."""
    blocks: list[str] = []
    parts: list[str] = []
    # (wrapper group or None, inside the region, dropped); last group taken at every level
    state: list[tuple[int | None, bool, bool]] = [(-1, region.whole, False)]
    last: list[int] = [0]
    seen = region.whole

    def flush() -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
        parts.clear()
        if text:
            blocks.append(text)

    for what, value, sig in tokens(page):
        group, inside, dropped = state[-1]
        if what == "text":
            if inside and not dropped:
                parts.append(value)
            continue
        if value in _BLOCK:
            flush()
        elif value == "br":
            parts.append(" ")
        if what == "close":
            state.pop()
            last.pop()
            continue
        own = region.group(group, sig, last[-1])
        if own is not None:
            last[-1] = own
        kind = _kind(sig, inside)
        dropped = dropped or kind == "drop"
        if not inside and not dropped:
            # an article that the wrapper's pages did not show is one as well
            inside = (own is not None and region.chosen[own]) or (region.marked != "" and kind == region.marked)
            seen = seen or inside
        state.append((own, inside, dropped))
        last.append(0)
    flush()
    return blocks if seen else None


def _key(text: str) -> bytes:
    return hashlib.md5(text.encode("utf-8", "surrogatepass")).digest()


def main_text(page: str | None, rules: Region | None, constant: frozenset[bytes] = frozenset()) -> str:
    """Main text by the host's region, less its constant texts (a page with no other text keeps them)."""
    if not page:
        return ""
    blocks = region_blocks(page, rules) if rules else None
    if blocks is None:
        blocks = region_blocks(page, Region(describe(tree(page, grouped=False), varied=False))) or []
    elif constant:
        blocks = [b for b in blocks if _key(b) not in constant] or blocks
    return "\n\n".join(blocks)


@lru_cache(maxsize=4096)
def _region(rules: str) -> Region:
    return Region(json.loads(rules))


def host_wrappers(pages: DataFrame, sample_pages: int | None = SAMPLE_PAGES, url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """(host, rules, pattern) of every host, inferred from ``sample_pages`` of its distinct pages (None: from all)."""
    from_host = pages.select(host_of(url_col).alias("host"), F.col(html_col).alias("html")).filter(
        "host is not null and html is not null and html <> ''")
    inferred = "host string, rules string, pattern string"
    if sample_pages is None:
        return _every_page(from_host).select("host", "wrapper").mapInArrow(_described, inferred)
    hashed = from_host.withColumn("h", F.xxhash64("html"))
    # copies are one key before the ranking, and their html is read for the chosen keys only
    order = W.partitionBy("host").orderBy("h")
    chosen = cut(hashed.select("host", "h").distinct().withColumn("n", F.row_number().over(order))
                 .filter(F.col("n") <= sample_pages).select("host", "h"))
    sample = hashed.join(_bounded(chosen, "host"), ["host", "h"]).groupBy("host", "h").agg(F.min("html").alias("html"))
    grouped = sample.groupBy("host").agg(F.array_sort(F.collect_list("html")).alias("parts"))
    return _aligned(grouped, tree, "host").mapInArrow(_described, inferred)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rules, patterns = [], []
        for rows in batch.column("wrapper"):
            wrapper = load(rows.as_py())
            rules.append(json.dumps(describe(wrapper, wrapper.seen > 1), ensure_ascii=False))
            patterns.append(wrapper.pattern())
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(rules, pa.string()), pa.array(patterns, pa.string())],
                                         names=["host", "rules", "pattern"])


def _aligned(grouped: DataFrame, read: Callable[[str], Group], *keys: str) -> DataFrame:
    """(keys, wrapper): the wrapper of every row's ``parts``, in their order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [infer((p.as_py() for p in parts), read).dump() for parts in batch.column("parts")]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(found, pa.string())],
                                             names=[*keys, "wrapper"])

    return grouped.select(*keys, "parts").mapInArrow(run, grouped.select(*keys).schema.add("wrapper", "string"))


def _every_page(from_host: DataFrame) -> DataFrame:
    """(host, bucket, wrapper): one row per host, its wrapper of all its distinct pages.

    A page's bucket follows from its text, so the wrapper depends on the
    distinct pages only, not on their order, copies or partitions.
    """
    sizes = cut(from_host.select("host", F.xxhash64("html").alias("h"), F.length("html").alias("chars")).distinct()
                .groupBy("host").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BUCKET_PAGES),
                                                F.ceil(F.sum("chars") / BUCKET_CHARS)).alias("buckets")))
    dealt = from_host.join(_bounded(sizes, "host"), "host").select(
        "host", F.pmod(F.xxhash64("html"), F.col("buckets")).alias("bucket"), "html")
    # copies are one before the shuffle already
    found = _aligned(dealt.groupBy("host", "bucket").agg(F.array_sort(F.collect_set("html")).alias("parts")),
                     tree, "host", "bucket")
    left = sizes.agg(F.max("buckets")).first()[0] or 1
    while left > 1:
        level = cut(found).select("host", F.floor(F.col("bucket") / FAN).alias("to"), F.struct("bucket", "wrapper").alias("part"))
        parts = F.transform(F.array_sort(F.collect_list("part")), lambda p: p["wrapper"])
        found = _aligned(level.groupBy("host", F.col("to").alias("bucket")).agg(parts.alias("parts")), load, "host", "bucket")
        left = -(-left // FAN)
    return found


def constant_texts(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, constant) for hosts whose article no element marks: digests of the blocks
    that nearly all distinct pages of the host hold.

    Every page is read; pages with the same blocks count once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, whole, keys = [], [], []
            for host, page, r in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "rules"))):
                if blocks := region_blocks(page, _region(r)):
                    hosts.append(host)
                    whole.append(_key("\n\n".join(blocks)))
                    keys.append([b"", *sorted({_key(b) for b in blocks})])  # b"" counts the pages
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(whole, pa.binary()), pa.array(keys, pa.list_(pa.binary()))],
                names=["host", "page", "keys"])

    read = pages.filter("html <> ''").join(_bounded(rules, "host", "rules"), "host").select("host", "html", "rules")
    counted = cut(read.mapInArrow(run, "host string, page binary, keys array<binary>")
                  .dropDuplicates(["host", "page"]).select("host", F.explode("keys").alias("key"))
                  .groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_PAGES))
    total = counted.filter(F.length("key") == 0).select("host", F.col("n").alias("pages"))
    return (counted.filter(F.length("key") > 0).join(_bounded(total, "host"), "host")
            .filter(F.col("n") >= NEARLY_ALL * F.col("pages"))
            .groupBy("host").agg(F.array_sort(F.collect_list("key")).alias("constant")))


def _bounded(df: DataFrame, *texts: str) -> DataFrame:
    """Broadcast hint if the rows (already cut) are small by their summed length."""
    size = df.agg(F.sum(sum((F.coalesce(F.length(c), F.lit(0)) for c in texts), F.lit(64)))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def host_of(url_col: str):
    return F.nullif(F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", sample_pages: int | None = None) -> DataFrame:
    """One row per page row: id, url, ``text`` (main text, empty if none), ``n_chars``.

    Wrappers are inferred from all distinct pages of their host, or from
    ``sample_pages`` of them where that is given.

    Null or empty html gives an empty text; pages with a null or odd url, and
    pages that their host's wrapper does not fit, are read with a wrapper of
    their own; repeated rows are repeated; null ids are kept; other columns are
    ignored; an empty table gives no rows.
    """
    rules = cut(host_wrappers(pages, sample_pages, url_col, html_col).select("host", "rules"))
    slim = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        host_of(url_col).alias("host"), F.col(html_col).alias("html"))
    unmarked = rules.filter(F.get_json_object("rules", "$.marked") == "")
    if unmarked.isEmpty():
        rules = rules.withColumn("constant", F.lit(None).cast("array<binary>"))
    else:
        rules = cut(rules.join(constant_texts(slim, unmarked), "host", "left"))
    sized = rules.select("*", F.array_join(F.transform("constant", F.hex), "").alias("digests"))
    joined = slim.join(_bounded(sized, "host", "rules", "digests").drop("digests"), "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, _region(r) if r else None, frozenset(c or ())) for page, r, c in
                     zip(*(batch.column(c).to_pylist() for c in ("html", "rules", "constant")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

    schema = slim.select("id", "url").schema.add("text", "string").add("n_chars", "long")
    return joined.select("id", "url", "html", "rules", "constant").mapInArrow(run, schema).withColumnsRenamed(
        {"id": id_col, "url": url_col})
