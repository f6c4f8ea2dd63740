"""HTML extraction with site style trees.

Pages of one host are merged into a style tree: a node is a chain of block elements with their classes.  The
importance of a node combines how varied the layouts below it are over the site's pages (presentation) and how varied
the texts of its leaves are (content); both are entropies to the base of the number of pages with the node.  Branches
that look and read alike on every page, such as menus, get a low importance and are removed from each page, within a
marked article too.  Elements whose tag, role or class says that they aren't the article go whatever their importance.
Where a page marks its article, nothing outside of it counts, unless the tree finds the whole mark alike on the site.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .store import written
from .text import pieces

# Elements by what they do to text.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre search section summary
    table tbody td tfoot th thead tr ul""".split()
)
CLOSES_P = BLOCK - {"body", "caption", "html", "option", "optgroup", "tbody", "td", "tfoot", "th", "thead", "tr"}
#: An open element of the first kind ends where one of the second begins (up to the given container).
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
DROP = {"nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "svg", "math", "canvas", "audio", "video", "object", "head", "search", *RAW}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert", "alertdialog", "toolbar"}
NOISE = set(
    """ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies consent
    gdpr notice notices popup modal overlay newsletter subscribe subscription signup login share sharing social sidebar
    aside breadcrumb breadcrumbs menu nav navbar navigation pagination pager footer comment comments commentlist disqus
    reply replies respond related recommended widget toolbar""".split()
)
#: Noise only outside of a marked article (where it may be the article's own head).
NOISE_OUTSIDE = {"header", "masthead", "banner", "topbar"}
NOISY_INLINE = {"span", "a", "b", "i", "em", "strong", "small", "label", "ins", "time"}
ARTICLE_CLASSES = {"articlebody", "post-content", "entry-content", "article-body", "article-content"}

#: Elements that are nested more deeply become siblings, as in browsers.
DEPTH = 512

ATTRIBUTE = re.compile(r"""([^\s=/"'<>]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
NAME = re.compile(r"[a-zA-Z][^\s/<>]*+")
PLAIN = re.compile(r"""[^<>"']*+""")
LONG_REFERENCE = re.compile(r"&#(?:[0-9]{9,}+|[xX][0-9a-fA-F]{9,}+);?")


def unescape(text: str) -> str:
    """Decoded character references; numbers of any length (the library's own conversion has a limit)."""

    def short(m: re.Match) -> str:
        digits = m[0][2:].rstrip(";").lower()
        rest = digits.lstrip("x").lstrip("0")
        return f"&#{'x' * digits.startswith('x')}{rest or '0'};" if len(rest) < 9 else "\ufffd"

    return html.unescape(LONG_REFERENCE.sub(short, text) if "&#" in text else text)


class Element:
    """An open or closed block element.  ``node`` is a number for its chain of tags and classes, ``mark`` the marked article
    that it is (in), ``low`` whether it is (in) a branch of low importance."""

    __slots__ = ("tag", "parent", "depth", "node", "noise", "mark", "head", "low", "inside", "held")

    def __init__(self, tag: str, parent: Element | None, attributes: str, low: set[int] | frozenset = frozenset()):
        classes, self.noise, article, self.head = (_told if len(attributes) < 200 else _says)(tag, attributes)
        self.tag, self.parent, self.depth = tag, parent, parent.depth + 1 if parent else 1
        self.node = _node(parent.node if parent else None, tag, classes if len(classes) < 200 else str(_number(classes)))
        self.low, self.mark = self.node in low, None
        if parent:
            self.noise, self.head, self.low, self.mark = self.noise or parent.noise, self.head or parent.head, self.low or parent.low, parent.mark
        if article and not self.noise and not self.mark:
            self.mark = self
        self.inside, self.held = False, []

    def chain(self) -> list[int]:
        """The nodes of its ancestors and its own, which is the last."""
        out, at = [], self
        while at:
            out.append(at.node)
            at = at.parent
        return out[::-1]


def _says(tag: str, attributes: str) -> tuple[str, bool, bool, bool]:
    """(sorted classes by line, noise, article, head) by an element's tag and attributes."""
    noise, article, head = tag in DROP, tag in ("article", "main"), tag == "header"
    if not attributes.strip():
        return "", noise, article, head
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    classes = found.get("class", "").lower()
    whole = f"{classes} {found.get('id', '')}".lower()
    words = set(re.split(r"[^a-z0-9]+", whole)) - {""}
    role = found.get("role", "").lower()
    noise = noise or bool(words & NOISE) or role in ROLES or "hidden" in found or found.get("aria-hidden") == "true"
    article = article or role in ("main", "article") or found.get("itemprop", "").lower() == "articlebody" or bool(set(whole.split()) & ARTICLE_CLASSES)
    return "\n".join(sorted(set(classes.split()))), noise, article, head or bool(words & NOISE_OUTSIDE)


#: What short attributes say, remembered.
_told = lru_cache(1 << 12)(_says)


@lru_cache(1 << 14)
def _node(parent: int | None, tag: str, classes: str) -> int:
    return _number("" if parent is None else str(parent), tag, classes)


def _tag_end(page: str, at: int) -> tuple[int, int]:
    """(end of the attributes, where to go on) of a tag: at its ``>``, at the next tag if there is none before, or at the end.
    A quote that never closes is a plain character."""
    while True:
        at = PLAIN.match(page, at).end()
        sign = page[at : at + 1]
        if sign in ("", "<"):
            return at, at
        if sign == ">":
            return at, at + 1
        closing = page.find(sign, at + 1)
        at = closing + 1 if closing >= 0 else at + 1


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest) in page order, in one pass: text, or a tag ``open`` or ``close`` with its attributes.  Comments and the
    content of elements that hold no text of the page are passed over."""
    at, n, more = 0, len(page), True
    while at < n:
        start = page.find("<", at)
        if start < 0:
            yield "text", "", page[at:]
            return
        if start > at:
            yield "text", "", page[at:start]
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else n
            continue
        close = page.startswith("/", start + 1)
        if m := NAME.match(page, start + 1 + close):
            end, at = _tag_end(page, m.end())
            name, attributes = m[0].lower(), page[m.end() : end]
            yield "close" if close else "open", name, attributes
            if name in RAW and not close and not attributes.rstrip().endswith("/"):
                end = RAW_END[name].search(page, at)
                at = end.end() if end else n
            continue
        end = page.find(">", start) if more and page[start + 1 : start + 2] in ("!", "?", "/") else -1
        if end >= 0:
            at = end + 1
        else:
            more = more and page[start + 1 : start + 2] not in ("!", "?", "/")
            yield "text", "", "<"
            at = start + 1


RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*+>", re.I) for tag in RAW}


class Inline:
    """The open inline elements of a block, and whether text in them isn't text of the page."""

    def __init__(self):
        self.open, self.count, self.skip_from = [], Counter(), None

    def clear(self) -> None:
        if self.open:
            self.open.clear(), self.count.clear()
            self.skip_from = None

    def push(self, tag: str, skip: bool) -> None:
        if skip and self.skip_from is None:
            self.skip_from = len(self.open)
        self.open.append(tag)
        self.count[tag] += 1

    def pop(self, tag: str) -> None:
        if self.count[tag]:
            while True:
                last = self.open.pop()
                self.count[last] -= 1
                if last == tag:
                    break
            if self.skip_from is not None and len(self.open) <= self.skip_from:
                self.skip_from = None


def blocks(page: str, low: set[int] | frozenset = frozenset()) -> list[tuple[Element | None, str]]:
    """(innermost block element, text) of each block of text, in page order.

    Inline elements are part of their block; what isn't closed is closed as browsers do for blocks.  The time is in proportion
    to the page's length (times ``DEPTH`` at worst).
    """
    stack: list[Element] = []
    opened: Counter = Counter()
    out: list[tuple[Element | None, str]] = []
    text: list[str] = []
    inline = Inline()

    def flush() -> None:
        if text:
            whole = " ".join(unescape("".join(text)).split())
            text.clear()
            if whole:
                out.append((stack[-1] if stack else None, whole))

    def cut(i: int) -> None:
        for e in stack[i:]:
            opened[e.tag] -= 1
        del stack[i:]

    def end_before(ends: set[str], within: set[str]) -> None:
        """Closes the innermost of ``ends`` that isn't outside of one of ``within``."""
        if any(opened[x] for x in ends):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag in ends:
                    return cut(i)
                if stack[i].tag in within:
                    return None

    for kind, tag, rest in tokens(page):
        if kind == "text":
            if inline.skip_from is None:
                text.append(rest)
        elif tag in RAW or (tag in VOID and tag not in ("br", "hr")):
            continue
        elif tag == "br":
            text.append(" ")
        elif tag not in BLOCK:
            if kind == "close":
                inline.pop(tag)
            elif not rest.rstrip().endswith("/"):
                inline.push(tag, tag in DROP or (tag in NOISY_INLINE and bool(rest.strip()) and _says(tag, rest)[1]))
        else:
            flush()
            skipped = inline.skip_from is not None
            inline.clear()
            if kind == "close":
                if opened[tag]:
                    i = len(stack) - 1
                    while stack[i].tag != tag:
                        i -= 1
                    cut(i)
                continue
            if tag in ("html", "body") and opened[tag]:
                continue
            if tag in CLOSES_P:
                end_before({"p"}, {"table", "td", "th", "button", "div", "article", "section"})
            if tag in IMPLIED:
                end_before(*IMPLIED[tag])
            if len(stack) >= DEPTH:
                cut(DEPTH - 1)
            if tag != "hr" and not rest.rstrip().endswith("/"):
                stack.append(Element(tag, stack[-1] if stack else None, rest, low))
                stack[-1].noise = stack[-1].noise or skipped
                opened[tag] += 1
    flush()
    return out


def is_noise(e: Element | None) -> bool:
    return bool(e and (e.noise or (e.head and not e.mark)))


def _number(*parts: str | int) -> int:
    return int.from_bytes(hashlib.blake2b("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def styles(page: str) -> tuple[set[tuple[int, int]], dict[int, int], dict[int, list[int]]]:
    """((node, number of a text) of its leaves, number of the layout by node, chain of nodes by leaf) of a page without its noise.

    An element's layout is the run of what stands in it: texts, and child elements with their own layouts; what follows its
    like counts once.  A node's layout is the run of its elements' layouts.
    """
    texts, layouts, chains = set(), defaultdict(list), {}
    stack: list[Element] = []

    def close() -> None:
        e = stack.pop()
        e.inside, layout = False, _number(*e.held)
        for held, value in ((layouts[e.node], layout), *([(stack[-1].held, _number(e.node, layout))] if stack else [])):
            if not held or held[-1] != value:
                held.append(value)

    for e, text in blocks(page):
        if e is None or is_noise(e):
            continue
        new, at = [], e
        while at and not at.inside:
            new.append(at)
            at = at.parent
        while stack and stack[-1] is not at:
            close()
        for x in reversed(new):
            x.inside = True
            stack.append(x)
        if not e.held or e.held[-1] != 0:
            e.held.append(0)
        texts.add((e.node, _number(text)))
        if e.node not in chains:
            chains[e.node] = e.chain()
    while stack:
        close()
    return texts, {node: _number(*runs) for node, runs in layouts.items()}, chains


def host(url: Column) -> Column:
    """Lower-cased host without user and port; null or odd URLs get an empty one."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def style_facts(pages: DataFrame) -> DataFrame:
    """Per page and style node: kind 0 a leaf's text (with the chain of nodes that it is in), kind 1 a node's layout; ``value`` is a hash of it.

    Every page of a host counts, and what lies in marked articles too; only noise, which goes anyway, is not told.
    """

    def run(batches):
        for batch in pieces(batches, "html"):
            hosts, nodes, kinds, values, chains = [], [], [], [], []
            for site, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts, layouts, ups = styles(page or "")
                for node, value in texts:
                    hosts.append(site), nodes.append(node), kinds.append(0), values.append(value), chains.append(ups[node])
                for node, value in layouts.items():
                    hosts.append(site), nodes.append(node), kinds.append(1), values.append(value), chains.append(None)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(nodes, pa.int64()), pa.array(kinds, pa.int32()), pa.array(values, pa.int64()), pa.array(chains, pa.list_(pa.int64()))], names=["host", "node", "kind", "value", "chain"])

    return pages.select("host", "html").mapInArrow(run, "host string, node long, kind int, value long, chain array<long>")


def importances(pages: DataFrame, *, gamma: float = 0.9) -> DataFrame:
    """(host, node, n_pages, presentation, content, importance) of each style node.

    Counting is by (host, node, value), combined before the shuffle, so a host with many pages is no large group.
    With m pages: presentation is the entropy, to the base m, of the layouts; content is 1 minus the mean entropy, to the
    base m, of the spread over pages of the distinct texts of each leaf below.  importance = (1 - gamma ** l) * presentation + gamma ** l * content, where
    l is the number of distinct layouts.  A node on one page only has importance 1.
    """
    seen = style_facts(pages).groupBy("host", "node", "kind", "value").agg(F.count(F.lit(1)).alias("n"), F.first("chain").alias("chain"))
    n = F.col("n").cast("double")
    layouts = F.col("kind") == 1
    own = seen.groupBy("host", "node").agg(
        F.sum(F.when(layouts, F.col("n"))).alias("n_pages"),
        F.sum(F.when(layouts, n * F.log(n))).alias("n_log_n"),
        F.count(F.when(layouts, 1)).alias("n_layouts"),
        F.count(F.when(~layouts, 1)).alias("n_texts"),
        F.sum(F.when(~layouts, F.log(n))).alias("text_log"),
        F.first("chain", ignorenulls=True).alias("chain"),
    )
    # a leaf's texts count for each node above it: a row a leaf and ancestor, however many the texts
    ups = F.coalesce("chain", F.array().cast("array<long>"))
    told = own.select("host", F.col("node").alias("__own"), F.explode(F.array_union(F.array("node"), ups)).alias("node"), "n_pages", "n_log_n", "n_layouts", "n_texts", "text_log")
    itself = F.col("node") == F.col("__own")
    total = told.groupBy("host", "node").agg(*[F.sum(F.when(itself, F.col(c))).alias(c) for c in ("n_pages", "n_log_n", "n_layouts")], F.sum("n_texts").alias("n_texts"), F.sum("text_log").alias("text_log"))
    m = F.log(F.col("n_pages").cast("double"))
    presentation = F.when(F.col("n_pages") > 1, (m - F.col("n_log_n") / F.col("n_pages")) / m).otherwise(1.0)
    content = F.when((F.col("n_pages") > 1) & (F.col("n_texts") > 0), F.greatest(F.lit(0.0), 1 - F.col("text_log") / F.col("n_texts") / m)).otherwise(1.0)
    weight = F.pow(F.lit(gamma), F.col("n_layouts").cast("double"))
    return total.select(
        "host", "node", "n_pages", presentation.alias("presentation"), content.alias("content"), ((1 - weight) * presentation + weight * content).alias("importance")
    )


def article(page: str, low: set[int]) -> str:
    """The main text: all blocks outside of noise and of low branches; of these the marked article's only, if there is one.

    A mark that is itself (in) a low branch says one thing and the tree another: what else is left is taken then, and the
    mark's blocks if nothing is, so that copies of one page keep their article.
    """
    found = [b for b in blocks(page, low) if not is_noise(b[0])]
    high = [b for b in found if not (b[0] and b[0].low)]
    if marked := [b for b in found if b[0] and b[0].mark]:
        if any(not b[0].mark.low for b in marked):
            high = [b for b in high if b[0] and b[0].mark]
        else:
            high = high or marked
    return "\n\n".join(b[1] for b in high)


def extract(pages: DataFrame, *, page: str = "html", url: str = "url", keep: list[str] | None = None, out: str = "text", least: float = 0.3, min_pages: int = 5, most_broadcast: int = 200_000) -> DataFrame:
    """The ``keep`` columns (all by default) with the main text in ``out``.

    A null page has an empty text.  Style nodes on ``min_pages`` pages of their host or more whose importance is
    below ``least`` are removed with what is below them.  The list of such nodes is broadcast if it has at most
    ``most_broadcast`` rows, else joined by host.  Repeated rows come back as often as they came.
    """
    keep = [c for c in (pages.columns if keep is None else keep) if c != out]
    source = pages.select(*[pages[f"`{c}`"] for c in keep], host(pages[f"`{url}`"]).alias("__host"), pages[f"`{page}`"].alias("__html"))
    sites = pages.select(host(pages[f"`{url}`"]).alias("host"), pages[f"`{page}`"].alias("html"))
    low = written(importances(sites).filter((F.col("n_pages") >= min_pages) & (F.col("importance") < least)).select("host", "node"), "style-tree")
    n = low.count()
    if n:
        by_host = low.groupBy(F.col("host").alias("__host")).agg(F.collect_set("node").alias("__low"))
        source = source.join(F.broadcast(by_host) if n <= most_broadcast else by_host, "__host", "left")
    else:
        source = source.withColumn("__low", F.array().cast("array<long>"))
    source = source.select(*[f"`{c}`" for c in keep], "__low", "__html")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-2]), f"`{out}` string"])

    def run(batches):
        for batch in pieces(batches, "__html"):
            low = batch.column(batch.num_columns - 2).to_pylist()
            texts = [article(p or "", set(x or ())) for p, x in zip(batch.column(batch.num_columns - 1).to_pylist(), low)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(texts, pa.string())], names=[*keep, out])

    return source.mapInArrow(run, schema)
