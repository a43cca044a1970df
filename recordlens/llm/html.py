"""Main text of web pages with a tree-structured graphical model.

A page is parsed to a tree of block elements.  Every node has a hidden state,
content or boilerplate.  Node potentials come from the node's tag, class and id
words, own text and links; parent-child potentials connect a node's state to its
parent's.  Sum-product message passing, upward and then downward, gives each
node's content marginal; the text of nodes with a marginal of one half or more
is the main text, block by block in page order.

Potentials are counts over labelled pages (at most ``SAMPLE_PAGES``, chosen by a
hash over the whole table): a page is labelled if the document that its address
names is known, and a block is content if it is one of the document's lines or a
long enough part of it.  Pseudo-counts for well-known boilerplate tags and class
words stand in for templates that no labelled page has.

Nulls: a null page is empty and has no text.  Repeated rows keep their rows.
Broken markup is read as browsers do in the common cases; nothing is dropped but
scripts, styles, comments and boilerplate.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from recordlens.llm.common import batches, bounded_batches

SAMPLE_PAGES = 600
LONG_ENOUGH = 20        # characters from which a part of a document's line counts as its text
#: Bounds of a feature's log ratio by its kind: the templates of the labelled pages must not
#: outweigh what is known of boilerplate, or decide on a tag alone.
BOUND = {"tag": 1.0, "word": 2.0, "kids": 0.5, "size": 1.5, "link": 1.5, "known": 6.0}

#: Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var wbr br img".split())
RAW = frozenset("script style noscript template textarea iframe svg object canvas title head select option button".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
                     "hgroup hr main menu nav ol p pre section table ul".split())
SAME_LEVEL = {"li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr", "td", "th"}),
              "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"})}
SCOPE = {"li": frozenset({"ul", "ol", "menu"}), "dt": frozenset({"dl"}), "dd": frozenset({"dl"}), "tr": frozenset({"table"}),
         "td": frozenset({"table", "tr"}), "th": frozenset({"table", "tr"})}
#: Tags and class words with a meaning of their own.
BOILERPLATE_TAGS = frozenset("nav aside footer header form menu dialog fieldset".split())
CONTENT_TAGS = frozenset("article main".split())
PAGE_TAGS = frozenset("#root html body".split())       # hold everything: content by definition
BOILERPLATE_WORDS = frozenset("ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner sidebar side menu nav "
                              "navigation navbar breadcrumb breadcrumbs comment comments reply replies respond disqus footer header masthead "
                              "cookie cookies consent notice notices gdpr privacy alert popup modal overlay subscribe newsletter signup "
                              "share sharing social related recommended widget toolbar pagination pager login copyright legal".split())
CONTENT_WORDS = frozenset("article content entry post body story main text".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

_MARKUP = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORD = re.compile(r"[a-z]+")


@dataclass
class Node:
    parent: int
    tag: str
    words: frozenset[str]
    chars: int = 0
    linked: int = 0


@dataclass
class Page:
    nodes: list[Node]
    blocks: list[tuple[int, str]]       # (node, text) in page order


def parse(source: str) -> Page:
    """Tree of block elements and the text blocks between their edges."""
    nodes, blocks = [Node(-1, "#root", frozenset())], []
    stack: list[tuple[str, int]] = [("#root", 0)]      # open elements; inline ones belong to their block's node
    pieces: list[str] = []
    links = 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            blocks.append((stack[-1][1], text))
            nodes[stack[-1][1]].chars += len(text)

    def add(text: str) -> None:
        pieces.append(text)
        if links:
            nodes[stack[-1][1]].linked += len(text)

    def close(depth: int) -> None:
        nonlocal links
        if any(t not in INLINE for t, _ in stack[depth:]):
            flush()
        links -= sum(t == "a" for t, _ in stack[depth:])
        del stack[depth:]

    def close_open(tags: frozenset[str], stop: frozenset[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in tags:
                return close(depth)
            if stack[depth][0] in stop:
                return None

    at = 0
    while m := _MARKUP.search(source, at):
        if m.start() > at:
            add(source[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "br":
                add(" ")
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
                if tag in INLINE and stack[depth][0] not in INLINE:
                    break                               # an inline end tag does not close blocks
            continue
        if tag in RAW and not m[3].rstrip().endswith("/"):
            end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(source, at)
            if tag == "head":                           # metadata; a page without an end tag ends its head at the body
                end = end or re.compile(r"(?=<body\b)", re.IGNORECASE).search(source, at)
                if not end:
                    continue
            at = end.end() if end else len(source)
            continue
        if tag in VOID:
            if tag == "br":
                add(" ")
            elif tag not in INLINE:
                flush()
            continue
        if tag in CLOSES_P:
            close_open(frozenset({"p"}), frozenset({"table", "button", "td", "th"}))
        if tag in SAME_LEVEL:
            close_open(SAME_LEVEL[tag], SCOPE[tag])
        if tag in INLINE:
            if tag == "a":
                links += 1
            stack.append((tag, stack[-1][1]))
            continue
        flush()
        words: set[str] = set()
        for name, *value in _ATTRIBUTE.findall(m[3]):
            name, value = name.lower(), "".join(value).lower()
            if name in ("class", "id", "role"):
                words.update(_WORD.findall(value))
            elif name == "style" and HIDDEN.search(value):
                words.add("#hidden")
        nodes.append(Node(stack[-1][1], tag, frozenset(words)))
        if not m[3].rstrip().endswith("/"):
            stack.append((tag, len(nodes) - 1))
    if at < len(source):
        add(source[at:])
    flush()
    return Page(nodes, blocks)


def node_features(node: Node, children: int) -> list[str]:
    found = [f"tag:{node.tag}", f"kids:{min(children, 3)}"]
    for w in node.words:
        found.append(f"word:{w}")
        if w in BOILERPLATE_WORDS or w == "#hidden":
            found.append("known:boilerplate")
        elif w in CONTENT_WORDS:
            found.append("known:content")
    if node.tag in BOILERPLATE_TAGS:
        found.append("known:boilerplate")
    elif node.tag in CONTENT_TAGS:
        found.append("known:content")
    elif node.tag in PAGE_TAGS:
        found.append("known:page")
    if node.chars:
        found.append(f"size:{min(int(math.log2(node.chars)) // 3, 3)}")
        found.append(f"link:{min(4 * node.linked // node.chars, 4)}")
    return found


@dataclass
class Potentials:
    """Log ratios content : boilerplate of the node features, and P(state | parent's state)."""

    feature: dict[str, float]
    given: tuple[float, float]       # P(content | parent boilerplate), P(content | parent content)
    root: float

    def marginals(self, page: Page) -> list[float]:
        """P(content) of every node, by sum-product; parents come before their children."""
        nodes, (from_b, from_c) = page.nodes, self.given
        kids = [0] * len(nodes)
        for n in nodes[1:]:
            kids[n.parent] += 1
        own = []
        for n, k in zip(nodes, kids):
            total = sum(self.feature.get(f, 0.0) for f in node_features(n, k))
            own.append(math.exp(max(-30.0, min(30.0, total))))
        # Messages and beliefs are kept as ratios content : boilerplate.
        up, message = own[:], [1.0] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):
            b = up[i]
            message[i] = (from_c * b + 1 - from_c) / (from_b * b + 1 - from_b)
            up[nodes[i].parent] = max(1e-30, min(1e30, up[nodes[i].parent] * message[i]))
        belief = up[:]
        belief[0] *= self.root / (1 - self.root)
        for i in range(1, len(nodes)):
            cavity = belief[nodes[i].parent] / message[i]
            down = (from_c * cavity + from_b) / ((1 - from_c) * cavity + 1 - from_b)
            belief[i] = max(1e-30, min(1e30, up[i] * down))
        return [b / (1 + b) for b in belief]

    def text(self, source: str | None) -> tuple[str, int, int]:
        """(main text, blocks, kept blocks)."""
        page = parse(source or "")
        p = self.marginals(page)
        kept = [t for n, t in page.blocks if p[n] >= 0.5]
        return " ".join(kept), len(page.blocks), len(kept)


def label(page: Page, document: str) -> list[bool]:
    """Per node: content if most of its text, or else of the text below it, is the document's."""
    lines = {" ".join(x.split()) for x in document.split("\n")}
    whole = " ".join(document.split())
    good, every = [0] * len(page.nodes), [0] * len(page.nodes)
    for n, t in page.blocks:
        every[n] += len(t)
        if t in lines or len(t) >= LONG_ENOUGH and t in whole:
            good[n] += len(t)
    result = [2 * g > e for g, e in zip(good, every)]
    own = [e > 0 for e in every]
    for i in range(len(page.nodes) - 1, -1, -1):
        if i:
            good[page.nodes[i].parent] += good[i]
            every[page.nodes[i].parent] += every[i]
        if not own[i]:
            result[i] = 2 * good[i] > every[i]
    return result


def fit(examples: list[tuple[str, str]]) -> Potentials:
    """Potentials counted over (page, document) pairs; works without any."""
    count = {s: defaultdict(float) for s in (False, True)}
    total = {False: 1.0, True: 1.0}
    edge = {(p, c): 0.0 for p in (False, True) for c in (False, True)}
    for source, document in examples:
        page = parse(source)
        states = label(page, document)
        kids = [0] * len(page.nodes)
        for n in page.nodes[1:]:
            kids[n.parent] += 1
        for n, s, k in zip(page.nodes, states, kids):
            total[s] += 1
            for f in node_features(n, k):
                count[s][f] += 1
            if n.parent >= 0:
                edge[states[n.parent], s] += 1
    # Pseudo-counts: what class words and tags mean, and that children follow their parent.
    weight = max(20.0, 0.02 * sum(total.values()))
    count[False]["known:boilerplate"] += weight
    count[True]["known:content"] += weight
    edge = {k: v + {(False, False): 49.0, (False, True): 1.0, (True, False): 5.0, (True, True): 45.0}[k] for k, v in edge.items()}
    both = sum(total.values())
    ratio = {}
    for f in {*count[False], *count[True]}:
        good, bad = count[True][f], count[False][f]
        # Smoothed towards no opinion: a rare feature says little.
        value = math.log((good + 2 * total[True] / both) / (total[True] + 2)) - math.log((bad + 2 * total[False] / both) / (total[False] + 2))
        bound = BOUND[f.partition(":")[0]]
        ratio[f] = max(-bound, min(bound, value))
    ratio["known:page"] = 30.0
    given = tuple(edge[p, True] / (edge[p, True] + edge[p, False]) for p in (False, True))
    return Potentials(ratio, given, 0.9)


def train(pages: DataFrame, documents: DataFrame, *, page_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          id_col: str = "doc_id", text_col: str = "text", sample_pages: int = SAMPLE_PAGES) -> Potentials:
    """Fit on at most ``sample_pages`` labelled pages; the document is named by the number in the page's address."""
    known = pages.select(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[a-z]+://[^/]+/[a-z]{2}/([0-9]{1,15})", 1).alias("n"),
                         F.col(html_col).alias("html"), F.xxhash64(F.col(page_col), F.lit("html")).alias("pick"))
    known = known.where("n <> '' and html is not null")
    share = min(1.0, 2 * sample_pages / max(pages.count(), 1))
    near = known.where(F.pmod("pick", F.lit(1 << 20)) < math.ceil(share * (1 << 20))).orderBy("pick").limit(sample_pages)
    named = documents.select(F.col(id_col).cast("bigint").alias("d"), F.col(text_col).alias("text")).where("text is not null")
    rows = near.join(named, F.col("n").cast("bigint") == F.col("d")).orderBy("pick", "text").limit(sample_pages).collect()
    return fit([(r["html"], r["text"]) for r in rows])


def extract(pages: DataFrame, model: Potentials, *, page_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars, n_blocks, n_kept_blocks."""
    bounded_batches(pages.sparkSession)
    own = pages.select(F.col(page_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(rows):
            text, every, kept = zip(*(model.text(h) for h in b.column(2).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64()), pa.array(every, pa.int64()),
                 pa.array(kept, pa.int64())], names=["page_id", "url", "text", "n_chars", "n_blocks", "n_kept_blocks"])

    return own.mapInArrow(run, StructType([
        StructField("page_id", own.schema["page_id"].dataType), StructField("url", own.schema["url"].dataType), StructField("text", StringType()),
        StructField("n_chars", LongType()), StructField("n_blocks", LongType()), StructField("n_kept_blocks", LongType())]))
