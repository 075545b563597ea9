"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded from the root down.

Every element gets features of its own and its subtree (text density, share of link text, tokens of tag, class, id and role,
depth, place among its siblings and how they look). The trees learn from the pages themselves: elements in or outside of an
``article`` or ``main`` element, and those that name themselves as menus, notices and the like, are labelled by that. Half
of the training nodes are seen without their tag and attribute tokens, so that the trees also know pages that name nothing.

Decoding chooses the set of elements with the highest total evidence in which no kept element lies below a dropped one.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.storage import stored

#: Pages that the trees are fitted on, at most: those with the smallest hashes of their content.
TRAIN_PAGES = 1_000
# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math".split())
FOREIGN = frozenset(("svg", "math"))
SWALLOWS = frozenset("script style textarea title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CONTENT = frozenset(("article", "main"))
CHROME = frozenset("nav header footer aside form button select option dialog menu figcaption head fieldset".split())
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLING_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
GOOD_TOKENS = frozenset("article main content post entry story body text".split())
BAD_TOKENS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent copyright disclaimer footer form header hidden login menu modal nav navbar navigation newsletter notice pagination popup promo related search share sharing sidebar signup social sponsor sponsored subscribe tags toolbar widget".split())

_OPEN = re.compile(r"<(?:(!--)|(!\[CDATA\[)|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_STOP = re.compile("[\"'>]")
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_TOKENS = re.compile(r"[a-z]+")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    tokens: frozenset = frozenset()
    children: list = field(default_factory=list)
    own: int = 0  # code points of its own text, and of all below
    size: int = 0
    links: int = 0
    tags: int = 1
    stops: int = 0


def parse(page: str | None) -> tuple[list[Node], list[tuple[int, str]]]:
    """All elements (the first is the root) and (element, text) in page order; a text of "" separates blocks.

    Inline elements that hold no others belong to their parents, but links, which count as elements. Unclosed and
    stray tags are repaired as browsers do in the common cases.
    """
    page = page or ""
    nodes, texts, stack, at = [Node("root", -1, 0)], [], [0], 0
    quoted, last, unended = True, {q: page.rfind(q) for q in "\"'"}, set()

    def add(text: str) -> None:
        if text:
            texts.append((stack[-1], text))

    def close(name: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if nodes[stack[k]].tag == name:
                del stack[k:]
                return

    def tag_end(start: int) -> int:
        """The place behind the tag's ">", which may stand in quotes before; -1 without one.

        A quote without a partner is a character like others. Once quotes have hidden every ">" to the end of the page, they no longer
        count: so no part of a page is read again and again.
        """
        nonlocal quoted
        k = start
        while quoted:
            stop = _STOP.search(page, k)
            if not stop:
                quoted = False
            elif stop.group() == ">":
                return stop.end()
            else:
                k = page.find(stop.group(), stop.end()) + 1 if stop.start() < last[stop.group()] else stop.end()
        return page.find(">", start) + 1 or -1

    while at < len(page):
        tag = _OPEN.search(page, at)
        if not tag:
            add(page[at:])
            break
        add(page[at : tag.start()])
        if tag[1] or tag[2]:
            end = page.find("-->" if tag[1] else "]]>", tag.end())
            if tag[2]:
                add(page[tag.end() : end if end >= 0 else len(page)])
            at = end + 3 if end >= 0 else len(page)
            continue
        name = (tag[4] or "").lower()
        at = tag_end(tag.end()) if name else page.find(">", tag.end()) + 1 or -1
        if at < 0:  # no tag ends from here on
            add(page[tag.start() :])
            break
        if not name:
            continue
        attributes = page[tag.end() : at - 1]
        if name in INLINE and name != "a":
            continue
        texts.append((stack[-1], "" if name != "a" else None))
        if name in VOID:
            continue
        if tag[3]:
            close(name)
            continue
        if name in RAW:
            if name in FOREIGN and attributes.endswith("/"):
                continue
            end = None if name in unended else re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if end:
                at = end.end()
            elif name in SWALLOWS:
                at = len(page)
            else:
                unended.add(name)
            continue
        if name in ENDS_P and any(nodes[i].tag == "p" for i in stack[-4:]):
            close("p")
        if name in SIBLING_ENDS and nodes[stack[-1]].tag in SIBLING_ENDS[name]:
            stack.pop()
        if attributes.endswith("/") and name in ("path", "g"):
            continue
        words = " ".join(a or b or c for _, a, b, c in _ATTRIBUTE.findall(attributes)).lower() if "=" in attributes else ""
        nodes.append(Node(name, stack[-1], len(stack), frozenset(_TOKENS.findall(words))))
        nodes[stack[-1]].children.append(len(nodes) - 1)
        stack.append(len(nodes) - 1)
    return nodes, [(i, t) for i, t in texts if t is not None]


def measure(nodes: list[Node], texts: list[tuple[int, str]]) -> None:
    for i, text in texts:
        n = len(text.strip())
        nodes[i].own += n
        nodes[i].stops += text.count(".") + text.count(",")
    for i in range(len(nodes) - 1, -1, -1):
        node = nodes[i]
        node.size += node.own
        if node.tag == "a":
            node.links = node.size
        if node.parent >= 0:
            up = nodes[node.parent]
            up.size, up.links, up.tags, up.stops = up.size + node.size, up.links + node.links, up.tags + node.tags, up.stops + node.stops


FEATURES = 16


def describe(nodes: list[Node]) -> np.ndarray:
    """One row of features per element; the first four are the named ones (tag and attribute tokens, here and above)."""
    out = np.zeros((len(nodes), FEATURES))
    whole = max(1, nodes[0].size)
    good, bad = [0.0] * len(nodes), [0.0] * len(nodes)
    place = [0.0] * len(nodes)
    before = 0
    for i, node in enumerate(nodes):
        here_good = float(node.tag in CONTENT or bool(node.tokens & GOOD_TOKENS))
        here_bad = float(node.tag in CHROME or bool(node.tokens & BAD_TOKENS))
        if i:
            good[i] = max(good[node.parent] * 0.9, here_good)
            bad[i] = max(bad[node.parent], here_bad)
        place[i] = before / whole
        before += node.own
        up = nodes[node.parent] if i else node
        brothers = max(1, len(up.children))
        out[i] = (
            here_good, here_bad, good[i], bad[i], node.depth, math.log1p(node.size), math.log1p(node.own), node.size / node.tags,
            node.links / max(1, node.size), node.size / whole, place[i], math.log1p(brothers), up.size / max(1, len(up.children)),
            up.links / max(1, up.size), node.stops / max(1, node.size), node.tag in ("p", "h1", "h2", "h3", "blockquote", "pre"),
        )
    return out


NAMED = (0, 1, 2, 3)


def weak_labels(nodes: list[Node]) -> list[int]:
    """1: main text by its own or an enclosing name; 0: named as something else, or outside of it; -1: not to tell."""
    told = any(n.tag in CONTENT for n in nodes)
    out = [-1] * len(nodes)
    for i, node in enumerate(nodes):
        if i:
            bad = node.tag in CHROME or bool(node.tokens & BAD_TOKENS)
            if bad or (out[node.parent] == 0 and node.tag not in CONTENT):
                out[i] = 0
            elif node.tag in CONTENT or out[node.parent] == 1:
                out[i] = 1
            elif told and node.own:
                out[i] = 0
    return out


class Trees:
    """Regression trees as arrays, summed to log-odds."""

    def __init__(self, model=None):
        self.trees = []
        for tree, weight in zip(model.trees, model.treeWeights) if model is not None else ():
            rows: list[list[float]] = []
            self._walk(tree._java_obj.rootNode(), rows)
            self.trees.append((np.array(rows), weight))

    def _walk(self, node, rows: list) -> int:
        at = len(rows)
        rows.append([-1, 0.0, 0, 0, node.prediction()])
        if node.getClass().getSimpleName() == "InternalNode":
            rows[at][:2] = node.split().featureIndex(), node.split().threshold()
            rows[at][2] = self._walk(node.leftChild(), rows)
            rows[at][3] = self._walk(node.rightChild(), rows)
        return at

    def log_odds(self, values: np.ndarray) -> np.ndarray:
        total = np.zeros(len(values))
        for rows, weight in self.trees:
            at = np.zeros(len(values), dtype=int)
            while True:
                dim = rows[at, 0].astype(int)
                inner = dim >= 0
                if not inner.any():
                    break
                left = values[np.arange(len(values)), np.maximum(dim, 0)] <= rows[at, 1]
                at = np.where(inner, np.where(left, rows[at, 2], rows[at, 3]).astype(int), at)
            total += weight * rows[at, 4]
        return 2 * total


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """The elements to keep: the best total evidence such that nothing is kept below a dropped element."""
    value = [0.0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        value[i] += float(odds[i]) * (math.log1p(nodes[i].own) if nodes[i].own else 0.0)
        if nodes[i].parent >= 0 and value[i] > 0:
            value[nodes[i].parent] += value[i]
    keep = [True] * len(nodes)
    for i in range(1, len(nodes)):
        keep[i] = keep[nodes[i].parent] and value[i] > 0
    return keep


def joined(texts: list[tuple[int, str]], keep: list[bool]) -> str:
    """Text of kept elements: references decoded, white space made one space, blocks joined by one space."""
    return " ".join("".join(entities.unescape(t) or " " for i, t in texts if keep[i]).split())


def fit(pages: DataFrame, html: str = "html", train_pages: int = TRAIN_PAGES) -> Trees | None:
    """Trees from weakly labelled elements of at most ``train_pages`` pages; None without both kinds of label."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values, labels = [], []
            for page in batch["html"]:
                nodes, texts = parse(page)
                measure(nodes, texts)
                described, told = describe(nodes), weak_labels(nodes)
                for blind in (False, True):
                    for i, label in enumerate(told):
                        if label >= 0:
                            row = described[i].copy()
                            if blind:
                                row[list(NAMED)] = 0
                            values.append(row.tolist())
                            labels.append(float(label))
            if labels:
                yield pd.DataFrame({"values": values, "label": labels})

    sample = pages.where(F.col(html).isNotNull()).select(F.col(html).alias("html"), F.xxhash64(html).alias("hash"))
    # the hashes alone are ranked; only the chosen pages are moved, each content once
    last = sample.select("hash").distinct().orderBy("hash").limit(train_pages).agg(F.max("hash")).first()[0]
    sample = sample.where(F.col("hash") <= F.lit(last)).groupBy("hash").agg(F.first("html").alias("html"))
    training = stored(sample.repartition(12).mapInPandas(rows, "values array<double>, label double"), "nodes")
    if training.select("label").distinct().count() < 2:
        return None
    ready = training.select(array_to_vector("values").alias("features"), "label")
    return Trees(GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.3, seed=5).fit(ready))


def main_text(pages: DataFrame, html: str = "html", train_pages: int = TRAIN_PAGES) -> DataFrame:
    """All columns but the page's source, with ``text``: its main text, empty if there is none.

    A null or empty page has an empty text. Where no page names its parts, the trees can't learn, and elements are judged by
    text density and links alone. Repeated rows each get their text; an input column ``text`` is replaced.
    """
    trees = fit(pages, html, train_pages)
    others = [c for c in pages.columns if c not in (html, "text")]

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[others].copy()
            found = []
            for first in range(0, len(batch), 256):
                parsed = [parse(page) for page in batch[html].iloc[first : first + 256]]
                for nodes, texts in parsed:
                    measure(nodes, texts)
                values = [describe(nodes) for nodes, _ in parsed]
                stacked = np.concatenate(values)
                if trees is not None:
                    odds = trees.log_odds(stacked)
                else:
                    odds = 3 - 10 * stacked[:, 8] - 4 * stacked[:, 3] + np.minimum(stacked[:, 6], 5) - 3
                for (nodes, texts), part in zip(parsed, np.split(odds, np.cumsum([len(v) for v in values])[:-1])):
                    found.append(joined(texts, decode(nodes, part)))
            out["text"] = found
            yield out

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in pages.schema.fields if f.name in others)
    return pages.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{html}`")).mapInPandas(extract, f"{fields}text string")
