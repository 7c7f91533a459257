"""Main text of web pages by a tree-structured graphical model.

The block elements of a page are the nodes of a tree. Each has a hidden label,
content or not; a log-linear potential scores the label by the node's features
and another one scores each parent-child pair. Sum-product messages run from
the leaves up and from the root down, which gives the exact marginal of every
node; a node's own text belongs to the main text if its marginal is one half
or more.

The weights are trained by gradient ascent on the likelihood of labelled pages:
at most ``TRAIN`` pages whose markup names the article, and variants of them
with other markup and with the other parts that pages have. The gradient is the
difference of observed and expected feature counts, the latter from the same
messages. A Gaussian prior holds the weights near ``PRIOR``, which alone
decides where there are no labelled pages.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from feedmill.llm.common import bounded, slices, small_batches

TRAIN = 96
TRAIN_BYTES = 60_000
ROUNDS = 40
#: Numbers that class, id and role words are hashed to; kinds of parent-child pairs.
TOKENS, KINDS = 256, 3
#: An element with this share of the page's text is no part beside the text, whatever it is called.
MOST_OF_PAGE = 0.5

#: Elements that make blocks, that have no content, and whose content is never text of a page.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot"
    " th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset(
    "audio button canvas datalist head iframe noembed noframes noscript object option script select style svg"
    " template textarea title video xmp".split()
)
#: Those whose content has no markup; without an end tag they take the rest of the page.
RAW = frozenset("noscript script style textarea title xmp".split())
#: An element that closes an open one of its group, unless one of the others stands between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
}
#: What words in class, id and role say about an element.
HINTS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toc pagination pager tabs",
    "side": "sidebar side aside related recommended recommendations widget complementary rail more",
    "foot": "footer foot copyright colophon contentinfo legal",
    "head": "header masthead banner topbar logo site-header",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner-ad adslot",
    "notice": "cookie cookies consent notice popup modal overlay newsletter subscribe alert gdpr paywall disclaimer",
    "talk": "comment comments comment-list reply replies respond disqus discussion reader-comments feedback",
    "input": "form search login signin signup register contact-form input",
    "share": "share sharing social follow tags meta byline",
    "body": "article content main post entry story text body-text article-body post-content entry-content maincontent",
}
WORDS = {w: g for g, words in HINTS.items() for w in words.split()}
#: Beginnings that say the same, whatever follows.
STEMS = {
    w: WORDS[w]
    for w in "comment advert sponsor promo cookie consent newsletter sidebar footer breadcrumb pagination navbar disqus related masthead".split()
}


def _hint(word: str) -> str | None:
    return WORDS.get(word) or next((g for stem, g in STEMS.items() if word.startswith(stem)), None)

#: Where learning starts and what holds for parts that no labelled page has. Groups and tags say less of an element
#: that holds most of the page's text, so those have no prior there.
PRIOR = {
    "bias": -0.5, "tag=article": 1.0, "tag=main": 1.0, "tag=p": 0.5, "tag=h1": 0.5, "tag=h2": 0.3, "tag=h3": 0.3,
    "tag=blockquote": 0.5, "tag=pre": 0.5, "tag=nav": -2.5, "tag=footer": -2.5, "tag=header": -0.5, "tag=aside": -2.5,
    "tag=form": -2.5, "tag=menu": -2.0, "tag=dialog": -2.5, "tag=fieldset": -2.0,
    "hidden": -3.0, "links=most": -2.0, "links=some": -0.5, "size=long": 0.5, "size=none": -0.3,
    **{f"hint={g}": (0.5 if g == "body" else -1.5) for g in HINTS}, "under": -1.5,
    **{f"pair={k}{y}{y}": 0.5 for k in range(KINDS) for y in "01"},
}


@dataclass
class Node:
    tag: str
    parent: int
    attrs: str = ""
    chars: int = 0
    linked: int = 0
    runs: list = field(default_factory=list)  # (place in the page, text)


#: What follows a tag's name: one attribute with what stands before its value, up to an opening quote.
_ATTRIBUTE = re.compile(
    r"""[ \t\n\f\r/]*(?:[^ \t\n\f\r/>][^ \t\n\f\r/>=]*+(?:[ \t\n\f\r]*+=[ \t\n\f\r]*+(?:(["'])|[^ \t\n\f\r>]*+))?+)?+"""
)
_NAME = re.compile(r"[^ \t\n\f\r/>]*+")


def tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """The place of the ``>`` that ends the tag whose name starts at ``at``, or -1. Reads each character once.

    Only a quote that opens an attribute's value holds a ``>``; one that is
    never closed is a character like any other. ``last`` has the place of the
    last quote of either kind, filled when it is first needed.
    """
    at = _NAME.match(page, at).end()
    while True:
        found = _ATTRIBUTE.match(page, at)
        at = found.end()
        quote = found.group(1)
        if quote:
            if quote not in last:
                last[quote] = page.rfind(quote)
            if last[quote] >= at:
                at = page.find(quote, at) + 1
        elif at >= len(page):
            return -1
        elif page[at] == ">":
            return at


def _partners(low: str, tag: str) -> dict[int, int]:
    """Where each element of a name ends, by where it starts; an end tag belongs to the last one still open."""
    out, opened = {}, []
    for found in re.finditer(rf"<(/?){tag}(?![a-z0-9:-])", low):
        if not found.group(1):
            opened.append(found.start())
        elif opened:
            out[opened.pop()] = found.start()
    return out


def parse(page: str) -> list[Node]:
    """The block elements in page order, a root first. Parents come before their children. Linear in the page."""
    nodes, stack = [Node("root", -1)], [0]
    # How many elements of a name are open: without one, the stack need not be searched.
    opened: dict[str, int] = {}
    low = page.lower() if page.isascii() else re.sub("[A-Z]+", lambda m: m.group().lower(), page)
    buffer: list[str] = []
    links, place, at, end = 0, 0, 0, len(page)
    link_text = 0
    quotes: dict[str, int] = {}
    partners: dict[str, dict[int, int]] = {}

    def shut(depth: int) -> None:
        for i in stack[depth:]:
            opened[nodes[i].tag] -= 1
        del stack[depth:]

    def flush() -> None:
        nonlocal place, link_text
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                node = nodes[stack[-1]]
                node.runs.append((place, text))
                node.chars += len(text)
                node.linked += min(link_text, len(text))
                place += 1
        link_text = 0

    while at < end:
        start = page.find("<", at)
        if start < 0:
            start = end
        if start > at:
            buffer.append(page[at:start])
            if links:
                link_text += len(page[at:start].strip())
        if start == end:
            break
        lead = page[start + 1 : start + 2]
        if page.startswith("<!--", start):
            stop = page.find("-->", start + 4)
            at = end if stop < 0 else stop + 3
            continue
        if not (lead.isalpha() and lead.isascii()) and lead not in ("/", "!", "?"):
            buffer.append("<")
            at = start + 1
            continue
        name = start + 1 + (lead == "/")
        is_tag = page[name : name + 1].isalpha() and page[name].isascii()
        stop = tag_end(page, name, quotes) if is_tag else page.find(">", start)
        if stop < 0:
            break
        body = page[start + 1 : stop]
        at = stop + 1
        if lead in "!?":
            continue
        closing = lead == "/"
        found = re.match(r"/?([A-Za-z][A-Za-z0-9:-]*)", body)
        if not found:
            continue
        tag = found.group(1).lower()
        if tag in SILENT:
            if not closing and not body.endswith("/"):
                if tag == "head":
                    after = low.find("</head", at)
                    # A head without an end stops at the body.
                    body_at = low.find("<body", at)
                    after = body_at if after < 0 or 0 <= body_at < after else after
                    at = after if after >= 0 else at
                elif tag in RAW:
                    close = page.find(">", after) if (after := low.find(f"</{tag}", at)) >= 0 else -1
                    at = close + 1 if close >= 0 else end
                else:
                    if tag not in partners:
                        partners[tag] = _partners(low, tag)
                    after = partners[tag].get(start, -1)
                    close = page.find(">", after) if after >= 0 else -1
                    # Without an end tag of its own, only the tag is passed over.
                    at = close + 1 if close >= 0 else at
            continue
        if tag == "br":
            buffer.append(" ")
            continue
        if tag == "a":
            links = 0 if closing else 1
            continue
        if tag not in BLOCKS:
            continue
        flush()
        if closing:
            if opened.get(tag):
                for depth in range(len(stack) - 1, 0, -1):
                    if nodes[stack[depth]].tag == tag:
                        shut(depth)
                        break
            continue
        links = 0
        if nodes[stack[-1]].tag == "p":
            shut(len(stack) - 1)
        closes, fence = CLOSES.get(tag, ((), ()))
        if any(opened.get(name) for name in closes):
            for depth in range(len(stack) - 1, 0, -1):
                name = nodes[stack[depth]].tag
                if name in fence:
                    break
                if name in closes:
                    shut(depth)
                    break
        nodes.append(Node(tag, stack[-1], body[len(tag) :]))
        if tag not in VOID:
            stack.append(len(nodes) - 1)
            opened[tag] = opened.get(tag, 0) + 1
    flush()
    return nodes


_NAMES = re.compile(r"""(?:class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)


def _step(value: float, *bounds: float) -> int:
    return sum(value >= b for b in bounds)


def features(nodes: list[Node]) -> list[list[str]]:
    """The names of the features that hold for each node: tag, words of its attributes, text, links, place and company."""
    chars, linked = [n.chars for n in nodes], [n.linked for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        chars[nodes[i].parent] += chars[i]
        linked[nodes[i].parent] += linked[i]
    texts: dict[tuple[int, str], int] = {}
    for n in nodes:
        if n.chars >= 80 and n.parent >= 0:
            texts[n.parent, n.tag] = texts.get((n.parent, n.tag), 0) + 1
    out: list[list[str]] = []
    # Whether an element above is named as a part beside the text.
    beside, most, seen = [False] * len(nodes), MOST_OF_PAGE * chars[0], 0
    for i, n in enumerate(nodes):
        large = chars[i] > most
        f = ["bias", f"tag={n.tag}@large" if large else f"tag={n.tag}"]
        groups = set()
        if n.attrs:
            for value in _NAMES.findall(n.attrs):
                for word in value.strip("\"'").lower().split():
                    f.append(f"word={crc32(word.encode()) % TOKENS}")
                    for part in {word, *re.split(r"[-_]", word)}:
                        if group := _hint(part):
                            groups.add(group)
            style = n.attrs.lower()
            if "display:none" in style.replace(" ", "") or re.search(r"\bhidden\b", style):
                f.append("hidden")
        f += [f"hint={g}@large" if large else f"hint={g}" for g in sorted(groups)]
        share = linked[i] / chars[i] if chars[i] else 0.0
        f.append("links=most" if share > 0.5 else "links=some" if share > 0.2 else "links=few")
        f.append("size=none" if not chars[i] else "size=short" if chars[i] < 40 else "size=middle" if chars[i] < 200 else "size=long")
        if n.chars:
            text = n.runs[0][1]
            f.append(f"own={_step(n.chars, 25, 80, 200, 600)}")
            f.append("sentence" if any(c in text for c in ".!?") and n.chars >= 40 else "no sentence")
            f.append(f"like={_step(texts.get((n.parent, n.tag), 0), 1, 2, 4)}")
            # How much of the page's text stands before it.
            f.append(f"place={_step(seen / (chars[0] or 1), 0.02, 0.2, 0.8, 0.98)}")
            if n.parent < 0:
                f.append("loose")
                if len(nodes) == 1:
                    f.append("no markup")
            seen += n.chars
        named = not large and (bool(groups - {"body"}) or n.tag in ("nav", "footer", "aside", "form", "dialog", "menu"))
        if n.parent >= 0 and beside[n.parent]:
            f.append("under")
        beside[i] = named or (n.parent >= 0 and beside[n.parent])
        out.append(f)
    return out


def kinds(nodes: list[Node]) -> list[int]:
    """The kind of pair that each node makes with its parent: a container below, text below a bare parent, text below text."""
    return [0 if not n.chars else 1 if n.parent < 0 or not nodes[n.parent].chars else 2 for n in nodes]


def _log_add(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def marginals(
    parents: list[int], scores: list[float], pair: list[float], kind: list[int] | None = None
) -> tuple[list[float], list[float]]:
    """Sum-product on the tree: P(label 1) per node, and the expected number of each parent-child label pair.

    ``scores`` are log-odds of label 1, ``pair`` log potentials in the order 00, 01, 10, 11 (parent first),
    four for each kind of pair; ``kind`` names the one of a node and its parent.
    """
    n = len(parents)
    kind = kind or [0] * n
    of = [tuple(pair[k : k + 4]) for k in range(0, len(pair), 4)]
    up0, up1 = [0.0] * n, list(scores)
    msg: list[tuple[float, float]] = [(0.0, 0.0)] * n
    for i in range(n - 1, 0, -1):
        p00, p01, p10, p11 = of[kind[i]]
        m = (_log_add(p00 + up0[i], p01 + up1[i]), _log_add(p10 + up0[i], p11 + up1[i]))
        msg[i] = m
        up0[parents[i]] += m[0]
        up1[parents[i]] += m[1]
    total0, total1 = up0[:], up1[:]
    expected = [0.0] * len(pair)
    chance = [0.0] * n
    for i in range(n):
        if i:
            q = parents[i]
            p00, p01, p10, p11 = of[kind[i]]
            # All that the parent knows but for this child.
            a0, a1 = total0[q] - msg[i][0], total1[q] - msg[i][1]
            joint = (a0 + p00 + up0[i], a0 + p01 + up1[i], a1 + p10 + up0[i], a1 + p11 + up1[i])
            top = max(joint)
            parts = [math.exp(v - top) for v in joint]
            all_parts = sum(parts)
            for k in range(4):
                expected[4 * kind[i] + k] += parts[k] / all_parts
            total0[i] = up0[i] + _log_add(a0 + p00, a1 + p10)
            total1[i] = up1[i] + _log_add(a0 + p01, a1 + p11)
        d = total1[i] - total0[i]
        chance[i] = 1.0 / (1.0 + math.exp(-d)) if d > -700 else 0.0
    return chance, expected


PAIRS = [f"pair={k}{x}{y}" for k in range(KINDS) for x in "01" for y in "01"]


def train(pages: list[tuple[list[Node], list[int]]], rounds: int = ROUNDS, spread: float = 1.0) -> dict[str, float]:
    """Weights of largest posterior for ``(nodes, labels)`` pages; ``PRIOR`` without any."""
    known = [(features(nodes), [n.parent for n in nodes], kinds(nodes), labels) for nodes, labels in pages]
    names = sorted({f for fs, _, _, _ in known for row in fs for f in row} | set(PRIOR) | set(PAIRS))
    place = {f: i for i, f in enumerate(names)}
    prior = np.array([PRIOR.get(f, 0.0) for f in names])
    coded = []
    pairs = np.array([place[p] for p in PAIRS])
    seen = np.zeros(len(names))
    for fs, parents, kind, labels in known:
        flat = np.array([place[f] for row in fs for f in row])
        sizes = np.array([len(row) for row in fs])
        starts = np.cumsum([0, *sizes[:-1]])
        coded.append((flat, sizes, starts, parents, kind, np.array(labels, float)))
        for i in range(1, len(parents)):
            seen[pairs[4 * kind[i] + 2 * labels[parents[i]] + labels[i]]] += 1
    weight, speed = prior.copy(), np.full(len(names), 1e-6)
    for _ in range(rounds if coded else 0):
        slope = (prior - weight) / (spread**2) + seen
        pair = weight[pairs].tolist()
        for flat, sizes, starts, parents, kind, y in coded:
            chance, expected = marginals(parents, np.add.reduceat(weight[flat], starts).tolist(), pair, kind)
            np.add.at(slope, flat, np.repeat(y - np.array(chance), sizes))
            slope[pairs] -= expected
        speed += slope**2
        weight += 0.5 * slope / np.sqrt(speed)
    return {f: float(w) for f, w in zip(names, weight)}


#: Elements that are no content where they stand inside the article.
ASIDE = ("nav", "aside", "footer", "form")


def labelled(page: str) -> tuple[list[Node], list[int]] | None:
    """Nodes and labels of a page whose markup names one article; parts of other kinds in it are not content."""
    nodes = parse(page)
    if sum(n.tag == "article" for n in nodes) != 1:
        return None
    labels: list[int] = []
    for n in nodes:
        above = n.parent >= 0 and labels[n.parent]
        named = not above or not n.attrs or not any(_hint(w) not in (None, "body") for v in _NAMES.findall(n.attrs) for w in v.strip("\"'").lower().split())
        labels.append(int((n.tag == "article") or (above and n.tag not in ASIDE and named)))
    return nodes, labels


_MARK, _OTHER = "data-main=1", "data-other=1"


def _marked(page: str, drop_names: bool = False) -> tuple[list[Node], list[int]]:
    """Nodes and labels of a page whose article and whose other parts inside it are marked."""
    nodes = parse(page)
    labels: list[int] = []
    for n in nodes:
        above = n.parent >= 0 and labels[n.parent]
        other = n.tag in ASIDE or _OTHER in n.attrs
        labels.append(int(_MARK in n.attrs or bool(above and not other)))
    for n in nodes:
        n.attrs = "" if drop_names else n.attrs.replace(_MARK, "").replace(_OTHER, "")
    return nodes, labels


def variants(page: str, number: int) -> list[tuple[list[Node], list[int]]]:
    """The labelled page and variants of it, each with other markup: no article element, paragraphs in other
    elements, misleading names of the article, a header and a byline in it, no names at all, no markup at all,
    and with other parts around and inside it.

    Parts take words of the article itself, so that their markup and place tell them apart, not their words.
    """
    first = labelled(page)
    found = re.search(r"<article[^>]*>(.*)</article\s*>", page, flags=re.I | re.S)
    words = " ".join(t for n in first[0] for _, t in n.runs).split() if first else []
    if not found or not words:
        return [first] if first else []
    # Names of parts inside the article must not be taken for text of the variants.
    inner = re.sub(r"<(div|section|ul|p)(\s[^>]*(?:class|id)\s*=[^>]*)>", rf"<\1\2 {_OTHER}>", found.group(1), flags=re.I)
    before, after = page[: found.start()], page[found.end() :]
    some = lambda k, size: " ".join(words[(number * 31 + k * 17 + j) % len(words)] for j in range(size))
    parts = [
        f"<header class='site-header'><div>{some(1, 6)}</div></header>",
        f"<aside class='sidebar'><h3>{some(2, 3)}</h3><p>{some(3, 30)}</p></aside>",
        f"<div class='comments' {_OTHER}><h3>{some(4, 2)}</h3><div class='comment'><p>{some(5, 40)}</p></div><p>{some(6, 25)}</p></div>",
        f"<div id='cookie-notice' {_OTHER}><p>{some(7, 20)}</p></div>",
        f"<form action='/s'><p>{some(8, 8)}</p><label>{some(9, 2)}</label></form>",
        f"<section class='related' {_OTHER}><ul><li><a href='/x'>{some(10, 5)}</a></li></ul><p>{some(11, 18)}</p></section>",
        f"<div class='advert' {_OTHER}><p>{some(12, 15)}</p></div>",
        f"<div class='share' {_OTHER}>{some(13, 4)}</div>",
    ]
    pick = [parts[(number + k) % len(parts)] for k in range(4)]
    box = ["div class='post-content'", "main", "section id='content'", "div", "div class='entry'", "article"][number % 6]
    odd = [
        "article class='post comments-open'", "div class='post has-sidebar ad-free'", "section class='article related-posts-on'",
        "article class='entry no-cookie share-bottom'", "main class='with-menu content'", "div id='main' class='story subscribe-wall-off'",
    ][number % 6]
    plain = ["div", "section", "article", "main"][number % 4]

    def page_of(box: str, body: str, inside: str = "", around: tuple[str, str] = ("", "")) -> str:
        return f"{before}{around[0]}<{box} {_MARK}>{body}{inside}</{box.split()[0]}>{around[1]}{after}"

    boxed = re.sub(r"<(/?)p(?=[\s>])", r"<\1div", inner, flags=re.I)
    heading = f"<header><h2>{some(14, 7)}</h2><p>{some(15, 4)}</p></header>"
    made = [
        _marked(page_of(box, inner, pick[1], (pick[0], pick[2] + pick[3]))),
        _marked(page_of(odd, heading + inner, pick[2], (pick[0], pick[3]))),
        _marked(page_of(plain, boxed, "", (pick[0], pick[1]))),
        _marked(page_of(odd if number % 2 else "div", boxed if number % 3 else heading + inner), drop_names=number % 2 == 0),
    ]
    if number % 4 == 0:
        bare = parse(" ".join(words))
        made.append((bare, [1] * len(bare)))
    return [first, *made]


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The blocks of the nodes whose marginal is one half or more, in page order."""
    if not page:
        return ""
    nodes = parse(page)
    get = weights.get
    scores = [sum(get(f, 0.0) for f in row) for row in features(nodes)]
    chance, _ = marginals([n.parent for n in nodes], scores, [weights[p] for p in PAIRS], kinds(nodes))
    runs = sorted(r for n, p in zip(nodes, chance) if p >= 0.5 for r in n.runs)
    return "\n\n".join(text for _, text in runs)


def fit(pages: DataFrame, key: str = "page_id", html: str = "html", most: int = TRAIN) -> dict[str, float]:
    """Weights from at most ``most`` labelled pages of up to ``TRAIN_BYTES`` bytes, the same ones in every run."""
    body = F.col(html)
    known = pages.filter(F.contains(F.lower(body), F.lit("<article")) & (F.octet_length(body) <= TRAIN_BYTES))
    picked = bounded(known.select(F.col(key).alias("_key"), body.alias("_html")), ["_key", "_html"], most).select("_html").collect()
    return train([v for i, r in enumerate(picked) for v in variants(r[0], i)])


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(key, url, text, n_chars)`` per row. Null and empty pages have an empty text. Repeated rows stay repeated."""
    weights = fit(pages, key, html)
    small_batches(pages.sparkSession)
    slim = pages.select(key, url, F.col(html).cast("string").alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(page, weights) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[key, url, "text", "n_chars"],
            )

    schema = StructType([slim.schema[key], slim.schema[url], StructField("text", StringType()), StructField("n_chars", LongType())])
    return slim.mapInArrow(run, schema)
