"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the document tree.

A page becomes the sequence of its leaf blocks, runs of text between block-level borders, each with its ancestors.
Features are ancestor tags, what the words of ancestors' classes and ids stand for, and the text itself. The chain
is trained on labelled pages, composed from text of a bounded sample of the input in many layouts, and decoded by
Viterbi. Extraction is one narrow stage: a page is parsed, decoded and joined where it is read.

Defined results. Null html is an empty page with empty text. Character references are decoded, white space inside
a block becomes one space, blocks are joined by one line feed. Nothing of a chosen block is dropped or capped.
Repeated rows are extracted each for itself. A null url stays null. An empty table gives an empty result; other columns
of the input are ignored. Pages of any length and depth are read whole, in memory that grows with their length.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# Tags that begin and end a block, tags whose content is no text, tags without content.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HIDDEN = frozenset("head script style noscript template title textarea select option button svg math iframe object canvas audio video".split())
RAW = frozenset("script style title textarea iframe noscript".split())
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# A start tag on the left ends an open element on the right, if none of the borders lies between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
ENDS_P = BLOCKS - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
# What words in classes, ids and roles stand for.
MEANINGS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager tabs toc skip topnav",
    "header": "header masthead banner topbar logo branding tagline",
    "footer": "footer colophon copyright legal bottom contentinfo",
    "side": "sidebar aside side rail widget widgets complementary secondary related recommended recommendations more popular trending",
    "advert": "ad ads adv advert advertisement advertising sponsor sponsored promo promotion promoted dfp adsense",
    "notice": "cookie cookies consent gdpr notice notification alert popup modal overlay dialog disclaimer paywall",
    "form": "form search login signup signin subscribe subscription newsletter register contact",
    "comment": "comment comments commentlist reply replies respond disqus discussion reader readers feedback responses",
    "social": "share sharing social follow buttons tweet facebook twitter",
    "meta": "meta byline author date tags tag category categories timestamp info credit",
    "content": "content article post entry story main body text page blog copy prose document output paragraph",
}
MEANING = {word: kind for kind, words in MEANINGS.items() for word in words.split()}
# Phrases of page furniture.
PHRASES = {
    "rights": ("©", "copyright", "all rights reserved", "privacy policy", "terms of"),
    "cookies": ("cookie", "consent", "gdpr"),
    "sign": ("subscribe", "newsletter", "sign up", "sign in", "log in", "register", "e-mail", "email"),
    "advert": ("advert", "sponsored", "promoted", "special offer"),
    "social": ("share", "follow us", "facebook", "twitter"),
    "comment": ("comment", "reply", "posted by", "says:"),
    "more": ("read more", "related", "you may also", "most popular", "skip to"),
}

#: Kinds of blocks that are never main text in composed pages.
FURNITURE = frozenset(("advert", "comment", "notice", "footer", "menu", "side", "social"))

_TAG = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@lru_cache(4096)
def _meanings(attributes: str) -> frozenset[str]:
    found = set()
    for m in _ATTRIBUTE.finditer(attributes):
        for word in _WORD.findall(m[2] or m[3] or m[4] or ""):
            if kind := MEANING.get(word.lower()):
                found.add(kind)
    return frozenset(found)


class Place(NamedTuple):
    """An open element and what it and its ancestors say, so deep nesting costs no more than its distinct tags."""

    tag: str
    block: str  # nearest block
    tags: frozenset[str]
    kinds: frozenset[str]  # what classes and ids of all of them stand for
    near: frozenset[str]  # the nearest that stand for something

    def inner(self, tag: str, own: frozenset[str]) -> Place:
        tags = self.tags if tag in self.tags else self.tags | {tag}
        return Place(tag, tag if tag in BLOCKS else self.block, tags, self.kinds if own <= self.kinds else self.kinds | own, own or self.near)


ROOT = Place("", "none", frozenset(), frozenset(), frozenset())


class Leaf(NamedTuple):
    """A run of text between block borders. linked: its characters inside links."""

    text: str
    linked: int
    place: Place


def leaves(page: str) -> list[Leaf]:
    """The leaf blocks of a page in order; unclosed elements end where HTML ends them."""
    found: list[Leaf] = []
    stack: list[Place] = []
    parts: list[str] = []
    linked = hidden = links = at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                found.append(Leaf(text, linked, stack[-1] if stack else ROOT))
            parts.clear()
        linked = 0

    def pop() -> None:
        nonlocal hidden, links
        tag = stack.pop().tag
        hidden -= tag in HIDDEN
        links -= tag == "a"

    def end_head() -> None:
        """Of what may not stand in a head, the first ends it, as </head> and <body> need not be written."""
        if stack and stack[-1].tag == "head":
            pop()

    def close(tags, borders) -> None:
        if not stack or tags.isdisjoint(stack[-1].tags):
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].tag in tags:
                flush()
                while len(stack) > k:
                    pop()
                return
            if stack[k].tag in borders:
                return

    def add(text: str) -> None:
        nonlocal linked
        if hidden and text.strip(" \t\n\r\f"):
            end_head()
        if text and not hidden:
            parts.append(html.unescape(text))  # a reference never goes on behind a tag
            if links:
                linked += len(text)

    size = len(page)
    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag, end, attributes = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        if end:
            if tag in BLOCKS:
                flush()
            if stack and tag in stack[-1].tags:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag == tag:
                        while len(stack) > k:
                            pop()
                        break
                    if tag not in BLOCKS and stack[k].tag in BLOCKS:  # the end of an inline element ends no block
                        break
            continue
        if tag not in IN_HEAD:
            end_head()
        if tag in RAW:
            stop = re.compile(f"</{tag}", re.I).search(page, at)
            at = stop.start() if stop else size
        if tag == "br":
            add(" ")
        if tag in BLOCKS:
            flush()
            if tag in ENDS_P:
                close({"p"}, BLOCKS - {"p"})
            if tag in CLOSES:
                close(*CLOSES[tag])
        if tag == "body":  # an open head ends here
            while stack and "head" in stack[-1].tags:
                pop()
        if tag not in VOID and not attributes.endswith("/"):
            stack.append((stack[-1] if stack else ROOT).inner(tag, _meanings(attributes)))
            hidden += tag in HIDDEN
            links += tag == "a"
    flush()
    return found


def _bin(x: float, edges: tuple) -> int:
    return sum(x >= e for e in edges)


def features(found: list[Leaf]) -> list[list[str]]:
    """Names of the features of every block."""
    out = []
    titles = ["h1" in x.place.tags or "h2" in x.place.tags for x in found]
    first = titles.index(True) if True in titles else -1
    for i, leaf in enumerate(found):
        text = leaf.text
        _, block, tags, kinds, near = leaf.place
        n = text.count(" ") + 1
        stops = sum(map(text.count, ".!?"))
        density = _bin(leaf.linked / max(1, len(text)), (0.01, 0.3, 0.7))
        names = ["bias", f"tag:{block}", f"words:{_bin(n, (2, 5, 10, 20, 40, 80))}", f"stops:{_bin(stops, (1, 2, 4, 8))}", f"links:{density}"]
        names += [f"in:{t}" for t in tags & BLOCKS]
        names += [f"kind:{k}" for k in kinds]
        names += [f"near:{k}" for k in near]
        names.append(f"kinds:{'plain' if not kinds else 'only-content' if kinds == {'content'} else 'other'}")
        names.append(f"end:{text[-1] in '.!?…:;”»'}")
        low = text.lower()
        names += [f"says:{k}:{n < 25}" for k, words in PHRASES.items() if any(w in low for w in words)]
        names.append(f"after-title:{first < 0 or i >= first}")
        names.append(f"plain-prose:{not kinds - {'content'} and block in ('p', 'h1', 'h2', 'h3', 'blockquote', 'pre')}")
        if block == "li":
            names.append(f"li:{density}:{'nav' in tags or 'menu' in kinds}")
        out.append(names)
    return out


class Chain:
    """A two-label chain: weights of features for the label 1 over 0, and of the four transitions."""

    def __init__(self, weights: dict[str, float], moves: np.ndarray) -> None:
        self.weights, self.moves = weights, moves

    def decode(self, names: list[list[str]]) -> list[int]:
        """The most probable labels, by Viterbi."""
        get, m = self.weights.get, self.moves.tolist()
        a = b = 0.0
        back = []
        for i, x in enumerate(names):
            e = sum([get(k, 0.0) for k in x])
            if i:
                p, q = a + m[0][0] >= b + m[1][0], a + m[0][1] >= b + m[1][1]
                back.append((not p, not q))
                a, b = (a + m[0][0] if p else b + m[1][0]), (a + m[0][1] if q else b + m[1][1])
            b += e
        if not names:
            return []
        now = int(b > a)
        out = [now]
        for step in reversed(back):
            now = int(step[now])
            out.append(now)
        return out[::-1]

    @classmethod
    def train(cls, pages: list[tuple[list[list[str]], list[int]]], *, epochs: int = 60, rate: float = 0.3, penalty: float = 1e-4, seed: int = 2) -> Chain:
        """Maximum likelihood by forward-backward sums over padded batches of pages, with a quadratic penalty."""
        index: dict[str, int] = {}
        for names, _ in pages:
            for x in names:
                for k in x:
                    index.setdefault(k, len(index))
        w, m = np.zeros(len(index)), np.zeros((2, 2))
        gw, gm = np.full(len(index), 1e-6), np.full((2, 2), 1e-6)
        coded = [([np.array([index[k] for k in x]) for x in names], np.array(labels)) for names, labels in pages if names]
        order = np.random.default_rng(seed)
        for _ in range(epochs):
            for part in np.array_split(order.permutation(len(coded)), max(1, len(coded) // 32)):
                batch = [coded[i] for i in part]
                longest = max(len(x) for x, _ in batch)
                e, y = np.zeros((len(batch), longest)), np.zeros((len(batch), longest), int)
                live = np.zeros((len(batch), longest), bool)
                for k, (x, labels) in enumerate(batch):
                    flat = np.concatenate(x)
                    sizes = np.array([len(z) for z in x])
                    e[k, : len(x)] = np.add.reduceat(w[flat], np.cumsum(sizes) - sizes)
                    y[k, : len(x)], live[k, : len(x)] = labels, True
                one, two = cls._marginals(e, live, m)
                dw, slope = np.zeros(len(index)), np.where(live, one - y, 0)
                for k, (x, _) in enumerate(batch):
                    np.add.at(dw, np.concatenate(x), np.repeat(slope[k, : len(x)], [len(z) for z in x]))
                pairs = np.zeros((2, 2))
                np.add.at(pairs, (y[:, :-1][live[:, 1:]], y[:, 1:][live[:, 1:]]), 1)
                dw, dm = dw / len(batch) + penalty * w, (two - pairs) / len(batch) + penalty * m
                gw += dw**2
                gm += dm**2
                w -= rate * dw / np.sqrt(gw)
                m -= rate * dm / np.sqrt(gm)
        return cls({k: float(w[i]) for k, i in index.items()}, m)

    @staticmethod
    def _marginals(e: np.ndarray, live: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of label 1 at every place, and expected counts of the transitions, summed over the batch."""
        n, longest = e.shape
        emit = np.stack((np.zeros_like(e), e), axis=2)
        ahead = np.zeros((n, longest, 2))
        ahead[:, 0] = emit[:, 0]
        for t in range(1, longest):
            step = np.logaddexp.reduce(ahead[:, t - 1, :, None] + m[None], axis=1) + emit[:, t]
            ahead[:, t] = np.where(live[:, t, None], step, ahead[:, t - 1])
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        behind, two = np.zeros((n, longest, 2)), np.zeros((2, 2))
        for t in range(longest - 1, 0, -1):
            both = emit[:, t] + behind[:, t]
            joint = np.exp(ahead[:, t - 1, :, None] + m[None] + both[:, None, :] - total[:, None, None])
            two += joint[live[:, t]].sum(axis=0)
            behind[:, t - 1] = np.where(live[:, t, None], np.logaddexp.reduce(m[None] + both[:, None, :], axis=2), behind[:, t])
        return np.exp(ahead[:, :, 1] + behind[:, :, 1] - total[:, None]), two


def composed_page(draw: random.Random, prose: list[str], short: list[str]) -> tuple[str, list[str]]:
    """A page in a random layout and its main blocks. prose: paragraphs; short: menu words and titles."""
    para = lambda: html.escape(draw.choice(prose), quote=False)
    word = lambda: html.escape(draw.choice(short), quote=False)
    sentence = lambda: html.escape(draw.choice(prose).split(". ")[0][:160], quote=False)
    main: list[str] = []

    def named(tags: str, *names: str) -> tuple[str, str]:
        tag, name = draw.choice(tags.split()), draw.choice(names)
        key = draw.choice(("class", "class", "id"))
        extra = draw.choice(("", f" {word().split(' ')[0]}x", " clearfix", "-wrap", "-1"))
        return (f'<{tag} {key}="{name}{extra}">' if name else f"<{tag}>"), f"</{tag}>"

    def wrap(pair: tuple[str, str], *inner: str) -> str:
        return pair[0] + draw.choice(("", "\n", "  ")).join(inner) + pair[1]

    def links(n: int) -> str:
        rows = [f'<a href="/{k}">{word()}</a>' for k in range(n)]
        return draw.choice(("<ul><li>" + "</li><li>".join(rows) + "</li></ul>", " | ".join(rows), "<p>" + " ".join(rows) + "</p>"))

    def keep(text: str) -> str:
        main.append(text)
        return text

    menu = lambda: wrap(draw.choice((("<nav>", "</nav>"), named("div ul nav", "menu", "navigation", "main-nav", "breadcrumbs", "topnav"))), links(draw.randint(3, 8)))
    advert = lambda: wrap(named("div aside section", "ad", "ads", "advert", "sponsored", "promo-box", "ad-banner"), *[f"<p>{para()}</p>" if draw.random() < 0.5 else para() for _ in range(draw.randint(1, 2))])
    notice = lambda: wrap(named("div section aside", "cookie-notice", "notice", "consent", "alert", "popup", "gdpr-banner"), f"<p>{draw.choice(('We use cookies. ', '', 'Please note. '))}{para()}</p>")
    side = lambda: wrap(draw.choice((("<aside>", "</aside>"), named("div aside section", "sidebar", "widget", "related", "side-rail", "secondary"))), f"<h3>{word()}</h3>", links(4), *[f"<p>{para()}</p>" for _ in range(draw.randint(0, 2))])
    form = lambda: wrap(draw.choice((("<form>", "</form>"), ('<form action="/s" class="search">', "</form>"))), f"<label>{word()}</label><input name=q>", f"<p>{sentence()}</p>", f"<button>{word()}</button>")
    social = lambda: wrap(named("div ul", "share", "social", "share-buttons"), links(3))

    def comments() -> str:
        rows = [wrap(named("div li article", "comment", "comment-body", "reply", ""), f"<b>{word()}</b>", f"<p>{para()}</p>") for _ in range(draw.randint(1, 4))]
        return wrap(named("section div ol", "comments", "comment-list", "reader-comments", "discussion", "responses"), f"<h3>{draw.choice(('Comments', 'Replies', word()))}</h3>", *rows)

    def header() -> str:
        pair = draw.choice((("<header>", "</header>"), named("div header", "header", "site-header", "masthead", "topbar")))
        return wrap(pair, draw.choice((f"<h1>{word()}</h1>", f"<div>{word()}</div>", f"<p>{sentence()}</p>")), draw.choice(("", menu())))

    def footer() -> str:
        pair = draw.choice((("<footer>", "</footer>"), named("div footer", "footer", "site-footer", "colophon", "bottom")))
        return wrap(pair, draw.choice(("&copy; ", "", "Copyright ")) + f"{word()} &middot; {para()}", draw.choice(("", links(3), f"<p>{para()}</p>")))

    def body() -> list[str]:
        out = []
        title = keep(word() if draw.random() < 0.7 else sentence())
        head = f"<{(t := draw.choice(('h1', 'h1', 'h1', 'h2')))}>{title}</{t}>"
        out.append(head if draw.random() < 0.85 else f"<header>{head}</header>")
        for _ in range(draw.randint(2, 9)):
            kind = draw.random()
            if kind < 0.62:
                text = keep(para())
                out.append(draw.choice((f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br>", f"<div>{text}</div>", f'<p class="{word()}">{text}</p>')))
            elif kind < 0.7:
                out.append(f"<h2>{keep(word())}</h2>")
            elif kind < 0.77:
                out.append("<ul>" + "".join(f"<li>{keep(sentence())}</li>" for _ in range(draw.randint(2, 4))) + "</ul>")
            elif kind < 0.82:
                out.append(f"<blockquote><p>{keep(para())}</p></blockquote>")
            elif kind < 0.85:
                out.append("<table><tr>" + "".join(f"<td>{keep(sentence())}</td>" for _ in range(2)) + "</tr></table>")
            elif kind < 0.88:
                text = keep(f'{sentence()} <a href="/x">{word()}</a> {sentence()}')
                out.append(f"<p>{text}</p>")
            else:
                out.append(draw.choice((advert, side, social, notice, form))())
        return out

    tail = [x() for x in (comments, social, side) if draw.random() < 0.3]
    inner = body()
    inside = tail if draw.random() < 0.5 else []
    pair = draw.choice(
        (("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), named("div section article", "content", "post", "entry-content", "story-body", "article-text", "main"), ("<div>", "</div>"), ("", ""))
    )
    content = wrap(pair, *inner, *inside)
    if draw.random() < 0.3:
        content = wrap(draw.choice((("<main>", "</main>"), ("<div>", "</div>"), ('<div id="page">', "</div>"))), content)
    before = [x() for x in (menu, header, notice, advert, form) if draw.random() < 0.5]
    after = [x() for x in (side, advert, notice, social) if draw.random() < 0.35] + ([] if inside else tail) + ([footer()] if draw.random() < 0.85 else [])
    draw.shuffle(before)
    page = f"<!DOCTYPE html><html><head><title>{word()}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>" + "".join([*before, content, *after]) + "</body></html>"
    return page, main


def _plain(text: str) -> str:
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", text)).split())


def training_pages(texts: list[str], n: int = 700, seed: int = 2) -> list[tuple[list[list[str]], list[int]]]:
    """Labelled pages: features and labels of the blocks of composed pages with paragraphs and titles from sampled pages."""
    draw = random.Random(seed)
    blocks = [x.text for page in texts for x in leaves(page)]
    prose = sorted({x for x in blocks if x.count(" ") >= 6}) or ["Some words of a paragraph stand here. They say little."]
    short = sorted({x for x in blocks if x.count(" ") < 6}) or ["Some words"]
    out = []
    for _ in range(n):
        page, main = composed_page(draw, prose, short)
        found = leaves(page)
        wanted = [_plain(x) for x in main]
        labels, at = [], 0
        for leaf in found:  # the main blocks stand in order; what equals none of the next is furniture
            hit = at < len(wanted) and leaf.text == wanted[at] and leaf.place.kinds.isdisjoint(FURNITURE)
            labels.append(int(hit))
            at += hit
        if at == len(wanted):
            out.append((features(found), labels))
    return out


def page_sample(pages: DataFrame, text_col: str = "html", *, max_pages: int = 200, max_chars: int = 20_000) -> list[str]:
    """Html of at most max_pages pages of at most max_chars, the first by a hash of the html: text to compose training pages of."""
    small = pages.where(F.length(text_col) <= max_chars).select(F.xxhash64(text_col).alias("h"), text_col)
    lowest = [x[0] for x in small.select("h").orderBy("h").limit(max_pages).collect()]  # hashes first: no task sends pages that lose
    picked = small.where(F.col("h").isin(lowest)).dropDuplicates(["h"])
    return sorted(x[1] for x in picked.limit(max_pages).collect())


def main_text(chain: Chain, page: str | None) -> str:
    found = leaves(page or "")
    return "\n".join(x.text for x, y in zip(found, chain.decode(features(found)), strict=True) if y)


def extract_main_text(pages: DataFrame, chain: Chain | None = None, *, id_col: str = "page_id", text_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page. Without a chain one is trained on text of a sample of the pages."""
    small_batches(pages.sparkSession)
    if chain is None:
        chain = Chain.train(training_pages(page_sample(pages, text_col)))
    shared = pages.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(shared.value, x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], [id_col, "url", "text", "n_chars"]
            )

    slim = pages.select(F.col(id_col).cast("long").alias(id_col), F.col("url").cast("string").alias("url"), F.col(text_col).cast("string").alias("html"))
    return slim.mapInArrow(run, f"`{id_col}` long, url string, text string, n_chars long")
