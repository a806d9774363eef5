"""Main text of web pages by a linear-chain conditional random field.

A page is cut into leaf blocks of text.  The features of a block are its ancestors'
tags and their class and id names (names that the training pages do not have say nothing),
its own tag, its text's form (length, share of links, marks), and how dense its neighbours are.  A chain of two states, main text or not, is trained by gradient
ascent on the likelihood of labelled pages and decoded by Viterbi.

The labelled pages are composed here, from layouts of menus, headers, notices, adverts,
sidebars, forms, articles, comments and footers in semantic and in plain markup, with
random words and often random names; so the model is the same wherever it is trained, and no corpus is needed.
``train`` takes other labelled pages as well.

Within a block character references are decoded and white space is one space; blocks are
joined by two line feeds.  Scripts, styles, templates, heads and comments of the markup
hold no blocks; where they stand within a line of text, the line goes on behind them.

Defined cases: a null or empty page, or one without main text, gives the empty text;
tags left open close with what holds them; a quote left open ends with its tag; very long
and deeply nested pages take linear time (a block's features see its ``DEPTH`` nearest
ancestors); repeated rows are extracted each; an empty table gives no rows; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import functools
import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_MARKUP = r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)"
#: A quote opens a value only behind an equals sign; a value without quotes ends at white space or at the tag's end, whatever it holds.
_TOKEN = re.compile(_MARKUP + r"((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s>]*+))*+)>", re.S)
#: The same for a tag whose quote stays open: it ends at the next mark.
_LOOSE = re.compile(_MARKUP + r"([^>]*+)>", re.S)
#: Tags with an open quote that are looked at the long way; a page with more is read loosely behind them, so that no scan to its end is repeated without bound.
OPEN_QUOTES = 64
_OPENING = re.compile(r"<(?:[!?]|/?[a-zA-Z])")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[a-z]+")
#: Names that tell how a page is laid out or in what state it is, not what a region holds.
_STATE = re.compile(r"(?:^|[-_])(?:no|not|has|with|without|is|are|open|closed|enabled|disabled|layout|type|template|format|status|single|left|right|col|row|grid|theme|js|page|wide|full|width)(?:[-_]|$)")
#: What any hidden element has in its tag; the attributes decide.
_HIDDEN = re.compile(r"hidden|display", re.I)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s>/=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:!\s*important\s*)?(?:;|$)", re.I)
_SPACE = re.compile(r"\s+")

#: Elements that hold no text to read, those that close at once, and those within a line of text.
DEPTH = 64
SILENT = frozenset("script style template noscript head title svg iframe object select option textarea button canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var "
    "math merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
#: Elements without text to read that do not end the line they stand in.
FLOWING = INLINE | (SILENT - {"head", "title", "option"})
CLOSING = frozenset(("p", "li", "dt", "dd", "td", "th", "tr", "option"))
_RAW = {t: re.compile(rf"</{t}\b", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "template")}


def is_hidden(attributes: str) -> bool:
    """Whether a tag with these attributes has ``hidden``, ``aria-hidden=true`` or a style with ``display: none``."""
    seen = set()
    for name, double, single, bare in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), double or single or bare
        if name in seen:  # the first one of a name counts
            continue
        seen.add(name)
        if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" or name == "style" and _NO_DISPLAY.search(value):
            return True
    return False


class Block:
    __slots__ = ("linked", "path", "text")

    def __init__(self, text: str, path: tuple[str, ...], linked: int):
        self.text, self.path, self.linked = text, path, linked


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks of a page in order; a path has an entry ``tag|names`` for each ancestor, names being those of class, id and role (of ``html`` and ``body`` none)."""
    out: list[Block] = []
    if not page:
        return out
    stack: list[tuple[str, str]] = []
    opened: Counter = Counter()  # open elements by tag
    loose = 0
    parts: list[str] = []
    linked = silent = anchors = 0
    path: tuple[str, ...] | None = None

    def flush() -> None:
        nonlocal linked, path
        if silent:  # nothing within such an element ends a line
            return
        if parts:
            raw = "".join(parts)
            text = _SPACE.sub(" ", entities.unescape(raw) if "&" in raw else raw).strip()
            if text:
                out.append(Block(text, path or (), linked))
            parts.clear()
        linked, path = 0, None

    def close(k: int) -> None:
        nonlocal silent, anchors
        for tag, entry in stack[k:]:
            silent -= tag in SILENT or tag == "?"
            anchors -= tag == "a"
            opened[entry.partition("|")[0]] -= 1
        del stack[k:]

    def say(text: str) -> None:
        nonlocal linked, path
        if text and not silent:
            if path is None and not text.isspace():
                near: list[str] = []
                for t, e in reversed(stack[-4 * DEPTH :]):
                    if t not in INLINE and len(near) < DEPTH:
                        near.append(e)
                path = tuple(reversed(near))
            parts.append(text)
            if anchors:
                linked += len(text)

    at, n = 0, len(page)
    while at < n:
        first = _OPENING.search(page, at)
        m = _TOKEN.match(page, first.start()) if first and loose <= OPEN_QUOTES else None
        if first and m is None:
            loose += 1
            m = _LOOSE.match(page, first.start()) if page.find(">", first.start()) >= 0 else None
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if not tag:
            if m[0].startswith("<![CDATA["):
                say(entities.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag, ends, rest = tag.lower(), m[1], m[3] or ""
        if ends:
            for k in range(len(stack) - 1, -1, -1) if opened[tag] > 0 else ():
                if stack[k][0] == tag or stack[k][1].startswith(tag + "|?"):
                    if tag not in FLOWING or any(t not in FLOWING for t, _ in stack[k:]):
                        flush()
                    close(k)
                    break
            else:
                if tag not in FLOWING:
                    flush()
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag not in FLOWING:
            flush()
            if stack and any(opened[t] for t in CLOSING):
                for k in range(len(stack) - 1, -1, -1):  # an open paragraph or list item ends here
                    t = stack[k][0]
                    if t == "p" or t == tag and t in ("li", "dt", "dd", "td", "th", "tr", "option"):
                        close(k)
                        break
                    if t not in INLINE:
                        break
        if tag in _RAW:
            end = _RAW[tag].search(page, at)
            at = end.start() if end else n
            continue
        if rest.endswith("/") and tag not in INLINE and tag in ("svg", "object", "iframe"):
            continue
        hidden = bool(rest) and bool(_HIDDEN.search(rest)) and is_hidden(rest)
        names = ""
        if rest and "=" in rest:
            names = " ".join(sorted({w for g in _NAMES.findall(rest) for w in "".join(g).lower().split()})) if tag not in ("html", "body") else ""
        opened[tag] += 1
        if hidden and tag not in SILENT:
            stack.append(("?", f"{tag}|?"))
            silent += 1
        else:
            stack.append((tag, f"{tag}|{names}"))
            silent += tag in SILENT
            anchors += tag == "a"
    silent = 0
    flush()
    return out


def name_words(names: str) -> set[str]:
    """What the names of an element say: each name, and the words of a name that is no state of the page."""
    out = set()
    for name in names.split():
        if not _STATE.search(name):
            out.add(name)
            out.update(w for w in _PARTS.findall(name) if len(w) > 1)
    return out


@functools.lru_cache(maxsize=1 << 14)
def path_features(path: tuple[str, ...]) -> tuple[str, ...]:
    found = {"bias"}
    for depth, entry in enumerate(reversed(path)):
        tag, _, names = entry.partition("|")
        found.add(f"in {tag}")
        if depth == 0:
            found.add(f"own {tag}")
        for w in name_words(names):
            found.add(f"name {w}")
            if depth < 2:
                found.add(f"near {w}")
    if not found & {"in div", "in section", "in article", "in main", "in table", "in nav", "in aside", "in footer", "in header"}:
        found.add("in body only")
    return tuple(sorted(found))


def text_features(b: Block) -> tuple[str, ...]:
    n = len(b.text)
    share = b.linked / n
    return (
        f"length {min(8, n.bit_length() - 1)}",
        f"links {0 if not share else 1 + int(min(share, 1) * 3)}",
        "ends" if b.text[-1] in ".?!:;\"'»”" else "open",
        "rights" if "©" in b.text[:40] or "copyright" in b.text[:60].lower() else "free",
    )


def density(b: Block | None) -> int:
    """Of a neighbouring block: none, a link, short, a line, or a paragraph."""
    if b is None:
        return 0
    if 2 * b.linked > len(b.text):
        return 1
    return 2 if len(b.text) < 25 else 3 if len(b.text) < 80 else 4


def around(blocks: list[Block], i: int) -> tuple[str, ...]:
    """Features of a block among its neighbours: how dense it and they are, and whether they lie in the same element."""
    b, before, after = blocks[i], blocks[i - 1] if i else None, blocks[i + 1] if i + 1 < len(blocks) else None
    kin = lambda x: x is not None and x.path[:-1] == b.path[:-1]
    own = b.path[-1].partition("|")[0] if b.path else ""
    return f"{own} {density(b)}", f"before {density(before)}", f"after {density(after)}", f"alone {density(b) if before is None and after is None else -1}", f"kin {max((density(x) for x in (before, after) if kin(x)), default=0)}"


#: Class and id names of the layouts, by kind of region; names that must be known to the model.
BOILER_NAMES = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topnav main-menu site-nav pagination tabs toc skip-links",
    "header": "header site-header masthead topbar banner logo branding page-header tagline",
    "notice": "notice cookie cookie-notice consent gdpr alert popup modal announcement paywall cookie-banner disclaimer warning message",
    "ad": "ad ads advert advertisement sponsored promo promotion banner-ad ad-slot sponsor partner-content adsense",
    "aside": "sidebar aside related widget recommended popular trending side-column rail recent-posts more-stories tags author-box bio",
    "form": "form search subscribe newsletter login signup search-form contact-form comment-form poll feedback",
    "share": "share social social-links share-buttons follow-us tools print",
    "comments": "comments comment comment-list reader-comments replies reply discussion disqus responses user-comment",
    "footer": "footer site-footer copyright legal bottom colophon footer-links credits page-footer",
}
BOILER_TAGS = {"nav": ("nav", "ul"), "header": ("header",), "aside": ("aside",), "form": ("form",), "footer": ("footer",), "comments": ("section", "ol", "ul"), "notice": ("dialog", "section"), "ad": ("aside", "ins"), "share": ("ul",)}
MAIN_NAMES = "article post content entry entry-content post-content article-body main story story-body text body-copy post-body article-content page-content main-content"


def _sentence(r: random.Random, lo: int, hi: int) -> str:
    words = ["".join(r.choice("aeioulnrstdmphk") for _ in range(r.randint(2, 9))) for _ in range(r.randint(lo, hi))]
    return " ".join(words).capitalize()


def labelled_page(seed: int) -> tuple[str, list[bool]]:
    """A composed page and, for each of its blocks in order, whether it is main text."""
    r = random.Random(seed)
    out: list[str] = ["<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body>"]
    labels: list[bool] = []

    def leaf(tag: str, text: str, main: bool) -> None:
        out.append(f"<{tag}>{text}</{tag}>")
        labels.append(main)

    def other() -> str:
        """A name that says nothing."""
        made = lambda: "".join(r.choice("bcdfghjklmnpqrstvwxyz") + r.choice("aeiou") for _ in range(r.randint(1, 4)))
        return r.choice((made(), f"{made()}-{r.randint(1, 99)}", f"{made()}-{made()}", f"{made()}__{made()}"))

    def region(kind: str) -> None:
        names = r.choice(BOILER_NAMES[kind].split())
        if r.random() < 0.15:
            names = f"{other()} {names}"
        tag = r.choice(BOILER_TAGS[kind]) if kind in BOILER_TAGS and r.random() < 0.6 else r.choice(("div", "div", "section"))
        named = f' {r.choice(("class", "id"))}="{names}"' if tag in ("div", "section", "ul", "ol", "ins", "dialog") or r.random() < 0.4 else ""
        out.append(f"<{tag}{named}>")
        if tag not in ("ul", "ol") and r.random() < 0.35:  # text with no element of its own
            mark = "&copy; " if kind == "footer" and r.random() < 0.6 else ""
            out.append(mark + _sentence(r, 1, 25) + r.choice((".", ".", "", "!")) + f"</{tag}>")
            labels.append(False)
            return
        for _ in range(r.randint(1, 6)):
            if kind in ("nav", "share", "footer") and r.random() < 0.8 or kind == "aside" and r.random() < 0.5:
                leaf("li" if tag in ("ul", "ol") or r.random() < 0.5 else "div", f"<a href='/x'>{_sentence(r, 1, 4)}</a>", False)
            elif kind in ("comments", "notice", "ad", "aside", "footer", "header") and r.random() < 0.8:
                text = _sentence(r, 2, 40) + r.choice((".", ".", "!", ""))
                leaf(r.choice(("p", "div", "li" if tag in ("ul", "ol") else "p", "h3")), ("&copy; " if kind == "footer" and r.random() < 0.5 else "") + text, False)
            else:
                leaf(r.choice(("p", "div", "h4", "label-x")), _sentence(r, 1, 5), False)
        out.append(f"</{tag}>")

    def article() -> None:
        kind = r.random()
        if kind < 0.12:  # the article stands in the body itself
            tag = named = ""
        else:
            tag = "article" if r.random() < 0.5 else r.choice(("div", "div", "main", "section", "td"))
            named = "" if r.random() < 0.3 else f' {r.choice(("class", "id"))}="{r.choice(MAIN_NAMES.split()) if r.random() < 0.5 else other()}"'
        wrap = tag != "" and r.random() < 0.3
        if tag == "td":
            out.append("<table><tr>")
        out.append(("<main>" if wrap and tag != "td" else "") + (f"<{tag}{named}>" if tag else ""))
        if r.random() < 0.8:
            leaf(r.choice(("h1", "h1", "h2")), _sentence(r, 1, 12) + r.choice(("", "", ".")), True)
        if tag in ("div", "td", "section") and r.random() < 0.25:  # text with line breaks in place of paragraphs
            out.append("<br><br>".join(". ".join(_sentence(r, 3, 18) for _ in range(r.randint(1, 4))) + "." for _ in range(r.randint(1, 6))))
            labels.append(True)
            out.append("</td></tr></table>" if tag == "td" else f"</{tag}>" + ("</main>" if wrap else ""))
            return
        plain = r.random() < 0.25  # paragraphs only
        for _ in range(r.randint(1, 14)):
            x = 1.0 if plain else r.random()
            if x < 0.12:
                region(r.choice(("ad", "share", "aside", "form", "notice")))
            elif x < 0.18:
                leaf(r.choice(("h2", "h3")), _sentence(r, 1, 8), True)
            elif x < 0.23:
                out.append("<ul>")
                for _ in range(r.randint(1, 4)):
                    leaf("li", _sentence(r, 1, 15) + r.choice(("", ".")), True)
                out.append("</ul>")
            elif x < 0.26:
                leaf("blockquote", _sentence(r, 3, 30) + ".", True)
            elif x < 0.28:
                leaf("pre", _sentence(r, 1, 20), True)
            elif x < 0.31:
                out.append("<table><tr>")
                for _ in range(r.randint(1, 4)):
                    leaf("td", _sentence(r, 1, 4), True)
                out.append("</tr></table>")
            else:
                text = ". ".join(_sentence(r, 1, 18) for _ in range(r.randint(1, 6)))
                if r.random() < 0.15:
                    text += f" <a href='/y'>{_sentence(r, 1, 4)}</a>"
                leaf("p", f"<b>{text}</b>" if r.random() < 0.1 else text + r.choice((".", ".", ".", "")), True)
        if r.random() < 0.25:
            region("comments")
        if tag == "td":
            out.append("</td></tr></table>")
        elif tag:
            out.append(f"</{tag}>" + ("</main>" if wrap else ""))

    outer = [f'<div {r.choice(("class", "id"))}="{other()}">' for _ in range(r.choice((0, 0, 1, 2, 3)))]
    out += outer
    bare_head, bare_foot = r.random() < 0.35, r.random() < 0.35  # pages that begin or end with the article
    for kind in ("notice", "header", "nav", "ad", "aside"):
        if not bare_head and r.random() < 0.5:
            region(kind)
    article()
    for kind in ("share", "comments", "form", "aside", "ad", "nav", "footer", "notice"):
        if not bare_foot and r.random() < (0.7 if kind == "footer" else 0.3):
            region(kind)
    out.append("</div>" * len(outer) + "</body></html>")
    return "".join(out), labels


def training_pages(n: int = 700) -> list[tuple[str, list[bool]]]:
    return [labelled_page(seed) for seed in range(n)]


class Crf:
    """Weights by feature for the state *main text* (the other state has none), and four transition weights."""

    def __init__(self, weights: dict[str, float], moves: list[list[float]]):
        self.weights, self.moves = weights, moves
        self.paths: dict[tuple[str, ...], float] = {}

    def emission(self, blocks: list[Block], i: int) -> float:
        b = blocks[i]
        got = self.paths.get(b.path)
        w = self.weights.get
        if got is None:
            if len(self.paths) > 20_000:
                self.paths.clear()
            got = self.paths[b.path] = sum(w(f, 0.0) for f in path_features(b.path))
        return got + sum(w(f, 0.0) for f in (*text_features(b), *around(blocks, i)))

    def decode(self, blocks: list[Block]) -> list[bool]:
        """Viterbi's best sequence of states."""
        (aa, ab), (ba, bb) = self.moves
        back: list[tuple[bool, bool]] = []
        off, on = 0.0, None
        for i in range(len(blocks)):
            e = self.emission(blocks, i)
            if on is None:
                off, on = 0.0, e
                continue
            to_off, to_on = on + ba > off + aa, on + bb >= off + ab
            off, on = (on + ba if to_off else off + aa), (on + bb if to_on else off + ab) + e
            back.append((to_off, to_on))
        if on is None:
            return []
        state = on > off
        states = [state]
        for to_off, to_on in reversed(back):
            state = to_on if state else to_off
            states.append(state)
        return states[::-1]


def train(pages: list[tuple[str, list[bool]]], rounds: int = 300, rate: float = 0.5, decay: float = 1e-5) -> Crf:
    """Fit by AdaGrad on the conditional log-likelihood, all pages at a time by forward and backward sums."""
    names: dict[str, int] = {}
    rows, cells, chains = [], [], []
    for page, labels in pages:
        blocks = blocks_of(page)
        if len(blocks) != len(labels):
            raise ValueError("a label for each block is needed")
        if blocks:
            chains.append([int(x) for x in labels])
            for t, b in enumerate(blocks):
                f = [names.setdefault(x, len(names)) for x in (*path_features(b.path), *text_features(b), *around(blocks, t))]
                rows += f
                cells += [(len(chains) - 1, t)] * len(f)
    if not chains:
        return Crf({}, [[0.0, 0.0], [0.0, 0.0]])
    n, long = len(chains), max(map(len, chains))
    truth, real = np.zeros((n, long), np.int64), np.zeros((n, long), bool)
    for i, c in enumerate(chains):
        truth[i, : len(c)], real[i, : len(c)] = c, True
    at = np.array([i * long + t for i, t in cells])
    rows = np.array(rows)
    w, g2 = np.zeros(len(names)), np.full(len(names), 1e-8)
    move, m2 = np.zeros((2, 2)), np.full((2, 2), 1e-8)
    want = np.zeros((2, 2))
    pair = real[:, 1:]
    np.add.at(want, (truth[:, :-1][pair], truth[:, 1:][pair]), 1)
    blocks_total = real.sum()
    for _ in range(rounds):
        e = np.zeros((n, long, 2))
        e[:, :, 1] = np.bincount(at, w[rows], n * long).reshape(n, long)
        alpha, beta = np.zeros((n, long, 2)), np.zeros((n, long, 2))
        alpha[:, 0] = e[:, 0]
        for t in range(1, long):
            nxt = np.logaddexp.reduce(alpha[:, t - 1, :, None] + move, axis=1) + e[:, t]
            alpha[:, t] = np.where(real[:, t, None], nxt, alpha[:, t - 1])
        for t in range(long - 2, -1, -1):
            nxt = np.logaddexp.reduce(move + (e[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(real[:, t + 1, None], nxt, 0)
        z = np.logaddexp.reduce(alpha[:, -1], axis=1)
        p = np.exp(alpha[:, :, 1] + beta[:, :, 1] - z[:, None]) * real
        g = np.bincount(rows, ((truth * real) - p).ravel()[at], len(names)) / blocks_total - decay * w / 10
        both = alpha[:, :-1, :, None] + move + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]
        gm = (want - np.exp(np.where(pair[:, :, None, None], both, -np.inf)).sum(axis=(0, 1))) / blocks_total - decay * move / 10
        g2 += g * g
        m2 += gm * gm
        w += rate * g / np.sqrt(g2)
        move += rate * gm / np.sqrt(m2)
    return Crf({k: float(w[i]) for k, i in names.items()}, move.tolist())


@functools.lru_cache(maxsize=1)
def default_model() -> Crf:
    return train(training_pages())


def main_text(model: Crf, page: str | None) -> str:
    blocks = blocks_of(page)
    return "\n\n".join(b.text for b, main in zip(blocks, model.decode(blocks), strict=True) if main)


def _extractor(model: Crf):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(model, x.as_py()) for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id").cast(pa.int64()), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return work


def extract_main_text(pages: DataFrame, model: Crf | None = None) -> DataFrame:
    """Main text of ``pages(page_id, url, html)``: page_id, url, text, n_chars for every row."""
    return pages.select("page_id", "url", "html").mapInArrow(_extractor(model or default_model()), "page_id long, url string, text string, n_chars long")
