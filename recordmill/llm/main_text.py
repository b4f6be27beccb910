"""Main text of web pages by a graphical model over the tree of their elements.

A page becomes a tree: block elements are nodes and each run of text between block boundaries
is a leaf. Every node is content or not; features of a node (tag, words of class and id, length,
share of links, punctuation) score it, and potentials between parent and child say how much one
follows the other. Sum-product messages go up and down each tree, all trees of a batch at once
depth by depth, and give exact marginals; leaves with a marginal of at least a half are the text.

The model is trained in numpy on labelled pages by the same messages (gradient of the conditional
likelihood). They come from a bounded sample of the table, ``sample_pages`` chosen by a hash:
those with an article or main element as they stand, labelled by it, and their blocks laid out
anew in ``layouts`` pages of other make (plain divisions and tables, menus, notices, adverts,
forms, sidebars and reader comments), labelled by construction. Prediction reads every page whole.

Never text: scripts, styles, the head, templates, form controls and other elements that show no
prose (``DEAD``); comments and markup. Character references are decoded, white space becomes one
space, and blocks are joined in page order by one space. An element left open is closed by the
next one that cannot lie in it; a page cut short ends there.

Nulls, ties, repeats: null or empty html gives an empty text; a marginal of exactly a half is
content; repeated rows are read one by one; a null id or url stays null. An empty table gives no
rows; other columns are ignored. With no text in the sample the layouts are filled with plain
filler words.
"""

from __future__ import annotations

import html as references
import random
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import short_batches

SAMPLE_PAGES, LAYOUTS = 120, 800
SAMPLE_CHARACTERS = 200_000  # a longer page is no page of the training sample
ROUNDS, RATE, DECAY = 200, 0.1, 2e-4

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
DEAD = frozenset("head template noscript svg math select option optgroup datalist button object canvas audio video map applet".split())
IN_HEAD = frozenset("title meta link style script base noscript template".split())
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"})}
KINDS = {"": 0, **dict.fromkeys("p pre blockquote".split(), 1), **dict.fromkeys("h1 h2 h3 h4 h5 h6".split(), 2), **dict.fromkeys("ul ol dl".split(), 3), **dict.fromkeys("li dt dd".split(), 4), **dict.fromkeys("table tbody tr td th".split(), 5), **dict.fromkeys("nav header footer aside form".split(), 6), "article": 7, "main": 7, "html": 8, "body": 8}
OTHER_KIND, N_KINDS = 9, 10

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
NAMED = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
SPACE = re.compile(r"\s+")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}


class Tree(NamedTuple):
    parents: list[int]  # -1 for a root; a parent comes before its children
    depths: list[int]
    kinds: list[int]
    features: list[list[str]]
    texts: list[str | None]  # of leaves; None for elements


class Model(NamedTuple):
    names: dict[str, int]
    weights: np.ndarray
    bonds: np.ndarray  # by kinds of parent and child, value of the parent, value of the child


def _named_words(attributes: str) -> set[str]:
    return {w.lower() for _, *values in NAMED.findall(attributes) for w in WORDS.findall("".join(values))}


def _leaf_features(text: str, linked: int, tag: str) -> list[str]:
    size = len(text)
    words = text.count(" ") + 1
    told = [f"size {min(size.bit_length(), 10)}", f"links {min(4 * linked // size, 4)}", f"in {tag}", f"commas {min(text.count(','), 3)}"]
    if text[-1] in ".!?…:;\"”»。":
        told.append("sentence")
    if words > 1 and size / words > 12:
        told.append("long words")
    told += [f"has {sign}" for sign in "©|·»›" if sign in text]
    return told


def parse(page: str) -> Tree:
    """The tree of one page."""
    parents: list[int] = []
    depths: list[int] = []
    kinds: list[int] = []
    features: list[list[str]] = []
    texts: list[str | None] = []
    stack: list[tuple[str, int]] = []  # open block elements: tag, node
    opened: Counter[str] = Counter()
    pieces: list[str] = []
    dead = linked = 0
    in_link = False

    def add(kind: int, told: list[str], text: str | None) -> int:
        parent = stack[-1][1] if stack else -1
        parents.append(parent)
        depths.append(depths[parent] + 1 if parent >= 0 else 0)
        kinds.append(kind)
        features.append(told)
        texts.append(text)
        return len(parents) - 1

    def block_ends() -> None:
        nonlocal linked
        text = SPACE.sub(" ", "".join(pieces)).strip()
        if text:
            add(0, _leaf_features(text, min(linked, len(text)), stack[-1][0] if stack else ""), text)
        pieces.clear()
        linked = 0

    def pop() -> str:
        nonlocal dead
        tag, _ = stack.pop()
        opened[tag] -= 1
        dead -= tag in DEAD
        return tag

    def shown(text: str) -> None:
        nonlocal linked
        if text and not dead:
            text = references.unescape(text) if "&" in text else text
            pieces.append(text)
            if in_link:
                linked += len(text.strip())

    at, end = 0, len(page)
    while at < end:
        found = TOKEN.search(page, at)
        if not found:
            shown(page[at:])
            break
        shown(page[at : found.start()])
        at = found.end()
        closing, tag, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if tag == "a":
                in_link = False
            if tag in INLINE:
                continue
            block_ends()
            if opened[tag]:
                while pop() != tag:
                    pass
            continue
        if tag in RAW:
            close = RAW_END[tag].search(page, at)
            at = close.start() if close else end
            continue
        if tag == "a":
            in_link = True
        if tag in INLINE:
            if tag == "br":
                shown(" ")
            continue
        block_ends()
        if opened["head"] and tag not in IN_HEAD:
            while pop() != "head":
                pass
        if tag in ENDS_P and opened["p"]:
            while pop() != "p":
                pass
        if tag in CLOSES and stack:
            ends, stops = CLOSES[tag]
            if any(opened[t] for t in ends):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in stops:
                        break
                    if stack[k][0] in ends:
                        while len(stack) > k:
                            pop()
                        break
        if tag in VOID:
            continue
        told = [f"tag {tag}", *sorted(f"named {w}" for w in _named_words(attributes))] if not dead else []
        node = add(KINDS.get(tag, OTHER_KIND), told, None) if not dead and tag not in DEAD else (stack[-1][1] if stack else -1)
        stack.append((tag, node))
        opened[tag] += 1
        dead += tag in DEAD
    block_ends()
    return Tree(parents, depths, kinds, features, texts)


class Forest:
    """The trees of many pages side by side, with messages passed depth by depth."""

    def __init__(self, trees: list[Tree], names: dict[str, int]):
        starts = np.cumsum([0, *[len(t.parents) for t in trees]])
        self.starts = starts
        self.size = int(starts[-1])
        parents = [np.array(t.parents, np.int64) for t in trees]
        self.parents = np.concatenate([np.where(p < 0, -1, p + s) for p, s in zip(parents, starts)] or [np.zeros(0, np.int64)])
        depths = np.concatenate([np.array(t.depths, np.int64) for t in trees] or [np.zeros(0, np.int64)])
        kinds = np.concatenate([np.array(t.kinds, np.int64) for t in trees] or [np.zeros(0, np.int64)])
        self.kinds = N_KINDS * kinds[self.parents] + kinds  # of each pair; without meaning for a root
        told = [[names[f] for f in fs if f in names] for t in trees for fs in t.features]
        self.of_node = np.repeat(np.arange(self.size), [len(f) for f in told]) if told else np.zeros(0, np.int64)
        self.feature = np.array([f for fs in told for f in fs], np.int64)
        order = np.argsort(depths, kind="stable")
        bounds = np.searchsorted(depths[order], np.arange(1, (depths.max() if self.size else 0) + 2))
        self.levels = [order[a:b] for a, b in zip(bounds, bounds[1:])]  # below the roots

    def marginals(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        """Per node the chances of (not content, content), and per node with a parent those of (parent, node)."""
        up = np.zeros((self.size, 2))
        up[:, 1] = np.bincount(self.of_node, model.weights[self.feature], self.size)
        sent = np.zeros((self.size, 2))
        for nodes in reversed(self.levels):
            both = up[nodes][:, None, :] + model.bonds[self.kinds[nodes]]
            sent[nodes] = np.logaddexp(both[:, :, 0], both[:, :, 1])
            np.add.at(up, self.parents[nodes], sent[nodes])
        full = up.copy()
        joint = np.zeros((self.size, 2, 2))
        for nodes in self.levels:
            above = full[self.parents[nodes]] - sent[nodes]
            both = above[:, :, None] + model.bonds[self.kinds[nodes]]
            full[nodes] = up[nodes] + np.logaddexp(both[:, 0], both[:, 1])
            joint[nodes] = both + up[nodes][:, None, :]
        chances = np.exp(full - np.logaddexp(full[:, :1], full[:, 1:]))
        flat = joint.reshape(-1, 4)
        flat = np.exp(flat - flat.max(axis=1, keepdims=True, initial=-np.inf)) if self.size else flat
        flat /= flat.sum(axis=1, keepdims=True)
        return chances, flat.reshape(-1, 2, 2)


def gradient(forest: Forest, labels: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Of the log-likelihood of the labels: observed less expected features and parent-child pairs."""
    chances, joint = forest.marginals(model)
    missing = (labels - chances[:, 1])[forest.of_node]
    weights = np.bincount(forest.feature, missing, len(model.weights))
    bonds = np.zeros_like(model.bonds)
    below = np.flatnonzero(forest.parents >= 0)
    np.add.at(bonds, (forest.kinds[below], labels[forest.parents[below]], labels[below]), 1.0)
    np.add.at(bonds, forest.kinds[below], -joint[below])
    return weights, bonds


def fit(pages: list[tuple[Tree, list[int]]]) -> Model:
    """Weights of (tree, label per node) pages by steps of falling size on all of them at once."""
    seen = Counter(f for tree, _ in pages for fs in tree.features for f in set(fs))
    names = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n > 1))}
    forest = Forest([tree for tree, _ in pages], names)
    labels = np.array([y for _, told in pages for y in told], np.int64)
    model = Model(names, np.zeros(len(names)), np.zeros((N_KINDS * N_KINDS, 2, 2)))
    parameters, first, second = (model.weights, model.bonds), [0.0, 0.0], [0.0, 0.0]
    for step in range(1, ROUNDS + 1):
        rate = RATE * (1 - (step - 1) / ROUNDS)
        for k, (value, slope) in enumerate(zip(parameters, gradient(forest, labels, model))):
            slope = slope / max(len(pages), 1) - DECAY * value
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.99 * second[k] + 0.01 * slope * slope
            value += rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return model


# --- labelled pages ------------------------------------------------------------------------

# Names that sites give their blocks: content, wrappers, and what is not content.
CONTENT = ["content", "post-content", "article-body", "entry-content", "story-body", "main-content", "post", "text", "article", "entry", "page-content", "body-text", "single-post", "mainText"]
WRAPPERS = ["wrapper", "page", "container", "site", "layout", "row", "outer", "inner", "col-main", "wrap"]
BOILERPLATE = {
    "menu": ["nav", "menu", "main-menu", "navbar", "navigation", "top-nav", "breadcrumbs", "breadcrumb", "pagination", "toc", "tabs"],
    "header": ["header", "site-header", "masthead", "top", "topbar", "branding", "page-header"],
    "footer": ["footer", "site-footer", "bottom", "copyright", "legal", "colophon", "footer-links"],
    "sidebar": ["sidebar", "side", "aside", "widget", "widget-area", "right-column", "related", "related-posts", "recommended", "trending", "most-read", "tags"],
    "notice": ["notice", "cookie", "cookie-banner", "cookie-notice", "consent", "gdpr", "alert", "message", "popup", "modal", "overlay", "warning", "disclaimer", "paywall"],
    "advert": ["ad", "ads", "advert", "advertisement", "ad-banner", "banner", "sponsored", "promo", "sponsor", "adsbygoogle", "promotion"],
    "form": ["form", "search", "search-form", "login", "subscribe", "newsletter", "signup", "contact-form", "register"],
    "comments": ["comments", "comment-list", "comment", "reader-comments", "responses", "discussion", "replies", "disqus", "respond", "user-comments", "feedback"],
    "share": ["share", "social", "share-buttons", "social-links", "follow-us", "byline-share"],
}
TAGS = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "notice": "div", "advert": "div", "form": "form", "comments": "section", "share": "div"}
FILLER = "one two three four five six seven eight nine ten".split()


def _marked(tree: Tree) -> list[int] | None:
    """Labels of a page that marks its article: what lies in it, but not in a menu, footer, sidebar or form of it."""
    inside, any_content = [], False
    for parent, told in zip(tree.parents, tree.features):
        tag = told[0] if told else ""
        value = inside[parent] if parent >= 0 else 0
        if tag in ("tag article", "tag main"):
            value, any_content = 1, True
        elif tag in ("tag nav", "tag aside", "tag footer", "tag form", "tag header"):
            value = 0
        inside.append(value)
    return _by_leaves(tree, inside) if any_content else None


def _by_leaves(tree: Tree, inside: list[int]) -> list[int]:
    """Leaves as told; an element is content if most of its text is, without text if it lies in content."""
    good, all_of = [0] * len(inside), [0] * len(inside)
    for i in range(len(inside) - 1, -1, -1):
        if tree.texts[i] is not None:
            all_of[i] = len(tree.texts[i])
            good[i] = all_of[i] * inside[i]
        if tree.parents[i] >= 0:
            good[tree.parents[i]] += good[i]
            all_of[tree.parents[i]] += all_of[i]
    return [int(2 * g > n) if n else y for g, n, y in zip(good, all_of, inside)]


class Layouts:
    """Pages laid out at random from given words; texts of the article start with a private sign that tells the label."""

    SIGN = "\ue000"

    def __init__(self, words: list[str], seed: int):
        self.words, self.draw = words or FILLER, random.Random(seed)

    def phrase(self, low: int, high: int) -> str:
        n = int(low * (high / low) ** self.draw.random())
        start = self.draw.randrange(len(self.words))
        told = self.words[start : start + n] if self.draw.random() < 0.95 else [self.words[start]]
        told = (told * (n // len(told) + 1))[:n]
        return references.escape(" ".join(told))

    def sentence(self, low: int, high: int) -> str:
        return self.phrase(low, high).rstrip(".,") + self.draw.choice([".", ".", ".", "!", "?", ""])

    def tagged(self, kind: str, names: list[str], inside: str) -> str:
        draw = self.draw
        tag = TAGS.get(kind, "div") if draw.random() < 0.4 else "div"
        name = draw.choice(names)
        shape = draw.random()
        if tag != "div" and shape < 0.4:
            return f"<{tag}>{inside}</{tag}>"
        if shape < 0.75:
            return f'<{tag} class="{name}">{inside}</{tag}>'
        return f'<{tag} id="{name}">{inside}</{tag}>'

    def links(self, n: int) -> str:
        draw = self.draw
        told = [f'<a href="/{i}">{self.phrase(1, 5)}</a>' for i in range(n)]
        shape = draw.randrange(4)
        if shape == 0:
            return "<ul>" + "".join(f"<li>{t}</li>" for t in told) + "</ul>"
        if shape == 1:
            return draw.choice([" | ", " ", " · ", " » "]).join(told)
        if shape == 2:
            return "<ul>" + "".join(f"<li>{t}" for t in told) + "</ul>"
        return "".join(f"<div>{t}</div>" for t in told)

    def boilerplate(self, kind: str) -> str:
        draw = self.draw
        if kind == "menu" or kind == "share":
            inside = self.links(draw.randint(2, 9))
        elif kind == "header":
            inside = draw.choice([f"<h1>{self.phrase(1, 4)}</h1>", f"<div>{self.phrase(1, 5)}</div>", f'<a href="/">{self.phrase(1, 3)}</a>', f"<p>{self.phrase(2, 8)}</p>", self.phrase(1, 6)])
            inside += draw.choice(["", self.links(3), f"<p>{self.phrase(2, 10)}</p>"])
        elif kind == "footer":
            inside = draw.choice([f"&copy; {self.phrase(1, 8)}", f"<p>&copy; 2024 {self.phrase(1, 12)}.</p>", self.links(4) + f"<p>{self.phrase(2, 12)}</p>", f"<small>{self.sentence(3, 20)}</small>", f"&copy; {self.phrase(1, 2)} &middot; {self.sentence(2, 12)}"])
        elif kind == "sidebar":
            inside = f"<h{draw.randint(2, 4)}>{self.phrase(1, 4)}</h3>" + draw.choice([self.links(5), f"<p>{self.sentence(4, 30)}</p>", f"<p>{self.sentence(4, 20)}</p>" + self.links(2)])
        elif kind == "notice" or kind == "advert":
            inside = draw.choice([self.sentence(3, 40), f"<p>{self.sentence(3, 40)}</p>", f"<p>{self.sentence(3, 25)}</p><p>{self.sentence(3, 25)}</p>", f'<a href="/x">{self.phrase(2, 10)}</a>', f'{self.sentence(5, 30)} <a href="/x">{self.phrase(1, 3)}</a><button>{self.phrase(1, 2)}</button>'])
        elif kind == "form":
            inside = f"<label>{self.phrase(1, 4)}</label><input name=q>" + draw.choice(["", f"<p>{self.sentence(3, 20)}</p>", f"<button>{self.phrase(1, 2)}</button>"])
            if draw.random() < 0.5:
                inside = f"<form>{inside}</form>"
        else:
            inside = draw.choice(["", f"<h{draw.randint(2, 4)}>{self.phrase(1, 3)}</h3>"])
            for _ in range(draw.randint(1, 5)):
                said = draw.choice([f"<p>{self.sentence(3, 60)}</p>", self.sentence(3, 60), f"<p>{self.sentence(3, 40)}</p><p>{self.sentence(3, 40)}</p>"])
                by = draw.choice(["", f"<b>{self.phrase(1, 2)}</b>", f'<span class="author">{self.phrase(1, 2)}</span>', f"<div>{self.phrase(1, 3)}</div>"])
                inside += draw.choice([f'<div class="{draw.choice(BOILERPLATE[kind])}">{by}{said}</div>', f"<li>{by}{said}</li>", f"<div>{by}{said}</div>"])
        return self.tagged(kind, BOILERPLATE[kind], inside)

    def block(self) -> str:
        draw, sign = self.draw, self.SIGN
        shape = draw.random()
        if shape < 0.62:
            return f"<p>{sign}{self.sentence(1, 400)}</p>"
        if shape < 0.68:
            return f'<p>{sign}{self.phrase(2, 20)} <a href="/x">{self.phrase(1, 4)}</a> {self.sentence(3, 40)}</p>'
        if shape < 0.74:
            return f"<p><b>{sign}{self.phrase(1, 400)}<br>"
        if shape < 0.80:
            return f"<h{draw.randint(2, 4)}>{sign}{self.phrase(1, 9)}</h2>"
        if shape < 0.86:
            return "<ul>" + "".join(f"<li>{sign}{self.sentence(2, 25)}</li>" for _ in range(draw.randint(2, 5))) + "</ul>"
        if shape < 0.90:
            return f"<blockquote>{sign}{self.sentence(4, 50)}</blockquote>"
        if shape < 0.93:
            return f"<table><tr><td>{sign}{self.phrase(1, 6)}</td><td>{sign}{self.phrase(1, 6)}</td></tr></table>"
        if shape < 0.96:
            return f"<pre>{sign}{self.phrase(3, 30)}</pre>"
        return f"<figure><img src=x><figcaption>{sign}{self.sentence(3, 15)}</figcaption></figure>"

    def article(self) -> str:
        draw, sign = self.draw, self.SIGN
        blocks = [self.block() for _ in range(int(1 * 20 ** draw.random()))]
        if draw.random() < 0.7:
            blocks.insert(0, f"<h1>{sign}{self.phrase(1, 12)}</h1>")
        if draw.random() < 0.3:
            blocks.insert(draw.randint(0, len(blocks)), self.boilerplate(draw.choice(["advert", "share", "sidebar", "form", "menu"])))
        if draw.random() < 0.1:
            blocks.append(self.boilerplate("comments"))
        inside = "".join(blocks)
        shape = draw.random()
        if shape < 0.4:
            name = f' class="{draw.choice(CONTENT)}"' if draw.random() < 0.5 else ""
            tag = draw.choice(["article", "article", "main"])
            return f"<{tag}{name}>{inside}</{tag}>"
        if shape < 0.85:
            return f'<{draw.choice(["div", "div", "section"])} {draw.choice(["class", "id"])}="{draw.choice(CONTENT)}">{inside}</div>'
        if shape < 0.92:
            return f"<table><tr><td>{self.links(4)}</td><td>{inside}</td></tr></table>"
        return f"<div>{inside}</div>"

    def page(self) -> str:
        draw = self.draw
        before = [self.boilerplate(draw.choice(["menu", "header", "notice", "advert", "sidebar", "form", "share"])) for _ in range(draw.randint(0, 4))]
        after = [self.boilerplate(draw.choice(["footer", "footer", "comments", "comments", "sidebar", "notice", "advert", "form", "share", "menu"])) for _ in range(draw.randint(0, 4))]
        inside = "".join([*before, self.article(), *after])
        for _ in range(draw.randint(0, 2)):
            inside = f'<div {draw.choice(["class", "id"])}="{draw.choice(WRAPPERS)}">{inside}</div>'
        return f"<!DOCTYPE html><html><head><title>{self.phrase(1, 9)}</title></head><body>{inside}</body></html>"


def _unsigned(tree: Tree) -> tuple[Tree, list[int]]:
    """A laid-out page without its signs, and its labels; features are made from the texts as they will be seen."""
    sign, inside, features, texts = Layouts.SIGN, [], [], []
    for text, told in zip(tree.texts, tree.features):
        inside.append(int(text is not None and sign in text))
        texts.append(text and SPACE.sub(" ", text.replace(sign, "")).strip())
        features.append(told)
    plain = tree._replace(texts=texts, features=features)
    return plain, _by_leaves(plain, inside)


def labelled_pages(sample: list[str], layouts: int = LAYOUTS, seed: int = 7) -> list[tuple[Tree, list[int]]]:
    """Training pages: those of the sample that mark their article, and layouts made of the sample's words."""
    told, words = [], []
    for page in sample:
        tree = parse(page)
        words += [w for text in tree.texts if text for w in text.split()[:400]]
        labels = _marked(tree)
        if labels is not None:
            told.append((tree, labels))
    made = Layouts(words, seed)
    return told + [_unsigned(parse(made.page())) for _ in range(layouts)]


def sample_of(pages: DataFrame, at_most: int = SAMPLE_PAGES) -> list[str]:
    """At most so many different pages of at most ``SAMPLE_CHARACTERS``, by a hash of the page."""
    fit_for = pages.select("html").where(F.col("html").isNotNull() & F.length("html").between(1, SAMPLE_CHARACTERS))
    keys = [r[0] for r in fit_for.select(F.xxhash64("html").alias("k")).distinct().orderBy(F.hash("k"), "k").limit(at_most).collect()]
    picked = fit_for.withColumn("k", F.xxhash64("html")).where(F.col("k").isin(keys)).groupBy("k").agg(F.min("html").alias("html"))
    return [r["html"] for r in picked.orderBy(F.hash("k"), "k").collect()]


class Extractor:
    """Main texts of batches of pages with a fitted model."""

    def __init__(self, model: Model):
        self.model = model

    def texts(self, pages: list[str | None]) -> list[str]:
        trees = [parse(page) if page else Tree([], [], [], [], []) for page in pages]
        forest = Forest(trees, self.model.names)
        content = forest.marginals(self.model)[0][:, 1] >= 0.5
        return [" ".join(t for t, keep in zip(tree.texts, content[start:]) if keep and t) for tree, start in zip(trees, forest.starts)]


def extract(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, layouts: int = LAYOUTS) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (with page_id, url, html)."""
    spark = pages.sparkSession
    short_batches(spark)
    shared = spark.sparkContext.broadcast(fit(labelled_pages(sample_of(pages, sample_pages), layouts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractor = Extractor(shared.value)
        for batch in batches:
            page_id, url, html = (batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url", "html"))
            texts = extractor.texts(html.to_pylist())
            yield pa.RecordBatch.from_arrays([page_id, url, pa.array(texts, pa.large_string()).cast(url.type), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
