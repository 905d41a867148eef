"""Operator 10: main text of web pages, by a linear-chain conditional random field.

A page is a chain of leaf blocks. A block's features are the tags around it, the words of their
classes and ids, and the shape of its own text; two labels, main text or not, follow each
other with learned weights. The field is trained by gradient ascent on its likelihood, on pages
that are labelled because they are composed here: seeded layouts of menus, notices, articles,
sidebars, comments and footers as sites write them, some with and some without the elements that
name their purpose. Viterbi decodes a page.

The text of the main blocks is joined by one line feed. Character references are decoded and
white space inside a block (``str.split``'s, ``<br>`` included) becomes one space. Nothing is
dropped or capped beyond blocks; pages are judged one by one, in tasks without a shuffle.

Null and empty pages have an empty text. Repeated rows and ids come back each, null ids and urls
stay null, empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from staytally.llm import words as W
from staytally.llm.markup import Block, blocks

PAGES, STEPS, SEED = 400, 200, 5

# How sites mark the parts of a page.
_MARKS = {
    "menu": "menu nav navbar navigation topnav mainmenu breadcrumb breadcrumbs pagination pager tabs toolbar skip",
    "header": "header masthead banner topbar branding logo sitetitle",
    "footer": "footer colophon copyright legal bottom imprint sitefooter",
    "side": "sidebar side aside widget related recommended trending popular tags archive author-box rail",
    "notice": "notice cookie consent gdpr alert popup modal overlay message warning toast paywall",
    "advert": "ad ads advert advertisement adsense promo promotion sponsored sponsor banner-ad commercial",
    "form": "form newsletter subscribe signup login search contact register",
    "comments": "comments comment comment-list reply replies respond discussion disqus thread reader",
    "share": "share social sharing follow buttons likes",
}
_TAGS = {
    "menu": "nav nav ul div div", "header": "header header div", "footer": "footer footer div div",
    "side": "aside aside div section", "notice": "div div section p", "advert": "div div aside ins",
    "form": "form form div", "comments": "section div div ol", "share": "div ul",
}
_MAIN_MARKS = (
    "article content main post entry story body text post-content entry-content article-body"
    " maincontent prose page blog-post"
).split()
_PHRASES = {
    "notice": "We use cookies to improve your visit. Accept all",
    "footer": "© All rights reserved. Privacy Terms",
    "form": "Subscribe to our newsletter Email",
    "share": "Share this on",
    "advert": "Advertisement Buy now",
    "comments": "Reply",
}


class _Composer:
    """Seeded pages; every element with text carries its label."""

    def __init__(self, random) -> None:
        self.random = random

    def pick(self, options):
        return options[int(self.random.integers(len(options)))]

    def words(self, low: int, high: int) -> str:
        letters = "etaoinshrdlu"
        out = []
        for _ in range(int(self.random.integers(low, high + 1))):
            size = int(self.random.integers(1, 9))
            out.append("".join(letters[i] for i in self.random.integers(0, len(letters), size)))
        return " ".join(out)

    def sentences(self, low: int, high: int) -> str:
        count = int(self.random.integers(low, high + 1))
        return " ".join(self.words(3, 18).capitalize() + self.pick(".....,?!") for _ in range(count))

    def attribute(self, mark: str) -> str:
        return f' {self.pick(("class", "class", "id"))}="{mark}"'

    def part(self, kind: str) -> str:
        tag = self.pick(_TAGS[kind].split())
        plain = tag != "div" and self.random.random() < 0.5
        attribute = "" if plain else self.attribute(self.pick(_MARKS[kind].split()))
        if kind in ("menu", "share"):
            inner = "".join(f'<li><a href="/x">{self.words(1, 3)}</a></li>' for _ in range(6))
            inner = inner if tag == "ul" else f"<ul>{inner}</ul>"
        elif kind == "comments":
            inner = "".join(f"<div><p>{self.sentences(1, 4)}</p></div>" for _ in range(3))
        elif kind == "side":
            inner = f"<h3>{self.words(1, 4)}</h3>" + "".join(
                f"<p>{self.sentences(1, 2)}</p>" if self.random.random() < 0.5 else f'<li><a href="/x">{self.words(2, 8)}</a></li>'
                for _ in range(4)
            )
        elif kind == "form":
            inner = f"<label>{self.words(1, 3)}</label><input><button>{self.words(1, 2)}</button>"
        else:
            inner = self.sentences(1, 3)
        if kind in _PHRASES and self.random.random() < 0.5:
            inner += f"<p>{_PHRASES[kind]}</p>"
        return f'<{tag}{attribute} data-label="no">{inner}</{tag}>'

    def article(self) -> str:
        blocks = [f"<h1>{self.words(2, 10)}</h1>"] if self.random.random() < 0.8 else []
        paragraph = "div" if self.random.random() < 0.15 else "p"
        bare = self.random.random() < 0.2  # text right inside the article, between other blocks
        for _ in range(int(self.random.integers(1, 12))):
            roll = self.random.random()
            if roll < 0.75:
                text = self.sentences(1, 7) if self.random.random() < 0.8 else self.words(1, 5)
                if self.random.random() < 0.15:
                    text = f'<b>{text}' if self.random.random() < 0.5 else f'{text} <a href="/x">{self.words(1, 4)}</a>'
                blocks.append(text if bare else f"<{paragraph}>{text}</{paragraph}>")
            elif roll < 0.82:
                blocks.append(f"<h2>{self.words(1, 7)}</h2>")
            elif roll < 0.9:
                blocks.append("<ul>" + "".join(f"<li>{self.words(1, 12)}</li>" for _ in range(3)) + "</ul>")
            elif roll < 0.95:
                blocks.append(f"<blockquote>{self.sentences(1, 3)}</blockquote>")
            else:
                blocks.append(f"<pre><code>{self.words(3, 20)}</code></pre>")
        if self.random.random() < 0.15:  # an article may speak of these, too
            blocks.append(f"<p>{self.pick(list(_PHRASES.values()))}</p>")
        for kind in ("advert", "share", "notice"):
            if self.random.random() < 0.12:
                blocks.insert(int(self.random.integers(len(blocks) + 1)), self.part(kind))
        roll = self.random.random()
        if roll > 0.88:
            return f'<div data-label="yes">{"".join(blocks)}</div>'
        tag = "article" if roll < 0.45 else "main" if roll < 0.6 else self.pick(("div", "div", "section"))
        attribute = self.attribute(self.pick(_MAIN_MARKS)) if tag in ("div", "section") or self.random.random() < 0.3 else ""
        return f'<{tag}{attribute} data-label="yes">{"".join(blocks)}</{tag}>'

    def page(self) -> str:
        before = [k for k in ("header", "menu", "notice", "advert", "form") if self.random.random() < 0.6]
        after = [k for k in ("side", "comments", "form", "advert", "share", "menu", "footer") if self.random.random() < 0.5]
        inner = "".join(map(self.part, before)) + self.article() + "".join(map(self.part, after))
        if self.random.random() < 0.4:
            inner = f'<div class="{self.pick(("wrapper", "container", "page", "site", "row"))}">{inner}</div>'
        return f"<html><head><title>{self.words(1, 5)}</title></head><body>{inner}</body></html>"


def labelled_pages(n: int, seed: int = SEED) -> list[tuple[list[Block], list[bool]]]:
    composer, out = _Composer(np.random.default_rng(seed)), []
    for _ in range(n):
        found = blocks(composer.page())
        # Inside an article, a part that is not of it carries both labels.
        truth = ["label:yes" in b.names and "label:no" not in b.names for b in found]
        out.append((found, truth))
    return out


def _inside(block: Block) -> bool:
    return "tag:article" in block.names or "tag:main" in block.names


def _shape(block: Block, inside: bool) -> list[str]:
    text = block.text
    size, share = len(text), block.linked / len(text)
    out = [
        f"words:{min(6, (text.count(' ') + 1).bit_length())}",
        f"linked:{0 if share == 0 else 1 if share < 0.5 else 2}",
        f"ends:{'stop' if text[-1] in '.!?:;…”\"' else 'open'}",
        f"in:{block.tag}",
    ]
    if inside:  # what an article says of rights and cookies is its own
        return out
    if "©" in text[:80] or "rights reserved" in text.lower():
        out.append("has:rights")
    if size < 400 and ("cookie" in text.lower() or "newsletter" in text.lower()):
        out.append("has:notice")
    return out


def _page_names(found: list[Block]) -> str:
    return "named" if any(map(_inside, found)) else "plain"


def _features(block: Block, page: str) -> list[str]:
    names = [n for n in block.names if not n.startswith("label:")]
    inside = _inside(block)
    return [*names, *_shape(block, inside), f"{page}:{'inside' if inside else 'outside'}", "any"]


@dataclass
class Field:
    """Weights for a block being main text, and of a label after another."""

    weights: dict[str, float]
    start: np.ndarray
    follow: np.ndarray

    def decode(self, found: list[Block], cache: dict | None = None) -> list[bool]:
        """Viterbi."""
        if not found:
            return []
        get, page, back = self.weights.get, _page_names(found), []
        cache = {} if cache is None else cache
        (a, b), follow = self.start.tolist(), self.follow.tolist()
        for at, block in enumerate(found):
            around = cache.get((block.names, page))
            if around is None:
                inside = _inside(block)
                around = sum(get(n, 0.0) for n in block.names) + get("any", 0.0)
                around += get(f"{page}:{'inside' if inside else 'outside'}", 0.0)
                around = around, inside
                if len(cache) < 50_000:
                    cache[block.names, page] = around
            own = around[0] + sum(get(n, 0.0) for n in _shape(block, around[1]))
            if at:
                from_a, from_b = a + follow[0][0], b + follow[1][0]
                to_a, to_b = a + follow[0][1], b + follow[1][1]
                back.append((from_b > from_a, to_b > to_a))
                a, b = max(from_a, from_b), max(to_a, to_b)
            b += own
        label = b > a
        out = [label]
        for first, second in reversed(back):
            label = second if label else first
            out.append(label)
        return out[::-1]


class Chains:
    """Labelled pages side by side: place by place, the sums of every chain move on together."""

    def __init__(self, pages: list[tuple[list[Block], list[bool]]]) -> None:
        self.index: dict[str, int] = {}
        chains = []
        for found, truth in pages:
            page = _page_names(found)
            rows = [[self.index.setdefault(n, len(self.index)) for n in _features(b, page)] for b in found]
            if rows:
                chains.append((rows, np.array(truth, int)))
        self.width = max(len(rows) for rows, _ in chains)
        self.inside = np.zeros((len(chains), self.width), bool)
        self.truth = np.zeros((len(chains), self.width), int)
        flat, owner = [], []
        for c, (rows, labels) in enumerate(chains):
            self.inside[c, : len(rows)] = True
            self.truth[c, : len(rows)] = labels
            for place, row in enumerate(rows):
                flat += row
                owner += [c * self.width + place] * len(row)
        self.flat, self.owner = np.array(flat), np.array(owner)
        self.pair = self.inside[:, 1:]
        self.seen = np.zeros((2, 2))
        np.add.at(self.seen, (self.truth[:, :-1][self.pair], self.truth[:, 1:][self.pair]), 1)
        self.first = np.bincount(self.truth[:, 0], minlength=2)
        self.blocks = self.inside.sum()

    def slopes(self, weights: np.ndarray, follow: np.ndarray, start: np.ndarray):
        """Of the log likelihood a block, by forward and backward sums."""
        inside, n = self.inside, self.blocks
        own = np.bincount(self.owner, weights[self.flat], inside.size).reshape(inside.shape)
        score = np.stack([np.zeros_like(own), own], 2)
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = score[:, 0] + start
        for k in range(1, self.width):
            step = np.logaddexp.reduce(forward[:, k - 1, :, None] + follow, axis=1) + score[:, k]
            forward[:, k] = np.where(inside[:, k, None], step, forward[:, k - 1])
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        for k in range(self.width - 2, -1, -1):
            after = score[:, k + 1] + backward[:, k + 1]
            step = np.logaddexp.reduce(follow + after[:, None, :], axis=2)
            backward[:, k] = np.where(inside[:, k + 1, None], step, 0)
        marginal = np.exp(forward + backward - total[:, None, None])
        joint = (
            forward[:, :-1, :, None] + follow + (score + backward)[:, 1:, None, :]
        ) - total[:, None, None, None]
        miss = np.where(inside, self.truth - marginal[..., 1], 0).ravel()[self.owner]
        return (
            np.bincount(self.flat, miss, len(self.index)) / n,
            (self.seen - np.exp(joint[self.pair]).sum(0)) / n,
            (self.first - marginal[:, 0].sum(0)) / n,
        )


def train(pages: list[tuple[list[Block], list[bool]]], steps: int = STEPS) -> Field:
    """Adagrad on the log likelihood."""
    chains = Chains(pages)
    weights, follow, start = np.zeros(len(chains.index)), np.zeros((2, 2)), np.zeros(2)
    squares = [np.full(w.shape, 1e-6) for w in (weights, follow, start)]
    for _ in range(steps):
        slopes = chains.slopes(weights, follow, start)
        for w, g, s, decay in zip((weights, follow, start), slopes, squares, (1e-5, 0, 0), strict=True):
            g = g - decay * w
            s += g * g
            w += 0.3 * g / np.sqrt(s)
    return Field({name: float(weights[i]) for name, i in chains.index.items()}, start, follow)


def main_text(html: str | None, field: Field, known: dict, cache: dict) -> str:
    found = blocks(html or "", known)
    return "\n".join(b.text for b, y in zip(found, field.decode(found, cache), strict=True) if y)


def extract(
    pages: DataFrame,
    *,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    training_pages: int = PAGES,
) -> DataFrame:
    """Per row: page_id, url, text and n_chars."""
    field = train(labelled_pages(training_pages))
    held = pages.sparkSession.sparkContext.broadcast(field)
    pages = pages.select(F.col(id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cache = {}, {}
        for batch in W.slices(batches, "html"):
            texts = [main_text(h, held.value, known, cache) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    schema = StructType([StructField(f.name, f.dataType) for f in pages.schema.fields[:2]])
    return pages.mapInArrow(run, schema.add("text", "string").add("n_chars", "long"))
