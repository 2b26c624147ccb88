"""Main text of web pages: a bidirectional LSTM labels every leaf block of a page."""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from functools import lru_cache
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm import lstm
from farebox.llm.bytes import row_slices, space_table, text_chunks, words_of
from farebox.llm.html_blocks import Block, Element, blocks
from farebox.llm.sample import first_by_hash
from farebox.llm.session import bound_batches

SAMPLE = 192  # pages that the labeller learns from
SAMPLE_BYTES = 1 << 18  # a longer page is not learnt from, so the driver holds SAMPLE times this at most
DRAWN = 5  # re-templated pages for each of them
PATH_SLOTS, WORD_SLOTS = 256, 32
DENSE, HIDDEN, EPOCHS = 32, 24, 10
PADDED = 1 << 13  # blocks of a padded batch; a longer page is a batch of its own

#: Where sites put the article, and what else they put on a page. Fixed values, in use on the web.
CONTENT = (
    ("article", ""), ("main", ""), ("article", "post"), ("div", "content"), ("div", "main-content"), ("div", "post-body"),
    ("div", "entry-content"), ("section", "article-body"), ("div", "story"), ("div", "article"), ("div", "post"),
    ("div", "page-content"), ("section", "main"), ("div", "article-text"), ("div", "body"), ("div", ""), ("div", "entry"),
    ("div", "blog-post"), ("article", "single"), ("div", "article-content"), ("section", "text"), ("div", "post-content"),
)
OTHERS = {
    "menu": (("nav", ""), ("div", "menu"), ("ul", "nav"), ("div", "navbar"), ("div", "breadcrumbs"), ("ul", "menu"),
             ("div", "navigation"), ("div", "topbar"), ("menu", ""), ("div", "toc"), ("div", "pagination"), ("div", "main-nav"),
             ("ol", "breadcrumb"), ("ul", "categories"), ("div", "nav-menu")),
    "header": (("header", ""), ("div", "header"), ("div", "masthead"), ("div", "site-header"), ("header", "banner"), ("div", "logo"),
               ("div", "page-header"), ("header", "top")),
    "footer": (("footer", ""), ("div", "footer"), ("div", "site-footer"), ("div", "copyright"), ("footer", "bottom"), ("div", "legal"),
               ("div", "page-footer"), ("section", "colophon")),
    "sidebar": (("aside", ""), ("div", "sidebar"), ("div", "widget"), ("div", "related"), ("div", "recommended"),
                ("aside", "rail"), ("div", "trending"), ("section", "side"), ("div", "side-bar"), ("div", "related-posts"),
                ("div", "popular"), ("div", "widgets")),
    "notice": (("div", "cookie-notice"), ("div", "notice"), ("div", "consent"), ("div", "alert"), ("div", "popup"),
               ("div", "newsletter"), ("div", "subscribe"), ("div", "modal"), ("dialog", ""), ("div", "gdpr"), ("div", "paywall"),
               ("div", "cookies"), ("div", "cookie-banner"), ("section", "privacy"), ("div", "notification"), ("div", "warning")),
    "advert": (("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "advertisement"), ("div", "sponsored"),
               ("aside", "promo"), ("section", "ad"), ("div", "sponsor"), ("div", "ad-container"), ("div", "banner-ad"),
               ("div", "promotion"), ("ins", "adsbygoogle")),
    "form": (("form", ""), ("div", "login"), ("div", "search"), ("form", "signup"), ("fieldset", ""), ("form", "contact"),
             ("div", "search-form"), ("form", "poll")),
    "comments": (("section", "comments"), ("div", "comments"), ("div", "comment"), ("ol", "commentlist"), ("div", "replies"),
                 ("ul", "reader-comments"), ("div", "discussion"), ("div", "disqus"), ("section", "responses"),
                 ("div", "comment-list"), ("div", "user-comments"), ("ol", "comments-area"), ("div", "reviews")),
    "share": (("div", "share"), ("div", "social"), ("ul", "share-buttons"), ("div", "tags"), ("div", "byline-links"),
              ("div", "sharing"), ("div", "social-media")),
}
_MAIN_TAGS = {"article", "main"}
_OTHER_TAGS = {tag for kind in OTHERS.values() for tag, name in kind if not name and tag not in ("section", "div")} | {
    "select", "template", "svg", "button", "label", "datalist"
}
_OTHER_NAMES = {name for kind in OTHERS.values() for _, names in kind for name in names.split("-") if name} - {
    "main", "body", "post", "posts", "article", "side", "site", "bottom", "top", "page", "reader", "user", "byline", "links",
    "buttons", "container", "area", "list", "media", "bar"
}
_CONTAINERS = frozenset("html body main article section div center table tbody tr td".split())
_STOPS = (".", "!", "?", '"', "”", "»")
_MARK = "\ue000"  # a private-use character


def _is_other(element: Element) -> bool:
    return element.tag in _OTHER_TAGS or not _OTHER_NAMES.isdisjoint(element.names)


def weak_labels(page: list[Block]) -> list[int] | None:
    """1 for blocks in an article or main element and in nothing else that is named in OTHERS; None
    for a page without such an element."""
    if not any(e.tag in _MAIN_TAGS for b in page for e in b.path):
        return None
    return [int(any(e.tag in _MAIN_TAGS for e in b.path) and not any(map(_is_other, b.path))) for b in page]


def likely_labels(page: list[Block]) -> list[int]:
    """Labels of a page whose markup names no article: the blocks of the container that holds most prose,
    less those that are named in OTHERS.

    Prose is the text outside links of blocks that are no such other part; a block that ends like a
    sentence counts in full, any other a quarter. A container loses what prose is in it to the one inside
    that has four fifths of it. Without any prose all blocks that are in no other part are taken.
    """
    other = [any(map(_is_other, b.path)) for b in page]
    prose = [0 if o else (len(b.text) - b.linked) * (4 if b.text[-1:] in _STOPS else 1) for b, o in zip(page, other)]
    within = [[e for e in b.path if e.tag in _CONTAINERS] for b in page]
    low, high, depth, total = 0, len(page), 0, sum(prose)
    while total:
        best = None
        at = low
        while at < high:  # runs of blocks that share one more container
            end = at + 1
            while end < high and within[end][: depth + 1] == within[at][: depth + 1]:
                end += 1
            if len(within[at]) > depth and sum(prose[at:end]) >= 0.8 * total:
                best = at, end
            at = end
        if best is None:
            break
        low, high, depth, total = *best, depth + 1, sum(prose[best[0] : best[1]])
    return [int(low <= i < high and not o) for i, o in enumerate(other)]


def _renamed(page: list[Block], rng: random.Random) -> list[Block]:
    """The page with another tag and name, or none, in place of those that say it is the article."""
    tag = rng.choice(("div", "div", "section"))
    drawn = "".join(rng.choice("abcdefghijklmnoprstuvwxyz") for _ in range(rng.randint(2, 8)))
    names = rng.choice(((), (drawn,)))
    return [b._replace(path=tuple(Element(tag, names) if e.tag in _MAIN_TAGS else e for e in b.path)) for b in page]


def _draw_page(content: list[Block], texts: list[str], rng: random.Random) -> str:
    """A page of another template around the same article; its content is marked."""

    def sentence(long: bool) -> str:
        words = rng.choice(texts).split()
        size = rng.randint(6, 60) if long else rng.randint(1, 6)
        at = rng.randrange(max(1, len(words) - size))
        return escape(" ".join(words[at : at + size]))

    def other(kind: str) -> str:
        tag, name = rng.choice(OTHERS[kind])
        mark = f' {rng.choice(("class", "id"))}="{name}"' if name else ""
        if rng.random() < 0.3:
            mark = mark[:-1] + f' {rng.choice(("x", "box", "block", "wrap", "inner"))}"' if name else ""
        inner = []
        for _ in range(rng.randint(1, 6 if kind in ("menu", "comments", "sidebar") else 3)):
            long = kind in ("comments", "notice", "advert", "sidebar") and rng.random() < 0.7
            text = sentence(long)
            if kind in ("menu", "share") or (not long and rng.random() < 0.4):
                text = f'<a href="/{rng.randrange(99)}">{text}</a>'
            form = f"<label>{text}</label><input><button>{sentence(False)}</button>"
            inner.append(form if kind == "form" else rng.choice((f"<p>{text}</p>", f"<li>{text}</li>", f"<div>{text}</div>", f"<span>{text}</span><br>")))
        head = f"<h3>{sentence(False)}</h3>" if rng.random() < 0.3 else ""
        return f"<{tag}{mark}>{head}{''.join(inner)}</{tag}>"

    def some(*kinds: str) -> str:
        return "".join(other(k) for k in kinds if rng.random() < 0.5)

    tag, name = rng.choice(CONTENT)
    if rng.random() < 0.25:  # a name that says nothing: order, sizes and the other blocks must tell
        name = "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(3, 8)))
    parts = []
    for i, block in enumerate(content):
        leaf = block.path[-1].tag if block.path and block.path[-1].tag in ("h1", "h2", "h3", "p", "li", "blockquote") else "p"
        if i and rng.random() < 0.08:
            leaf = rng.choice(("h2", "h3", "li", "blockquote", "td", "pre"))
        parts.append(f"<{leaf}>{_MARK}{escape(block.text)}</{leaf}>")
        if rng.random() < 0.06:
            parts.append(other(rng.choice(("advert", "share", "sidebar", "notice", "form"))))
    end = some("share", "comments", "form") if rng.random() < 0.4 else ""
    mark = f' {rng.choice(("class", "id"))}="{name}"' if name else ""
    article = f"<{tag}{mark}>{''.join(parts)}{end}</{tag}>"
    before = some("notice", "header", "menu", "advert", "form", "sidebar")
    after = some("share", "comments", "sidebar", "advert", "form", "menu") + some("footer", "notice")
    wrap = rng.choice(("<body>{}</body>", "<body><div id=wrapper>{}</div></body>", "<body><div class=page><div>{}</div></div></body>"))
    return wrap.format(before + article + after)


@lru_cache(maxsize=1 << 14)
def _path_vector(path: tuple[Element, ...]) -> np.ndarray:
    """Hashed tags and names of a path, the beginnings of names, and the last three elements apart."""
    out = np.zeros(PATH_SLOTS, dtype=np.float32)
    for depth, element in enumerate(path[::-1]):
        tokens = [element.tag, *("." + n for n in element.names)]
        if depth < 3:
            tokens += [f"{depth}:{t}" for t in tokens]
        tokens += ["^" + n[:4] for n in element.names]  # cookie, cookies; comment, commentlist
        for token in tokens:
            spot = zlib.crc32(token.encode())
            out[spot % PATH_SLOTS] += 1
            out[(spot >> 12) % PATH_SLOTS] += 1
    return np.minimum(out, 2)


def features(page: list[Block]) -> np.ndarray:
    """(blocks, inputs): hashed tag path, hashed words, sizes, place of each block, and whether it is in the
    container that holds most of the page's prose."""
    column = pa.array([b.text.encode("utf-8", "replace") for b in page], pa.binary())
    words = np.zeros((len(page), WORD_SLOTS), dtype=np.float32)
    count = np.zeros(len(page), dtype=np.float32)
    for chunk in text_chunks(column):
        rows, found = chunk.hi - chunk.lo, words_of(chunk, space_table(), seed=21)
        slot = found.row * WORD_SLOTS + (found.hash % np.uint64(WORD_SLOTS)).astype(np.int64)
        sign = np.where(found.hash >> np.uint64(63), 1.0, -1.0)
        words[chunk.lo : chunk.hi] = np.bincount(slot, weights=sign, minlength=rows * WORD_SLOTS).reshape(rows, -1)
        count[chunk.lo : chunk.hi] = np.bincount(found.row, minlength=rows)
    words /= np.sqrt(np.maximum(count, 1))[:, None] * 2
    place = np.arange(len(page), dtype=np.float32)
    other = np.stack(
        [
            np.log1p(np.array([len(b.text) for b in page], dtype=np.float32)) / 6,
            np.log1p(count) / 5,
            np.array([b.linked / len(b.text) for b in page], dtype=np.float32),
            np.array([b.text[-1] in ".!?" for b in page], dtype=np.float32),
            np.array(["©" in b.text[:80] for b in page], dtype=np.float32),
            place / max(1, len(page)),
            1 / (1 + place),
            1 / (1 + place[::-1]),
            np.array(likely_labels(page), dtype=np.float32),
        ],
        axis=1,
    )
    paths = np.stack([_path_vector(b.path) for b in page])
    return np.concatenate([paths, words, other.astype(np.float32)], axis=1)


def fit(pages: list[str], seed: int = 1) -> lstm.Weights | None:
    """Learn from pages whose markup names the article: as they are, with that name taken off, and in other
    templates. If no page names it, from those where ``likely_labels`` finds prose; None if there are no blocks.
    """
    rng = random.Random(seed)
    parsed = [p for p in map(blocks, pages) if p]
    known = [(p, y) for p in parsed if (y := weak_labels(p)) is not None] or [(p, likely_labels(p)) for p in parsed]
    if not known:
        return None
    texts = [b.text for p, _ in known for b in p if b.text]
    sequences, labels = [], []
    for page, label in known:
        sequences += [features(page), features(_renamed(page, rng))]
        labels += [np.array(label, dtype=np.float32)] * 2
        content = [b for b, y in zip(page, label) if y]
        for _ in range(DRAWN if content else 0):
            drawn = blocks(_draw_page(content, texts, rng))
            labels.append(np.array([b.text.startswith(_MARK) for b in drawn], dtype=np.float32))
            sequences.append(features([b._replace(text=b.text.replace(_MARK, "") or " ") for b in drawn]))
    return lstm.train(sequences, labels, DENSE, HIDDEN, EPOCHS)


def label(weights: lstm.Weights, pages: list[list[Block]]) -> list[np.ndarray]:
    """For each page, whether each block is main text. Pages of like size are run together."""
    out: list[np.ndarray] = [np.zeros(0, dtype=bool)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * len(pages[order[end]]) <= PADDED and end - at < 512:
            end += 1
        items, mask = lstm.padded([features(pages[i]) for i in order[at:end]])
        found = lstm.scores(weights, items, mask) >= 0.5
        for b, i in enumerate(order[at:end]):
            out[i] = found[: len(pages[i]), b]
        at = end
    return out


RESULT = "page_id long, url string, text string, n_chars long"


def _extract(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            for part in row_slices(batch, 512):
                pages = [blocks(h.as_py()) for h in part.column(2)]
                found = label(weights, pages) if weights else [np.array(likely_labels(p), dtype=bool) for p in pages]
                texts = ["\n".join(b.text for b, y in zip(p, keep) if y) for p, keep in zip(pages, found)]
                columns = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return run


def main_text(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    The page is parsed into leaf blocks, each with its tag path. A bidirectional LSTM reads the
    hashed path and word vectors of all of a page's blocks in order, so that the whole document
    decides on each block; those labelled main text are joined by a line feed, whole and in order.
    It learns in numpy on the driver from the first ``sample`` pages by a hash of their id (of pages that
    share one, the first by text), chosen among those with an ``article`` or ``main`` element; only if
    there is none, among all: blocks that this markup puts in or out of the article, the same with its name taken
    off, and the same articles in drawn templates with other containers, menus, notices, adverts,
    forms, sidebars and comments. Pages of more than ``SAMPLE_BYTES`` bytes are not learnt from.

    The article's own headings belong to its text. A null or empty page gives an empty text. If no page names
    its article, the labeller learns from the container that holds most prose (``likely_labels``), and if
    there is no page to learn from at all, that is the text; menus never are. Very long pages are
    labelled whole. Repeated rows are separate rows, and no pages give none. Weights of fixed size are all
    that is broadcast.
    """
    bound_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    short = rows.where(F.octet_length("html").between(1, SAMPLE_BYTES))
    named = short.where(F.col("html").rlike(r"(?i)<(article|main)[\s>/]"))
    count = named.count()
    source = named if count else short
    ids = first_by_hash(source, "page_id", sample, count or source.count(), seed=1)
    chosen = source.join(F.broadcast(ids), "page_id")  # at most ``sample`` ids
    first = chosen.groupBy("page_id").agg(F.min("html").alias("html")).orderBy("page_id")
    weights = fit([r.html for r in first.collect()])
    shared = pages.sparkSession.sparkContext.broadcast(weights)
    return rows.mapInArrow(_extract(shared), RESULT)
