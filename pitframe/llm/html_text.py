"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the page.

A page becomes a sequence of blocks: the text between two boundaries of block-level elements, white space folded, character
references decoded. Scripts, styles, templates, frames and comments never become text. Each block has features of its ancestors (tags and
the words of their class, id and role), of its own element and of its text (length, share of link text, closing mark). The
field labels every block as main text or not, and Viterbi finds the best labelling of the page as a whole.

It is trained on the labelled pages made by ``labelled_pages``: invented text in many layouts, with menus, headers, footers, side
bars, notices, adverts, forms and reader comments around and inside of the article.

Pages are judged one by one: one pass over the table, no shuffle.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pitframe.llm import crf
from pitframe.llm.shingles import chunks

# Element names by their role in HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr svg math canvas object".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template iframe".split())
FOREIGN = frozenset("svg math".split())  # elements of other languages; there, a tag can close itself
LEAVES = frozenset("blockquote body center dd div dl dt h1 h2 h3 h4 h5 h6 head hr li menu ol p pre table ul".split())  # these end one that was never closed
UNSEEN = frozenset("title desc metadata".split())  # descriptions of a drawing, not text of the page
CLOSES = {
    "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr", "td", "th")),
    "td": frozenset(("td", "th")), "th": frozenset(("td", "th")), "option": frozenset(("option",)),
}
FENCES = frozenset("ul ol dl table select body html article section div".split())  # an implied end does not reach beyond these

FEATURES = 1 << 12
RESULT = "page_id bigint, url string, text string, n_chars bigint"


class Blocks(HTMLParser):
    """Collects (text, link characters, ancestors) of the leaf blocks; an ancestor is (tag, words of class, id and role)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, tuple[str, ...]]] = []
        self.blocks: list[tuple[str, int, tuple]] = []
        self.pieces: list[str] = []
        self.linked = 0
        self.hidden = 0
        self.foreign = 0
        self.links = 0

    def flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                path = tuple(x for x in self.stack if x[0] not in INLINE)
                self.blocks.append((text, self.linked, path))
            self.pieces = []
        self.linked = 0

    def _pop(self, to: int) -> None:
        while len(self.stack) > to:
            tag, _ = self.stack.pop()
            self.foreign -= tag in FOREIGN
            self.hidden -= self._hides(tag)
            self.links -= tag == "a"

    def _hides(self, tag: str) -> bool:
        return tag in HIDDEN or self.foreign > 0 and tag in UNSEEN

    def _breaks(self, tag: str) -> bool:
        """Whether a block ends where this tag stands; a formula or drawing is part of the line, but for the texts in the drawing."""
        return tag not in INLINE and (not self.foreign or tag == "text" or tag in LEAVES)

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.pieces.append(" ")
            return
        if self._breaks(tag):
            self.flush()
        if self.foreign and tag in LEAVES and not any(t == "foreignobject" for t, _ in self.stack):
            self._pop(next(at for at, (t, _) in enumerate(self.stack) if t in FOREIGN))
        if tag not in INLINE and not self.foreign:
            ends = CLOSES.get(tag, frozenset())
            for at in range(len(self.stack) - 1, -1, -1):
                open_tag = self.stack[at][0]
                if open_tag == "p" or open_tag in ends:
                    self._pop(at)
                elif open_tag in FENCES:
                    break
        if tag not in VOID:
            words = []
            for name, value in attrs:
                if name in ("class", "id", "role") and value:
                    words += re.findall("[a-z]+", value.lower())
            self.stack.append((tag, tuple(words)))
            self.hidden += self._hides(tag)
            self.foreign += tag in FOREIGN
            self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and (tag in INLINE or self.foreign or tag in ("iframe", "template")):
            self._pop(len(self.stack) - 1)

    def handle_endtag(self, tag):
        if self._breaks(tag):
            self.flush()
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                self._pop(at)
                break
            if tag in INLINE and tag not in FOREIGN and self.stack[at][0] not in INLINE:
                break

    def handle_data(self, data):
        if not self.hidden:
            self.pieces.append(data)
            if self.links:
                self.linked += len(data.strip())


def blocks(html: str) -> list[tuple[str, int, tuple]]:
    parser = Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.blocks


def _number(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=4).digest(), "little") % FEATURES


@lru_cache(maxsize=20_000)
def _path_features(path: tuple) -> tuple[int, ...]:
    tags = [tag for tag, _ in path if tag not in ("html", "body")]
    names = {"bias", f"own={tags[-1] if tags else ''}", f"parent={tags[-2] if len(tags) > 1 else ''}", f"depth={min(len(tags), 6)}"}
    names |= {f"in={tag}" for tag in tags} | {f"word={w}" for _, words in path for w in words}
    names |= {f"own word={w}" for w in (path[-1][1] if path else ())}
    return tuple(sorted(map(_number, names)))


@lru_cache(maxsize=20_000)
def _text_features(length: int, links: int, mark: str, copyright: bool) -> tuple[int, ...]:
    return tuple(_number(n) for n in (f"length={length}", f"links={links}", f"mark={mark}", f"copyright={copyright}", f"length={length}&links={links}"))


def features(page: list[tuple[str, int, tuple]]) -> list[tuple[int, ...]]:
    result = []
    for text, linked, path in page:
        mark = "end" if text[-1] in ".!?…\"'”»" else "colon" if text[-1] == ":" else "none"
        result.append(_path_features(path) + _text_features(min(len(text).bit_length(), 10), min(4 * linked // len(text), 4), mark, "©" in text or "copyright" in text.lower()))
    return result


# ---- labelled pages


def _words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(("an", "the", "on", "re", "ti", "ou", "é", "sch", "ción", "ing", "ble", "er")) for _ in range(rng.randint(1, 4))) for _ in range(n))


def _sentence(rng: random.Random, n: int) -> str:
    return _words(rng, n).capitalize() + rng.choice((".", ".", ".", "?", "!", "", ". 42"))


def _boilerplate(rng: random.Random, kind: str) -> str:
    links = lambda n: "".join(f'<li><a href="/{i}">{_words(rng, rng.randint(1, 2))}</a></li>' for i in range(n))
    short, long = _sentence(rng, rng.randint(2, 9)), _sentence(rng, rng.randint(10, 40))
    return {
        "menu": lambda: rng.choice((f"<nav><ul>{links(5)}</ul></nav>", f'<div class="menu"><ul>{links(4)}</ul></div>', f'<ul id="navigation" role="navigation">{links(4)}</ul>',
                                    f'<div class="breadcrumb"><a href="/">{_words(rng, 1)}</a> &gt; <a href="/a">{_words(rng, 1)}</a></div>', f'<nav class="top-nav"><a href="/">{_words(rng, 1)}</a> <a href="/b">{_words(rng, 2)}</a></nav>')),
        "header": lambda: rng.choice((f"<header><h1>{short}</h1><p>{long}</p></header>", f'<div id="header"><a href="/">{short}</a></div>', f"<header>{short}</header>", f'<div class="site-header header"><p>{short}</p></div>')),
        "footer": lambda: rng.choice((f"<footer>&copy; {short}</footer>", f"<footer><p>{long}</p><p>&copy; 2020 {short}</p></footer>", f'<div id="footer"><p>{long}</p></div>', f'<div class="footer">Copyright {short} &middot; {long}</div>')),
        "side": lambda: rng.choice((f"<aside><h3>{short}</h3><ul>{links(4)}</ul></aside>", f"<aside><p>{long}</p></aside>", f'<div class="sidebar"><h2>{short}</h2><p>{long}</p></div>', f'<div id="side-bar" class="widget related"><h4>{short}</h4><p>{long}</p></div>')),
        "notice": lambda: rng.choice((f'<div class="notice">{long}</div>', f'<div class="cookie-banner"><p>{long}</p><button>{short}</button></div>', f'<div id="consent" class="cookie notice">{long}</div>', f'<div class="banner alert" role="alert"><p>{long}</p></div>', f'<section class="newsletter subscribe"><p>{long}</p></section>')),
        "advert": lambda: rng.choice((f'<div class="ad">{long}</div>', f'<div class="ads"><p>{long}</p></div>', f'<div class="advert"><a href="/x">{short}</a><p>{long}</p></div>', f'<div class="sponsored promo">{long}</div>', f'<div id="ad-1" class="advertisement"><span>{short}</span></div>')),
        "form": lambda: rng.choice((f'<form><label>{short}</label><input type="text"><button>{_words(rng, 1)}</button></form>', f'<form class="search"><p>{long}</p><select><option>{_words(rng, 1)}<option>{_words(rng, 2)}</select></form>', f'<form><fieldset><legend>{short}</legend><textarea>{long}</textarea></fieldset></form>')),
        "comments": lambda: rng.choice((f'<div class="comments"><h3>{short}</h3><div class="comment"><p>{long}</p></div><div class="comment"><p>{long}</p></div></div>', f'<section id="comments"><ol><li><p>{long}</p></li><li>{short}</li></ol></section>', f'<div class="comment"><b>{_words(rng, 1)}</b><p>{long}</p></div>', f'<section class="reader-comments comments"><article class="comment"><p>{long}</p></article></section>')),
    }[kind]()


def _article(rng: random.Random) -> list[str]:
    parts = [f"<h1>{_sentence(rng, rng.randint(1, 12))}</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.randint(1, 9)):
        text = _sentence(rng, rng.choice((1, 2, 5, 20, 40, 80)))
        parts.append(rng.choice((
            f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br>", f"<p>{text} <a href='/z'>{_words(rng, 1)}</a> {_words(rng, 3)}.</p>", f"<p>{text}</p>", f"<h2>{_words(rng, 3)}</h2><p>{text}</p>",
            f"<ul><li>{text}</li><li>{_words(rng, 3)}</li></ul>", f"<blockquote>{text}</blockquote>", f"<pre>{text}</pre>", f"<table><tr><td>{_words(rng, 2)}</td><td>{text}</td></tr></table>", f"<div>{text}</div>", f"<section><p>{text}</p></section>")))
    return parts


def labelled_pages(pages: int = 240, seed: int = 5) -> list[tuple[str, list[int]]]:
    """(html, a label per block: 1 for main text). Main parts are told apart by where the generator put them."""
    rng = random.Random(seed)
    result = []
    for _ in range(pages):
        main = _article(rng)
        pieces = [(1, p) for p in main]
        for kind in rng.sample(("advert", "notice", "form", "side", "comments"), rng.choice((0, 0, 1, 2))):
            pieces.insert(rng.randint(0, len(pieces)) if kind != "comments" else len(pieces), (0, _boilerplate(rng, kind)))
        opening, closing = rng.choice((("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ('<main><article class="post">', "</article></main>"), ('<div id="content">', "</div>"),
                                       ('<div class="content">', "</div>"), ('<div class="entry-content post">', "</div>"), ('<div class="story article-body">', "</div>"), ("", "")))
        before = [(0, _boilerplate(rng, k)) for k in ("menu", "header", "notice", "advert", "form", "side") if rng.random() < 0.45]
        after = [(0, _boilerplate(rng, k)) for k in ("comments", "side", "advert", "form", "notice", "menu", "footer") if rng.random() < 0.45]
        rng.shuffle(before)
        everything = before + [(None, opening), *pieces, (None, closing)] + after
        html = f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{_words(rng, 4)}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>'
        labels = [0]
        done = html
        count = 1
        for label, piece in everything:
            done += piece
            if label is not None:
                now = len(blocks(done))
                labels += [label] * (now - count)
                count = now
        result.append((done + "</body></html>", labels))
    return result


def _encoded(pages: list[list[tuple[int, ...]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    tokens = [t for p in pages for t in p]
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    flat = np.fromiter((f for t in tokens for f in t), np.int64, int(sizes.sum()))
    return flat, np.cumsum(sizes) - sizes, np.fromiter(map(len, pages), np.int64, len(pages))


def trained(rows: list[tuple[str, list[int]]] | None = None) -> crf.Model:
    rows = rows if rows is not None else labelled_pages()
    gold = np.array([label for _, labels in rows for label in labels])
    return crf.train(*_encoded([features(blocks(html)) for html, _ in rows]), gold, FEATURES, 2)


def main_text(pages: list[str], model: crf.Model) -> list[str]:
    """Main blocks of each page in page order, joined by newlines."""
    cut = [blocks(p) for p in pages]
    some = [i for i, p in enumerate(cut) if p]
    result = [""] * len(pages)
    if not some:
        return result
    labels = crf.viterbi(model, *_encoded([features(cut[i]) for i in some]))
    at = 0
    for i in some:
        own = labels[at: at + len(cut[i])]
        at += len(cut[i])
        result[i] = "\n".join(text for (text, _, _), label in zip(cut[i], own, strict=True) if label)
    return result


def extract(pages: DataFrame, model: crf.Model | None = None) -> DataFrame:
    """One row per input row: page_id, url, text (empty if none), n_chars.

    A null html counts as empty; markup that is broken or never closed is read as far as it goes; a null url or page_id is
    carried through. Repeated rows are read one by one; an empty table gives an empty result; other columns are not read.
    """
    model = model or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                texts = main_text([h or "" for h in part.column("text").to_pylist()], model)
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return pages.selectExpr("page_id", "url", "html AS text").mapInArrow(run, RESULT)
