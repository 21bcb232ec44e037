"""What one page says about itself: a single pass over its tags, run inside Arrow tasks.

Only the fixed selectors of the extraction job are known here. The pass collects facts
(meta values, headings, paragraphs, cards); which fact wins is decided by Spark columns
in :mod:`newsflow.operators.pages`.
"""

from __future__ import annotations

import re
from collections import Counter
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd

from newsflow.functions.dates import ZONED_ISO

# Selectors of the extraction, in their order of preference.
META_TITLES = (("property", "og:title"), ("name", "title"))
META_DESCRIPTIONS = (("name", "description"), ("property", "og:description"))
META_DATES = (
    ("property", "article:published_time"),
    ("name", "article:published_time"),
    ("name", "publish-date"),
    ("itemprop", "datePublished"),
)
HEADING_SCOPES = ("", "header", "article", "div.caas-title-wrapper", "div.caas-content-header")
# The first group counts as one level. A nested-div form of articleBody would only match
# what the articleBody scope matches already.
BODY_SCOPES = (
    ("article", "main", "div[data-test-locator=mega]"),
    ("div.caas-body",),
    ("div#article-body",),
    ("div[itemprop=articleBody]",),
    ("section[data-test-locator=mega]",),
)
STORY_CARD = ("section", "data-testid", "storyitem")
LIST_CARD = ("li", "js-stream-content")
CARD_WRAPPER = "div.caas-content-wrapper"

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr "
    "basefont bgsound command frame image isindex keygen menuitem nextid spacer".split()
)
SILENT = frozenset("script style template rt rp".split())
# Block starts that end an open paragraph.
BLOCKS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search "
    "section summary table ul".split()
)
_ZONED_ISO = re.compile(ZONED_ISO)
_OPEN_REF = re.compile(r"&(?!#[0-9]+;|#[xX][0-9a-fA-F]+;)([A-Za-z][A-Za-z0-9]*;)?")
_SCOPES = {s for group in BODY_SCOPES for s in group} | set(HEADING_SCOPES) - {""} | {CARD_WRAPPER}


def _scopes_of(tag: str, attrs: dict) -> frozenset:
    names = [tag]
    names += [f"{tag}.{c}" for c in (attrs.get("class") or "").split()]
    if "id" in attrs:
        names.append(f"{tag}#{attrs['id']}")
    for key in ("data-test-locator", "itemprop"):
        if key in attrs:
            names.append(f"{tag}[{key}={attrs[key]}]")
    return frozenset(n for n in names if n in _SCOPES)


class _Walk(HTMLParser):
    """Keeps the open elements with the scopes around them, and the texts being read."""

    def __init__(self, nested_p: bool):
        super().__init__(convert_charrefs=True)
        self.nested_p = nested_p
        self.open = []  # (tag, scopes including the element, text read inside it)
        self.open_count = Counter()
        self.run = []  # pieces of the current uninterrupted text
        self.reading = []  # texts that are open now
        self.silent = 0

    def scopes(self):
        return self.open[-1][1] if self.open else frozenset()

    def flush(self):
        if self.run:
            text = "".join(self.run).strip()
            self.run = []
            if text and not self.silent:
                for pieces in self.reading:
                    pieces.append(text)

    def handle_data(self, data):
        self.run.append(data)

    def handle_comment(self, data):
        self.flush()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def close_to(self, tag):
        """Close the innermost open ``tag`` and all inside it; nothing if none is open."""
        if self.open_count[tag]:
            while True:
                name, _, mine = self.open.pop()
                self.open_count[name] -= 1
                self.silent -= name in SILENT
                if mine is not None:
                    self.reading = [r for r in self.reading if r is not mine]
                if name == tag:
                    break

    def handle_starttag(self, tag, attrs):
        self.flush()
        attrs = {k: v or "" for k, v in attrs}
        if not self.nested_p and tag in BLOCKS:
            self.close_to("p")
        around = self.scopes()
        text = self.visit(tag, attrs, around)
        if tag in VOID:
            return
        self.silent += tag in SILENT
        if text is not None:
            self.reading.append(text)
        self.open_count[tag] += 1
        self.open.append((tag, around | _scopes_of(tag, attrs), text))

    def handle_endtag(self, tag):
        self.flush()
        self.close_to(tag)

    def read(self, html: str):
        self.feed(html)
        self.close()
        self.flush()
        return self


class _Article(_Walk):
    def __init__(self, nested_p):
        super().__init__(nested_p)
        self.meta = {}
        self.times = None
        self.title = None
        self.headings = [None] * len(HEADING_SCOPES)
        self.bodies = [[] for _ in BODY_SCOPES]

    def visit(self, tag, attrs, around):
        if tag == "meta":
            for key in ("property", "name", "itemprop"):
                if key in attrs:
                    self.meta.setdefault((key, attrs[key]), attrs.get("content", ""))
        elif tag == "time" and self.times is None and "datetime" in attrs:
            self.times = attrs["datetime"]
        elif tag == "title" and self.title is None:
            self.title = []
            return self.title
        elif tag == "h1":
            text = []
            first = False
            for i, scope in enumerate(HEADING_SCOPES):
                if self.headings[i] is None and (not scope or scope in around):
                    self.headings[i] = text
                    first = True
            return text if first else None
        elif tag == "p":
            text = []
            hits = [b for b, group in zip(self.bodies, BODY_SCOPES) if around.intersection(group)]
            for body in hits:
                body.append(text)
            return text if hits else None
        return None


def closed_refs_only(html: str) -> str:
    """The page with every ``&`` written out that does not begin a character reference with
    its semicolon, so that a text cut within a reference keeps what is left of it."""
    return _OPEN_REF.sub(lambda m: m[0] if m[1] in html5 else "&amp;" + m[0][1:], html)


def zoned_iso(text: str | None) -> str | None:
    """The text if it is an ISO instant with offset, else its ISO form if it names one.

    Publishers write instants in many styles; those outside ISO go through pandas.
    """
    if not text:
        return None
    text = text.replace("Z", "+00:00")
    if _ZONED_ISO.match(text):
        return text
    try:
        instant = pd.to_datetime(text)
        return None if instant.tzinfo is None else instant.tz_convert("UTC").isoformat()
    except Exception:
        return None


def article_facts(html: str | None, nested_p: bool = False, inline_sep: str = "", open_refs: bool = True) -> dict:
    """Facts of one article page; a page that cannot be read yields its error.

    With ``open_refs`` a reference without semicolon counts too, as for browsers."""
    try:
        page = _Article(nested_p).read(html if open_refs else closed_refs_only(html))
        first_meta = lambda wanted: next((page.meta[m] for m in wanted if m in page.meta), None)
        join = lambda text: None if text is None else inline_sep.join(text)
        body = next((b for b in page.bodies if b), None)
        dates = [page.times, *[page.meta.get(m) for m in META_DATES]]
        return {
            "meta_titles": [page.meta.get(m) for m in META_TITLES],
            "headings": [join(h) for h in page.headings],
            "title_tag": join(page.title),
            "paragraphs": None if body is None else [t for t in map(join, body) if t],
            "description": first_meta(META_DESCRIPTIONS),
            "date_texts": [d for d in map(zoned_iso, dates) if d],
            "error": None,
        }
    except Exception as problem:
        return {
            "meta_titles": None,
            "headings": None,
            "title_tag": None,
            "paragraphs": None,
            "description": None,
            "date_texts": None,
            "error": f"{problem}" or type(problem).__name__,
        }


class _Listing(_Walk):
    """Cards by selector level: stories, list items, wrapped article links, wrapped links,
    and as a last level every anchor with a target."""

    LEVELS = 5

    def __init__(self):
        super().__init__(nested_p=True)
        self.levels = [[] for _ in range(self.LEVELS)]
        self.cards = []  # (depth, card) of cards that are open now

    def handle_endtag(self, tag):
        super().handle_endtag(tag)
        while self.cards and self.cards[-1][0] >= len(self.open):
            self.cards.pop()

    def visit(self, tag, attrs, around):
        if tag == "a":
            for _, card in self.cards:
                if card["a"] is None:
                    card["a"] = attrs.get("href", "")
        elif tag == "time" and "datetime" in attrs:
            for _, card in self.cards:
                if card["datetime"] is None:
                    card["datetime"] = attrs["datetime"]
        levels = []
        if (tag, attrs.get(STORY_CARD[1])) == (STORY_CARD[0], STORY_CARD[2]):
            levels.append(0)
        elif tag == LIST_CARD[0] and LIST_CARD[1] in attrs.get("class", "").split():
            levels.append(1)
        elif tag == "a":
            if CARD_WRAPPER in around:
                # the article has to be inside the wrapper
                if self.wrapped_article():
                    levels.append(2)
                levels.append(3)
            if attrs.get("href"):
                levels.append(4)
        if levels:
            card = {"a": None, "own": attrs.get("href") if tag == "a" else None, "datetime": None}
            for level in levels:
                self.levels[level].append(card)
            self.cards.append((len(self.open), card))
        return None

    def wrapped_article(self):
        wrapped = False
        before = frozenset()
        for name, scopes, _ in self.open:
            if name == "article" and wrapped:
                return True
            wrapped = wrapped or (CARD_WRAPPER in scopes and CARD_WRAPPER not in before)
            before = scopes
        return False


def link_cards(html: str | None, which: str = "story") -> list[dict]:
    """Cards in page order. ``which``: ``story``, ``fallback`` (stories, else the first
    older selector that matches) or ``anchors`` (every link)."""
    page = _Listing().read(html or "")
    if which == "anchors":
        chosen = page.levels[4]
        pick = lambda c: c["own"]
    else:
        tries = page.levels[:1] if which == "story" else page.levels[:4]
        chosen = next((level for level in tries if level), [])
        pick = lambda c: c["a"] if c["a"] is not None else c["own"]
    return [
        {"pos": i, "href": pick(card), "datetime": card["datetime"]}
        for i, card in enumerate(chosen)
        if pick(card)
    ]
