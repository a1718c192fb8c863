"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of tags and runs of words.  A word scores by the elements it stands
in, a tag scores below zero; both weights are log-odds counted on the labelled pages
below.  One linear scan finds the contiguous region with the highest sum.  Runs inside
the region whose own elements score below zero (an advert in an article) are left out.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.llm.common import map_batches

#: Labelled pages: words under ``data-main`` are main text, but not those under ``data-not``.
LABELLED = (
    """<html><head><title>A day at the sea</title><style>p{margin:0}</style></head><body>
    <header><a href="/">The daily page</a> news every morning</header>
    <nav><ul><li><a href="/a">Home</a></li><li><a href="/b">World</a></li><li><a href="/c">Sport</a></li></ul></nav>
    <div class="ad">Buy two lamps and get one free this week only</div>
    <article data-main><h1>A day at the sea</h1><p>The morning train brought us to the coast before the fog had lifted,
    and we walked along the <b>harbour wall</b> until the light came through.</p><p>There were two boats and a man
    mending nets, who told us that <a href="/h">the herring had moved</a> north years ago.</p>
    <div class="advert" data-not>Ten holidays at half the price</div><h2>Afternoon</h2>
    <p>We ate bread and cheese on the rocks; later the wind turned and we went home.</p>
    <ul><li>One of the boats was blue and old</li><li>The other one had lost its name</li></ul></article>
    <aside class="sidebar"><p>Most read today: ten stories that you must not miss</p></aside>
    <footer>&copy; The daily page, all rights reserved</footer></body></html>""",
    """<body><div id="menu"><a>Start</a> <a>Products</a> <a>About us</a> <a>Contact</a></div>
    <div class="cookie notice">We use cookies to improve your visit. Accept all or choose.</div>
    <div id="content" class="content" data-main><h1>How bread rises</h1><p>Yeast eats sugar and gives off gas, which is held
    by the gluten in the dough. <span>The longer it rests</span>, the more taste it has.</p><p>Salt slows it down; warmth speeds it up.
    <a href="/x">Bakers balance both</a>, and fold the dough several times.</p><blockquote>A loaf takes a day, said the old baker, or it is
    not a loaf.</blockquote><pre>flour 500 water 350 salt 10</pre><table><tr><td>rest</td><td>twelve hours or so</td></tr></table></div>
    <div id="comments" class="comments"><h3>Comments</h3><div class="comment"><p>Great read, thank you so much!</p></div>
    <div class="comment"><p>I tried it and my loaf was flat.</p></div></div>
    <form class="search"><label>Search this site</label><input><select><option>All</option></select><button>Go</button></form>
    <div class="footer">Imprint Privacy Terms of use</div></body>""",
    """<html><body><div class="header banner"><p>Welcome to our site, join the newsletter now</p></div>
    <div class="breadcrumb">Home / Science / Birds</div><div class="main post entry" data-main><h1>Why geese fly in lines</h1>
    <p>Each bird rides the air that the one before has lifted, and <span>so the flock</span> can travel much further than one bird could
    alone; they change places when the leader tires.</p><div class="share social" data-not>Share Tweet Mail</div>
    <p><a href="/p">Scientists measured the heart rates</a> of pelicans and found the saving to be large, above all for the birds in the
    middle of the line.</p><h3>What else</h3><p>Drivers and cyclists do the same thing on the road, for the same reason.</p></div>
    <div class="related promo"><p>You may also like these five stories about birds</p></div>
    <div class="widget newsletter subscribe"><p>Sign up to get our letter every Friday</p></div>
    <div id="sidebar"><ul><li>Archive</li><li>Authors</li></ul></div>
    <div class="disclaimer copyright legal">No part may be copied without consent.</div></body></html>""",
    """<html><body><nav class="navbar navigation"><a>One</a><a>Two</a></nav><div class="sponsored ads sponsor">Sponsored: a new car for less
    than you think</div><main class="story body text article" data-main><section><h2>The town and its bridge</h2><p>For a hundred
    years the bridge was the only way across, and <a href="/m">everyone who came to market</a> paid a penny to the keeper, whose house still
    stands.</p><p>In spring the river rose so high that the keeper had to sleep in the church. People brought him soup, and
    the penny was not asked for until the water fell.</p><dl><dt>Built</dt><dd>by masons from the next valley</dd></dl>
    <div class="reader comment" data-not><p>My grandmother knew the keeper well.</p></div>
    <p>Now there are three bridges and no one pays.</p></section></main>
    <section class="discussion respond replies"><p>Leave a reply</p><p>What a lovely town this is</p></section>
    <div class="popup modal alert consent gdpr">Please turn off your blocker to go on</div>
    <aside><div class="tagcloud">river town history</div></aside><footer class="footer"><p>Made with care in the north</p></footer></body></html>""",
)

BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html li legend main menu nav ol optgroup option p pre section select "
    "summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe object svg math canvas audio video".split())
#: A new block of these ends an open one of the same kind.
SELF_ENDING = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"},
               "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
_P_ENDERS = BLOCKS - {"br", "option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "head"}
_TAG = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|</?([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>")
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


#: One trait this far below zero decides: a menu in an article is a menu.
DECISIVE = -2.0
#: Their classes tell of the whole page.
WHOLE = frozenset({"html", "body"})


@dataclass
class Element:
    tag: str
    traits: frozenset[str]
    around: frozenset[str]  # traits of this and all outer elements
    marks: str = ""


@dataclass
class Piece:
    """A tag, or a run of text in one element; ``block`` numbers the block it belongs to."""

    text: str | None
    around: frozenset[str]
    block: int
    marks: str = ""


def pieces(page: str) -> Iterator[Piece]:
    """Tags and text runs of a page in order; comments, scripts and other raw elements give nothing.

    Never fails on broken markup: unknown closing tags are passed over, unclosed elements
    end with an outer one, an unclosed comment or script runs to the end.
    """
    stack = [Element("", frozenset(), frozenset())]
    depth: Counter[str] = Counter()
    block, at, end, last = 0, 0, len(page), page.rfind(">")
    while at < end:
        open_at = page.find("<", at)
        text_end = end if open_at < 0 else open_at
        if text_end > at:
            yield Piece(page[at:text_end], stack[-1].around, block, stack[-1].marks)
        if open_at < 0:
            return
        if page.startswith("<!--", open_at):
            close = page.find("-->", open_at + 4)
            at = end if close < 0 else close + 3
            continue
        if open_at > last:  # no tag ends here; an unfinished one is dropped, as a browser does
            if not re.match(r"[a-zA-Z/!?]", page[open_at + 1:open_at + 2]):
                yield Piece(page[open_at:], stack[-1].around, block, stack[-1].marks)
            return
        m = _TAG.match(page, open_at)
        if not m:
            if page[open_at + 1:open_at + 2] in ("!", "?", "/"):
                close = page.find(">", open_at)
                at = end if close < 0 else close + 1
            else:  # a plain less-than sign
                yield Piece("<", stack[-1].around, block, stack[-1].marks)
                at = open_at + 1
            continue
        at = m.end()
        tag, rest = (m[1] or m[3]).lower(), m[2] or m[4] or ""
        closing = page[open_at + 1] == "/"
        if tag in RAW and not closing:
            if not rest.endswith("/"):
                close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = close.end() if close else end
            continue
        block += tag in BLOCKS
        if closing:
            if depth[tag]:
                _cut(stack, depth, next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
        elif tag not in VOID:
            if tag in _P_ENDERS:
                _end_open(stack, depth, {"p"})
            if tag in SELF_ENDING:
                _end_open(stack, depth, SELF_ENDING[tag])
            traits = {"t:" + tag}
            marks = stack[-1].marks
            if rest:
                for a, b, c in _NAMED.findall(rest) if tag not in WHOLE else ():
                    traits |= {"c:" + x.lower() for x in _PART.findall(a or b or c)}
                if "data-" in rest:
                    marks = "not" if "data-not" in rest or marks == "not" else "main" if "data-main" in rest else marks
            fixed = frozenset(traits)
            depth[tag] += 1
            stack.append(Element(tag, fixed, stack[-1].around | fixed, marks))
        yield Piece(None, stack[-1].around, block)


def _cut(stack: list[Element], depth: Counter[str], to: int) -> None:
    for x in stack[to:]:
        depth[x.tag] -= 1
    del stack[to:]


def _end_open(stack: list[Element], depth: Counter[str], tags: set[str]) -> None:
    """Close the nearest open element of ``tags`` unless a list, table or section begins in between."""
    if not any(depth[x] for x in tags):
        return
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            _cut(stack, depth, i)
            return
        if stack[i].tag in BLOCKS:
            return


@dataclass
class Weights:
    """Log-odds of main text, from labelled pages."""

    start: float
    tag: float
    traits: dict[str, float]
    cache: dict[frozenset[str], float] = field(default_factory=dict)

    def word(self, around: frozenset[str]) -> float:
        if around not in self.cache:
            if len(self.cache) > 100_000:
                self.cache.clear()
            odds = [self.traits.get(x, 0.0) for x in around]
            low = min(odds, default=0.0)
            self.cache[around] = self.start + (low if low <= DECISIVE else sum(odds))
        return self.cache[around]


def learn(pages: tuple[str, ...] = LABELLED) -> Weights:
    words, tags = Counter(), Counter()
    traits: dict[bool, Counter] = {True: Counter(), False: Counter()}
    for page in pages:
        inside = False
        for p in pieces(page):
            if p.text is None:
                tags[inside] += 1
                continue
            n = len(p.text.split())
            if n:
                inside = p.marks == "main"
                words[inside] += n
                for x in p.around:
                    traits[inside][x] += n
    smooth = 0.5
    odds = {x: math.log((traits[True][x] + smooth) / (words[True] + 2 * smooth))
            - math.log((traits[False][x] + smooth) / (words[False] + 2 * smooth)) for x in traits[True] | traits[False]}
    rate = [(tags[k] + smooth) / (words[k] + tags[k] + 2 * smooth) for k in (True, False)]
    return Weights(math.log(words[True] / words[False]), math.log(rate[0] / rate[1]), odds)


def extract(page: str, weights: Weights) -> str:
    """Blocks of the best region, one to a line; empty if no word scores above zero."""
    held = list(pieces(page))
    best = total = 0.0
    start = 0
    region = (0, 0)
    for i, p in enumerate(held):
        total += weights.tag if p.text is None else weights.word(p.around) * len(p.text.split())
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, region = total, (start, i + 1)
    blocks: dict[int, list[str]] = {}
    for p in held[region[0]:region[1]]:
        if p.text is not None and weights.word(p.around) > 0:
            blocks.setdefault(p.block, []).append(p.text)
    lines = (" ".join(html.unescape("".join(x)).split()) for x in blocks.values())
    return "\n".join(x for x in lines if x)


def main_text(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html", with_row: bool = False) -> DataFrame:
    """(id, text) for every row; ``with_row`` adds the whole row as ``row``.

    Null, empty and contentless pages have an empty text.  Of regions with equal sums
    the first is taken.  Repeated rows are answered each for itself.
    """
    row = [F.struct("*").alias("row")] if with_row else []
    base = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(html_col), F.lit("")).alias("page"), *row)
    schema = T.StructType([*base.drop("page").schema, T.StructField("text", T.StringType())])
    weights = learn()
    return map_batches(base, lambda batch: batch | {"text": [extract(p, weights) for p in batch["page"]]}, schema)
