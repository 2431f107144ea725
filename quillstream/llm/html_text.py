"""Operator 8: main text of web pages by maximum-scoring subsequence.

A page is a sequence of words and tags. A word's weight is positive unless it stands in a link or a boilerplate
container; a tag's weight is negative. The weights are smoothed log-odds, learned from pages whose own markup labels
the article (`<article>`, `<main>` or role="main"). When a page is judged these labels add no weight; as elements they are read
like others: an unclosed container ends where an article begins, and a header inside one is its own. Containers are known
by element and by the names in class, id and role (fixed lists). One linear scan
finds the contiguous region with the largest sum. It is widened to whole blocks; scripts, styles, forms, notices, adverts,
side matter and reader comments inside it are left out.

Text: character references decoded, white space inside a block made one space, blocks trimmed and joined by two \\n.

Tokens take linear time, whatever is left unclosed, so very long pages are read whole. Nulls: null or empty html gives an empty text; null or repeated page ids keep a row each. An unclosed tag ends with
its page; an unclosed silent element other than script and style silences nothing. Of regions with equal sums the first is taken. An empty table gives an empty result. Without labelled pages
the built-in weights hold. Other columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Names of HTML elements by their role.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
SILENT = frozenset("script style noscript template textarea select button svg math iframe object canvas audio video title".split())
#: Only these hold anything but markup, so without an end tag they reach to the page's end.
RAW = frozenset("script style".split())
FLAT = frozenset("button select".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class, id and role attributes that mark side matter.
SIDE = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner sponsor sponsored promo promotion cookie cookies consent notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login menu nav navbar navigation breadcrumb breadcrumbs sidebar side rail widget related recommended share sharing social comment comments replies reply disqus respond footer "
    "masthead pagination pager toolbar search contentinfo complementary legal copyright".split()
)
#: Words that name the article itself, those that do so unless side matter is named beside them, and words that
#: say that a page has or lacks something.
ARTICLE = frozenset("article main post entry story".split())
CONTENT = frozenset("content text body".split())
LAYOUT = frozenset("no not without has with hide".split())
#: A page's header, as against an article's.
HEAD = re.compile(r"(?:^|\s)(?:(?:site|page|top|global)[-_]?)?header(?:$|\s)|(?:^|\s)top[-_]?bar(?:$|\s)", re.I)
NAME = re.compile(r"<(/?)([a-zA-Z][\w:-]*+)")
PLAIN = re.compile(r"[^>\"']*+")
ATTRIBUTE = re.compile(r"(?:class|id|role)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
MAIN_ROLE = re.compile(r"role\s*+=\s*+[\"']?main\b")
SPACES = re.compile(r"\s+")
#: Weights where no labelled page is at hand: word kinds and tags.
DEFAULT = {"word": 1.0, "link word": -0.5, "side word": -0.05, "other tag": -2.0, "side tag": -0.1} | {a + t: -0.3 for a in ("<", "</") for t in ("p", "br", "b", "i", "em", "strong", "a", "span", "h1", "h2", "h3", "li")}
#: Side matter is left out of the text in any case, so crossing it costs little: an article may go on behind it.
BOUND = {"link word": -1.0, "side word": -0.05, "side tag": -0.1}


def marks_side(value: str) -> bool:
    """Whether an attribute's names mark side matter: the first that names either side matter or an article decides."""
    for name in value.lower().split():
        words = re.split("[-_]+", name)
        if words[0] in LAYOUT:
            continue
        if words[-1] in ARTICLE:
            return False
        if not SIDE.isdisjoint(words) or HEAD.search(name):
            return True
        if words[-1] in CONTENT:
            return False
    return False


def is_side(name: str, attributes: str) -> bool:
    if name in BOILERPLATE:
        return True
    return name not in ("html", "body", "article", "main") and any(marks_side("".join(m)) for m in ATTRIBUTE.findall(attributes))


def tag_end(page: str, i: int) -> int:
    """Where the `>` of the tag stands whose names begin at i, or -1. One inside quotes does not count, unless they are left open."""
    p = i
    while (p := PLAIN.match(page, p).end()) < len(page) and page[p] != ">":
        close = page.find(page[p], p + 1)
        inner = page.find(">", p + 1, close) if close >= 0 else p
        if close < 0 or inner >= 0 and page.find("<", inner, close) >= 0:
            return page.find(">", p)  # the quote is never closed, or by the quote of a later tag
        p = close + 1
    return p if p < len(page) else page.find(">", i)


def token(page: str, i: int, last: int) -> tuple[int, str | None, tuple[bool, str, str] | None]:
    """(end, text or None, (closing, name, attributes) or None) of the token at i; last: the place of the page's last `>`.

    Every step moves past what it has read, so a page takes linear time.
    """
    if page.startswith("<!--", i) or page[i] == "<" and i < last:
        for opening, closing in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<!", ">"), ("<?", ">")):
            if page.startswith(opening, i):
                end = page.find(closing, i + len(opening))
                return (len(page) if end < 0 else end + len(closing)), None, None
        m = NAME.match(page, i)
        if m and (end := tag_end(page, m.end())) >= 0:
            return end + 1, None, (m[1] == "/", m[2].lower(), page[m.end() : end])
    end = page.find("<", i + 1) if i < last else -1
    end = len(page) if end < 0 else end
    return end, page[i:end], None


def parse(page: str) -> list[tuple[str, str, str]]:
    """Tokens (kind, name, text): kind is `text`, `open`, `close`; name is the element, or where a text stands:
    `silent`, `side`, `link` or `plain`. In side matter tags have the kind `side`."""
    out: list[tuple[str, str, str]] = []
    side: list[list] = []  # [element, depth] of the open containers
    silent, link, i, n, last = "", 0, 0, len(page), page.rfind(">")
    article, stops, within = 0, {}, Counter()
    while i < n:
        if silent:
            m = stops.get(silent)
            if silent not in stops or m and m.start() < i:
                own = rf"|<{silent}\b" if silent in FLAT else ""
                other = "" if silent in RAW else rf"|</(?:article|main|body)\b{own}"
                m = stops[silent] = re.compile(rf"(</{silent}\s*+>){other}", re.I).search(page, i)
            if m and m[1] is None or not m and silent not in RAW:
                pass  # left open where its article ends or the next of its kind begins: it silences nothing
            else:
                body, i = (page[i : m.start()], m.end()) if m else (page[i:], n)
                out.append(("text", "silent", body))
            silent = ""
            continue
        i, words, tag = token(page, i, last)
        if words is not None:
            out.append(("text", "side" if side else "link" if link else "plain", words))
        if tag is None:
            continue
        closing, name, attributes = tag
        if name in ("article", "main") or not closing and MAIN_ROLE.search(attributes):
            article = max(0, article + (-1 if closing else 1))
            if not closing:
                side.clear()  # an unclosed container ends where the article begins
                within.clear()
            out.append(("label", "out" if not article else "in", ""))
        if name in SILENT and not closing and not attributes.endswith("/"):
            silent = name
        if side and name in ("p", "li") and not closing and side[-1][0] == name:
            within[side.pop()[0]] -= 1  # these need no closing tag
        if side:
            if name == side[-1][0]:
                side[-1][1] += -1 if closing else 1
                if side[-1][1] == 0:
                    within[side.pop()[0]] -= 1
            elif not closing and name not in VOID and is_side(name, attributes):
                side.append([name, 1])
                within[name] += 1
            elif closing and within[name]:
                while side[-1][0] != name:
                    within[side.pop()[0]] -= 1
                side[-1][1] -= 1
                if side[-1][1] == 0:
                    within[side.pop()[0]] -= 1
            out.append(("side", name, ""))
            continue
        is_head = name == "header" and not article
        if not closing and name not in VOID and not attributes.endswith("/") and (is_head or is_side(name, attributes)):
            side.append([name, 1])
            within[name] += 1
            out.append(("side", name, ""))
            continue
        if name == "a":
            link = int(not closing and "href" in attributes.lower())
        elif closing and name in BLOCKS:
            link = 0  # a link left open ends with its block
        out.append(("close" if closing else "open", name, ""))
    return out


def kinds(tokens: list[tuple[str, str, str]]) -> list[tuple[str, int]]:
    """The scored form of each token: (kind, how often)."""
    out = []
    for kind, name, text in tokens:
        if kind == "text":
            n = 0 if name == "silent" else len(text.split())
            out.append(({"side": "side word", "link": "link word"}.get(name, "word"), n))
        elif kind == "label":
            out.append(("", 0))
        else:
            out.append(("side tag" if kind == "side" else "</" * (kind == "close") + "<" * (kind == "open") + name, 1))
    return out


def learn(pages: list[str]) -> dict[str, float]:
    """Log-odds of each kind inside against outside the labelled article; words positive, tags negative."""
    inside, outside = Counter(), Counter()
    for page in pages:
        tokens = parse(page)
        if not any(k == "label" for k, _, _ in tokens):
            continue
        now = outside
        for (kind, name, _), (what, n) in zip(tokens, kinds(tokens), strict=True):
            if kind == "label":
                now = inside if name == "in" else outside
            elif n:
                now[what] += n
    if not inside:
        return dict(DEFAULT)
    total_in, total_out = sum(inside.values()), sum(outside.values())
    odds = {k: math.log((inside[k] + 1) / (total_in + 10)) - math.log((outside[k] + 1) / (total_out + 10)) for k in inside | outside}
    weights = dict(DEFAULT)
    for k, v in odds.items():
        weights[k] = max(0.25, min(v, 1.0)) if k == "word" else max(BOUND.get(k, -6.0), min(-0.05, v))
    return weights


def best_region(scores: list[float]) -> tuple[int, int]:
    """[i, j) of the first maximum-scoring contiguous region; (0, 0) if no score is positive."""
    best, place, run, start = 0.0, (0, 0), 0.0, 0
    for k, s in enumerate(scores):
        if run <= 0:
            run, start = 0.0, k
        run += s
        if run > best:
            best, place = run, (start, k + 1)
    return place


def main_text(page: str | None, weights: dict[str, float]) -> str:
    if not page:
        return ""
    tokens = parse(page)
    i, j = best_region([weights.get(k, weights["other tag"]) * n if n else 0.0 for k, n in kinds(tokens)])
    if i == j:
        return ""
    edge = lambda t: t[0] == "side" or t[0] in ("open", "close") and t[1] in BLOCKS
    while i > 0 and not edge(tokens[i - 1]):
        i -= 1
    while j < len(tokens) and not edge(tokens[j]):
        j += 1
    blocks, block = [], []
    for kind, name, text in tokens[i:j]:
        if kind == "text":
            if name in ("plain", "link"):
                block.append(text)
        elif kind in ("open", "close") and name in BLOCKS or kind == "side":
            blocks.append("".join(block))
            block = []
        elif name == "br":
            block.append(" ")
    blocks.append("".join(block))
    clean = (SPACES.sub(" ", entities.unescape(b)).strip() for b in blocks)
    return "\n\n".join(b for b in clean if b)


def fit_on(pages: DataFrame, most_pages: int = 200, html_col: str = "html", id_col: str = "page_id") -> dict[str, float]:
    """Weights from at most `most_pages` labelled pages, those with the smallest id hashes; the bound is this parameter."""
    rows = pages.where(F.col(html_col).isNotNull())
    # A share of the pages that holds the wanted ones almost surely, so that no task sends more than it must.
    share = min(1.0, 2 * most_pages / max(1, rows.count()))
    near = rows.where(F.shiftrightunsigned(F.xxhash64(id_col, html_col), 1) / float(1 << 63) <= share)
    sample = near.orderBy(F.xxhash64(id_col, html_col)).select(html_col).limit(most_pages).collect()
    return learn([r[0] for r in sample])


def extract(pages: DataFrame, weights: dict[str, float], html_col: str = "html") -> DataFrame:
    """The pages with their main text in the column `text`."""

    @F.pandas_udf("string")
    def text_of(column: pd.Series) -> pd.Series:
        return column.map(lambda page: main_text(page, weights))

    return pages.withColumn("text", text_of(F.col(html_col)))
