"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks, the stretches of text between block-level tags. Each block has features of its
ancestors (tags, words of class, id and role) and of its text; a chain of two states, article and rest, is trained on
pages that label themselves (one ``article`` or ``main`` element) and decoded by Viterbi.

The project has no pages; the operator is general and takes any frame with an id and an html column.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelops.llm import text

#: About so many pages are learned from, those with the smallest hash of the id.
SAMPLE = 300
EPOCHS = 25
RATE = 0.5
DECAY = 1e-4

# Tag names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var br wbr img".split())
SILENT = frozenset("script style noscript template iframe svg math object canvas audio video select textarea button".split())
#: Elements whose content is no markup, whatever it looks like, with the pattern of their end tag.
RAW = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in ("script", "style", "textarea", "iframe", "title", "xmp")}
ARTICLE = frozenset(("article", "main"))
# Words of tags, classes, ids and roles that page parts outside an article carry, and those an article carries.
OUTSIDE = frozenset(
    "nav navbar navigation menu header masthead footer aside sidebar side ad ads advert advertisement adverts banner sponsor sponsored promo notice cookie consent "
    "alert warning popup modal form search login signup subscribe newsletter comment comments reply replies discussion disqus share sharing social related "
    "breadcrumb breadcrumbs pagination pager toolbar widget copyright title head complementary contentinfo".split()
)
INSIDE = frozenset("article main content post entry story body text".split())

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)|[^<]+|<", re.S)
MARK = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORDS = re.compile(r"[a-z]+")
#: Tags that end where the same one, or a block of that kind, starts.
ENDS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}


def blocks(page: str | None) -> list[tuple[str, tuple[tuple[str, tuple[str, ...]], ...], float]]:
    """Leaf blocks in page order: text with character references decoded and white space as one space, ancestors
    (tag, words of class, id and role), share of the text inside links. Blocks without text are left out.
    """
    out, parts, stack = [], [], []
    silent, link, linked = None, 0, 0

    def close():
        nonlocal linked
        if parts:
            body = " ".join(html.unescape("".join(parts)).split())
            if body:
                out.append((body, tuple(stack), min(1.0, linked / max(1, len(body)))))
            parts.clear()
        linked = 0

    page = page or ""
    at = 0
    while m := TOKEN.match(page, at):
        at, raw = m.end(), ""
        token = m.group()
        slash, name, rest = (m.group(1), m.group(2), m.group(3)) if m.group(2) else (m.group(4), m.group(5), m.group(6))
        if name is None:
            if silent is None and not (token[0] == "<" and len(token) > 1):
                parts.append(token)
                if link:
                    linked += len(token)
            continue
        name = name.lower()
        if name in RAW and not slash and not rest.endswith("/"):
            stop = RAW[name].search(page, at)
            # without an end tag, a silent element takes the rest of the page and any other goes on as markup
            until = stop.start() if stop else len(page) if name in SILENT and silent is None else at
            raw, at = page[at:until], until
        if silent is not None:
            if slash and name == silent:
                silent = None
            continue
        if name in SILENT:
            if not slash and not rest.endswith("/"):
                silent = name
            parts.append(" ")
            continue
        if name in INLINE:
            if name == "a":
                link = 0 if slash else 1
            elif name in ("br", "img", "wbr"):
                parts.append(" ")
            continue
        close()
        if slash:
            opened = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if opened is not None:
                del stack[opened:]
        elif name not in VOID:
            while stack and stack[-1][0] in ENDS.get(name, ()) or stack and stack[-1][0] == "p":
                stack.pop()
            words = tuple(w for found in MARK.findall(rest) for w in WORDS.findall("".join(found).lower())) if rest else ()
            stack.append((name, words))
            if raw:
                parts.append(raw)
    close()
    return out


def features(found: list, plain: bool = False) -> list[list[str]]:
    """Feature names of each block of a page. ``plain`` leaves out what names the article, so that pages without such a
    mark are learned as well.
    """
    rows = []
    for i, (body, above, links) in enumerate(found):
        own = above[-1][0] if above else "none"
        row = ["always", f"own:{own}"]
        inside = outside = False
        for tag, words in above:
            names = (tag, *words)
            inside = inside or any(w in INSIDE and w != "body" for w in names) or "body" in words
            outside = outside or any(w in OUTSIDE for w in names)
            row += [f"up:{w}" for w in names if not (plain and w in INSIDE)]
        if inside and not plain:
            row.append("inside")
        row.append("outside" if outside else "not outside")
        if inside and outside and not plain:
            row.append("inside, outside")
        size = len(body)
        row.append(f"size:{min(8, size.bit_length())}")
        row.append(f"links:{int(4 * links)}")
        row.append("ends" if body[-1] in ".!?:;…\"'”»" else "open")
        if "©" in body:
            row.append("rights")
        row.append(f"depth:{min(6, len(above))}")
        row.append("first" if i == 0 else "last" if i == len(found) - 1 else "middle")
        rows.append(row)
    return rows


def labels(found: list) -> list[int] | None:
    """1 for blocks of the page's only article, 0 for others and for parts of it that are named as outside; None
    for a page that does not label itself.
    """
    marked = [any(tag in ARTICLE or "article" in words for tag, words in above) for _, above, _ in found]
    if not any(marked) or all(marked):
        return None
    out = []
    for inside, (_, above, _) in zip(marked, found):
        at = next((i for i, (tag, words) in enumerate(above) if tag in ARTICLE or "article" in words), len(above))
        out.append(int(inside and not any(w in OUTSIDE for tag, words in above[at + 1 :] for w in (tag, *words))))
    return out


# --- the chain ----------------------------------------------------------------------------------


def _add(a: float, b: float) -> float:
    return max(a, b) + log(1 + exp(-abs(a - b)))


def marginals(scores: list[tuple[float, float]], moves: list[float]) -> tuple[list[float], list[list[float]]]:
    """Chance of state 1 per block, and of each move (00, 01, 10, 11) summed over the page, by forward and backward sums."""
    n = len(scores)
    ahead, back = [scores[0]], [(0.0, 0.0)] * n
    for s in scores[1:]:
        p = ahead[-1]
        ahead.append((s[0] + _add(p[0] + moves[0], p[1] + moves[2]), s[1] + _add(p[0] + moves[1], p[1] + moves[3])))
    for i in range(n - 2, -1, -1):
        s, b = scores[i + 1], back[i + 1]
        zero, one = s[0] + b[0], s[1] + b[1]
        back[i] = (_add(moves[0] + zero, moves[1] + one), _add(moves[2] + zero, moves[3] + one))
    total = _add(*ahead[-1])
    ones = [exp(a[1] + b[1] - total) for a, b in zip(ahead, back)]
    used = [[0.0] * 4 for _ in range(n)]
    for i in range(1, n):
        for k in range(4):
            f, t = divmod(k, 2)
            used[i][k] = exp(ahead[i - 1][f] + moves[k] + scores[i][t] + back[i][t] - total)
    return ones, used


def fit(pages: list[tuple[list[list[str]], list[int]]]) -> dict:
    """Feature weights (for state 1 against 0) and move weights by gradient steps on the likelihood of each page."""
    weights: dict[str, float] = {}
    speed: dict[str, float] = {}
    moves, pace = [0.0] * 4, [1e-6] * 4
    for _ in range(EPOCHS):
        for rows, wanted in pages:
            ones, used = marginals([(0.0, sum(weights.get(f, 0.0) for f in row)) for row in rows], moves)
            for row, p, y in zip(rows, ones, wanted):
                gap = y - p
                if abs(gap) < 1e-4:
                    continue
                for f in row:
                    w = weights.get(f, 0.0)
                    g = gap - DECAY * w
                    speed[f] = speed.get(f, 1e-6) + g * g
                    weights[f] = w + RATE * g / speed[f] ** 0.5
            have = [0.0] * 4
            for a, b in zip(wanted, wanted[1:]):
                have[2 * a + b] += 1
            for k in range(4):
                g = have[k] - sum(u[k] for u in used) - DECAY * moves[k]
                pace[k] += g * g
                moves[k] += RATE * g / pace[k] ** 0.5
    return {"weights": weights, "moves": moves}


def decode(rows: list[list[str]], model: dict) -> list[int]:
    """The likeliest states of a page's blocks (Viterbi); ties go to the rest of the page."""
    weights, moves = model["weights"], model["moves"]
    best, came = None, []
    for row in rows:
        s = sum(weights.get(f, 0.0) for f in row)
        if best is None:
            best = (0.0, s)
            continue
        zero = (best[0] + moves[0], best[1] + moves[2])
        one = (best[0] + moves[1], best[1] + moves[3])
        came.append((int(zero[1] > zero[0]), int(one[1] > one[0])))
        best = (max(zero), s + max(one))
    if best is None:
        return []
    states = [int(best[1] > best[0])]
    for c in reversed(came):
        states.append(c[states[-1]])
    return states[::-1]


# --- over tables --------------------------------------------------------------------------------


def learn(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", sample: int = SAMPLE) -> dict:
    """Chain model from about ``sample`` pages that label themselves: the documented bound of the fit.

    Each is learned twice, once without the features that name the article. Without such pages the model has the
    prior weights alone: blocks inside a named article and outside the named other parts.
    """
    rows = pages.filter(F.col(html_col).isNotNull()).select(F.xxhash64(F.col(id_col).cast("string")).alias("h"), F.col(html_col).alias("html"))
    marked = rows.filter(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    chosen = marked.orderBy("h", F.xxhash64("html")).limit(sample).select("html").collect()
    learned = []
    for r in chosen:
        found = blocks(r["html"])
        wanted = labels(found)
        if wanted is not None:
            learned += [(features(found), wanted), (features(found, plain=True), wanted)]
    model = fit(learned) if learned else {"weights": {}, "moves": [0.5, -0.5, -0.5, 0.5]}
    # what named parts mean holds also where the sample has none of them
    for name, least in (("outside", -6.0), ("inside, outside", -4.0)):
        model["weights"][name] = min(model["weights"].get(name, 0.0), least)
    if not learned:
        model["weights"].update({"inside": 4.0, "always": -2.0, "not outside": 1.0, "own:p": 2.0, "ends": 1.0})
    return model


def main_text(pages: DataFrame, model: dict, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``id_col``, ``text``, ``n_chars``, ``n_blocks``: the article's blocks in page order, joined by one line feed.

    Whole pages of any length; NULL, empty and blank pages give an empty text. Unclosed tags end where their
    parent does. Repeated rows give equal rows.
    """
    schema = text.plus(pages, id_col, [("text", T.StringType()), ("n_chars", T.LongType()), ("n_blocks", T.LongType())])
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in text.pieces(batches, "html"):
            texts, sizes = [], []
            for page in batch.column("html").to_pylist():
                found = blocks(page)
                states = decode(features(found), m)
                kept = [b[0] for b, s in zip(found, states) if s]
                texts.append("\n".join(kept))
                sizes.append(len(kept))
            yield text.record(batch.column("id"), schema, [texts, list(map(len, texts)), np.array(sizes)])

    return pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).mapInArrow(run, schema)
