"""Main-text extraction: a linear-chain CRF over the leaf blocks of a page.

A page becomes the sequence of its leaf blocks: stretches of text between
block-level tags, with inline markup dropped and character references decoded.
Each block has indicator features from its tag, its ancestors' tags, the words
in their class, id and role, and its text.  A linear-chain conditional random
field with the states *other* and *main* is trained on labelled pages (log
likelihood by forward-backward, numpy) and decoded by Viterbi; the main blocks,
joined by blank lines, are the text.

Labelled pages: layouts written out below, one label a block, filled with words
of a bounded sample of the pages at hand, so that what is learnt is structure
and not vocabulary.

Defined cases: a null or empty page, one without text, or one of markup alone
gives the empty text; tags left open or closed twice are repaired as browsers do
(a paragraph ends where a block begins); an unclosed comment, script, style or
text area runs to the end of the page, a head without its end tag to the body or
the first block, and any other skipped element without one is an ordinary
element; pages of any length are parsed whole; repeated pages are
extracted each; further columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import adam, arrow_map, lowest, tables

#: Pages whose words fill the training layouts, and training pages made.
SAMPLE, PAGES = 200, 400
#: A private-use character that tells main blocks apart in training pages.
MARK = "\ue000"

#: What begins a tag, comment or declaration; and the attributes up to its end.
_OPEN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)|<!--|<[!?]")
_ATTRS = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+""")
_ATTR = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle mspace mpadded mphantom merror menclose mfenced mmultiscripts mtable mtr mtd semantics annotation annotation-xml".split())
_EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIPPED = frozenset("script style noscript template svg iframe object canvas head textarea select".split())
#: skipped elements that run to the page's end if they are not closed
_RAW = frozenset("script style textarea".split())
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table ul".split())
_SELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_IN_HEAD = frozenset("script style noscript template title object".split())
_HEAD = _IN_HEAD | frozenset("head html base link meta".split())
_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in _SKIPPED | _IN_HEAD} | {"<body": re.compile(r"<body\b[^>]*>", re.I)}

#: words in class, id or role that tell a part of a page
_HINTS = {
    "nav": "nav menu breadcrumb breadcrumbs toc pagination pager navbar navigation tabs",
    "ad": "ad ads advert adverts advertisement sponsor sponsored promo promotion banner adbox adsense",
    "side": "side sidebar aside related rail widget recommended more trending popular",
    "comment": "comment comments reply replies disqus discussion thread respond feedback review reviews",
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay message warning disclaimer toast",
    "foot": "foot footer copyright legal colophon bottom contentinfo",
    "head": "head header masthead topbar top brand logo site banner",
    "share": "share social follow subscribe newsletter signup login form search",
    "meta": "byline author date meta tags caption credit",
    "main": "article content post entry story main body text prose",
}
_HINT_OF = {w: k for k, ws in _HINTS.items() for w in ws.split()}
_SECTIONS = "nav header footer aside article main section form ul ol table figure blockquote details dialog menu".split()
_LEAVES = "p h1 h2 h3 h4 li td div pre button figcaption dt dd blockquote".split()
FEATURES = {name: i for i, name in enumerate(
    ["bias"] + [f"in:{t}" for t in _SECTIONS] + [f"hint:{k}" for k in _HINTS]
    + [f"near:{k}" for k in _HINTS] + [f"leaf:{t}" for t in _LEAVES] + ["leaf:other"]
    + ["words:1-3", "words:4-9", "words:10-24", "words:25-", "links:all", "links:some", "links:none",
       "ends", "copyright", "caps", "in:article+aside", "no:article", "heading-first"])}


class tags:
    """The tags of a page from left to right: start, end, whether it closes, name
    ('' for comments and declarations) and attributes.

    A tag with an open quote ends at its first ``>``, one without any ``>`` is no
    tag, and an open comment runs to the page's end.  No place is searched for
    anew from every tag: where a ``>`` or an end mark is missing is found once.
    """

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")

    def after(self, at: int) -> tuple[int, int, bool, str, str] | None:
        page = self.page
        while m := _OPEN.search(page, at):
            if m.group() == "<!--":
                end = page.find("-->", m.end())
                return m.start(), end + 3 if end >= 0 else len(page), False, "", ""
            if m.end() > self.last:
                return None
            if not m[2]:
                return m.start(), page.find(">", m.end()) + 1, False, "", ""
            end = _ATTRS.match(page, m.end()).end()
            if page[end:end + 1] != ">":
                end = page.find(">", m.end())       # a quote that is never closed
            return m.start(), end + 1, bool(m[1]), m[2].lower(), page[m.end():end]
        return None


class block:
    __slots__ = ("hints", "linked", "near", "path", "tag", "text")

    def __init__(self, tag, path, hints, near, text, linked):
        self.tag, self.path, self.hints, self.near, self.text, self.linked = tag, path, hints, near, text, linked


def _attr_hints(attrs: str) -> set[str]:
    found = set()
    for m in _ATTR.finditer(attrs):
        for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", m[1] or m[2] or m[3] or "").lower()):
            if w in _HINT_OF:
                found.add(_HINT_OF[w])
    return found


def _head_end(page: str, at: int) -> int:
    """Where a head that is open at ``at`` ends: after its end tag, or before the
    body, text or the first tag that no head holds."""
    marks = tags(page)
    while m := marks.after(at):
        start, stop, closes, tag, attrs = m
        if page[at:start].strip():
            return at
        if tag == "head" and closes:
            return stop
        if tag and tag not in _HEAD:
            return start
        at = stop
        if tag in _IN_HEAD and not closes and not attrs.endswith("/"):
            end = _END[tag].search(page, at)
            if end:
                at = end.end()
            elif tag in _RAW:
                return len(page)
    return at


def blocks_of(page: str) -> list[block]:
    """The leaf blocks of a page in order."""
    out: list[block] = []
    stack: list[tuple[str, set[str]]] = []
    # how often each tag and hint is open, kept up to date as the stack changes
    open_tags: Counter = Counter()
    open_hints: Counter = Counter()
    parts: list[str] = []
    linked = in_link = at = 0
    ends: dict[str, tuple[int, int]] = {}  # place of the next end tag of skipped elements
    marks = tags(page)

    def push(tag, hints):
        stack.append((tag, hints))
        open_tags[tag] += 1
        open_hints.update(hints)

    def pop():
        tag, hints = stack.pop()
        open_tags[tag] -= 1
        open_hints.subtract(hints)
        return tag

    def upcoming(name):
        if name not in ends or 0 <= ends[name][0] < at:
            found = _END[name].search(page, at)
            ends[name] = found.span() if found else (-1, -1)
        return ends[name]

    def close():
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            path = {t for t in _SECTIONS if open_tags[t] > 0}
            hints = {h for h in _HINTS if open_hints[h] > 0}
            out.append(block(stack[-1][0] if stack else "body", path, hints, stack[-1][1] if stack else set(), text, linked))
        parts.clear()
        linked = 0

    def take(a, b):
        nonlocal linked
        if b > a:
            parts.append(page[a:b])
            if in_link:
                linked += b - a

    while m := marks.after(at):
        start, stop, closes, tag, attrs = m
        take(at, start)
        at = stop
        if not tag:
            pass
        elif tag in _SKIPPED:
            if not closes and not attrs.endswith("/"):
                close()
                end, body = upcoming(tag), upcoming("<body") if tag == "head" else (-1, -1)
                if end[0] >= 0 and not 0 <= body[0] < end[0]:
                    at = end[1]
                elif tag == "head":
                    at = _head_end(page, at)
                elif tag in _RAW:
                    at = len(page)
                else:
                    push(tag, _attr_hints(attrs))
        elif tag in _INLINE:
            if tag == "a":
                in_link = 0 if closes else 1
            elif tag in ("br", "img", "wbr"):
                parts.append(" " if tag == "br" else "")
        elif closes:
            close()
            in_link = 0
            if open_tags[tag] > 0:
                while pop() != tag:
                    pass
        else:
            close()
            if tag in _CLOSES_P and open_tags["p"] > 0:
                while pop() != "p":
                    pass
            while stack and stack[-1][0] in _SELF.get(tag, ()):
                pop()
            if tag not in _EMPTY and not attrs.endswith("/"):
                push(tag, _attr_hints(attrs))
    take(at, len(page))
    close()
    return out


def features(blocks: list[block]) -> list[list[int]]:
    """Indices of the features that hold for each block."""
    f, rows = FEATURES, []
    article = any("article" in b.path or "main" in b.path for b in blocks)
    seen_heading = False
    for b in blocks:
        words = b.text.count(" ") + 1
        share = b.linked / max(len(b.text), 1)
        row = [f["bias"], f["words:1-3" if words < 4 else "words:4-9" if words < 10 else "words:10-24" if words < 25 else "words:25-"],
               f["links:all" if share > 0.7 else "links:some" if share > 0.2 else "links:none"],
               f.get(f"leaf:{b.tag}", f["leaf:other"])]
        row += [f[f"in:{t}"] for t in _SECTIONS if t in b.path]
        row += [f[f"hint:{h}"] for h in b.hints] + [f[f"near:{h}"] for h in b.near]
        seen_heading = seen_heading or b.tag == "h1"
        for name, holds in (("ends", b.text[-1:] in ".!?:;\"”»"),
                            ("copyright", "©" in b.text), ("caps", b.text.isupper()), ("no:article", not article),
                            ("in:article+aside", "article" in b.path and bool(b.path & {"aside", "form", "nav", "footer"})),
                            ("heading-first", seen_heading)):
            if holds:
                row.append(f[name])
        rows.append(row)
    return rows


def train(pages: list[tuple[list[list[int]], list[int]]], steps: int = 250) -> dict:
    """Weights by the conditional log likelihood of labelled block sequences."""
    longest, n, k = max(len(y) for _, y in pages), len(pages), len(FEATURES)
    x = np.zeros((n, longest, k), dtype=np.float32)
    y = np.zeros((n, longest), dtype=np.int64)
    mask = np.zeros((n, longest), dtype=bool)
    for i, (rows, labels) in enumerate(pages):
        for t, r in enumerate(rows):
            x[i, t, r] = 1
        y[i, : len(labels)], mask[i, : len(labels)] = labels, True
    gold = np.eye(2)[y] * mask[..., None]
    pair = mask[:, 1:] & mask[:, :-1]
    gold_pair = np.einsum("nta,ntb->ab", gold[:, :-1] * pair[..., None], gold[:, 1:])
    gold_x = np.einsum("ntk,nta->ka", x, gold)

    def gradient(_, params):
        w, move = params
        emit = x @ w
        ahead, back = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        ahead[:, 0] = emit[:, 0]
        for t in range(1, longest):
            step = np.logaddexp(ahead[:, t - 1, 0, None] + move[0], ahead[:, t - 1, 1, None] + move[1]) + emit[:, t]
            ahead[:, t] = np.where(mask[:, t, None], step, ahead[:, t - 1])
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        for t in range(longest - 2, -1, -1):
            nxt = back[:, t + 1] + emit[:, t + 1]
            step = np.logaddexp(move[:, 0] + nxt[:, 0, None], move[:, 1] + nxt[:, 1, None])
            back[:, t] = np.where(mask[:, t + 1, None], step, 0)
        node = np.exp(ahead + back - total[:, None, None]) * mask[..., None]
        edge = np.exp(ahead[:, :-1, :, None] + move + (emit[:, 1:] + back[:, 1:])[:, :, None, :]
                      - total[:, None, None, None]) * pair[..., None, None]
        return [(np.einsum("ntk,nta->ka", x, node) - gold_x) / n + 2e-4 * w,
                (edge.sum((0, 1)) - gold_pair) / n + 2e-4 * move]

    w, move = adam(gradient, [np.zeros((k, 2)), np.zeros((2, 2))], steps, 0.1)
    return {"emit": w, "move": move}


def viterbi(model: dict, rows: list[list[int]]) -> list[int]:
    """The likeliest states of a sequence of blocks."""
    if not rows:
        return []
    emit = [model["emit"][r].sum(0) for r in rows]
    (a, b), (c, d) = model["move"]
    s0, s1 = emit[0]
    back = []
    for e0, e1 in emit[1:]:
        back.append((int(s1 + c > s0 + a), int(s1 + d >= s0 + b)))
        s0, s1 = max(s0 + a, s1 + c) + e0, max(s0 + b, s1 + d) + e1
    state = int(s1 >= s0)
    states = [state]
    for p in reversed(back):
        state = p[state]
        states.append(state)
    return states[::-1]


# ---- labelled pages --------------------------------------------------------

#: The parts of the training layouts: markup with ``{}`` for each stretch of words,
#: and the label of its blocks.  Stretches are given as least and most words.
_PARTS = {
    "menu": [('<nav><ul><li><a href="#">{1-2}</a></li><li><a href="#">{1-2}</a></li><li><a href="#">{1-3}</a></li></ul></nav>', 0),
             ('<div class="menu"><a href="#">{1-2}</a> <a href="#">{1-2}</a> <a href="#">{1-2}</a></div>', 0),
             ('<ul id="navigation"><li><a href="#">{1-2}</a><li><a href="#">{1-3}</a></ul>', 0)],
    "head": [('<header><div class="logo">{1-3}</div><p>{3-9}.</p></header>', 0), ('<header><h2>{1-4}</h2></header>', 0),
             ('<div id="masthead"><p>{2-8}</p></div>', 0)],
    "ad": [('<div class="ad">{3-25}.</div>', 0), ('<div class="sponsored"><p>{4-30}.</p></div>', 0),
           ('<div id="banner-ad"><a href="#">{3-12}</a></div>', 0), ('<aside class="promo"><p>{5-20}.</p></aside>', 0)],
    "side": [('<aside><h3>{1-4}</h3><ul><li><a href="#">{3-9}</a></li><li><a href="#">{3-9}</a></li></ul></aside>', 0),
             ('<aside><p>{10-50}.</p></aside>', 0), ('<div class="sidebar"><h3>{1-4}</h3><p>{8-40}.</p></div>', 0)],
    "notice": [('<div class="cookie-notice"><p>{6-30}.</p><button>{1-2}</button></div>', 0), ('<div role="alert">{5-25}.</div>', 0),
               ('<div class="notice">{5-30}.</div>', 0), ('<dialog><p>{5-25}.</p></dialog>', 0)],
    "form": [('<form><label>{1-3}</label><input name="q"><button>{1-2}</button></form>', 0),
             ('<form class="newsletter"><p>{4-20}.</p><button>{1-2}</button></form>', 0)],
    "comments": [('<section class="comments"><h3>{1-3}</h3><div class="comment"><p>{5-60}.</p></div><div class="comment"><p>{3-40}.</p></div></section>', 0),
                 ('<div id="comments"><p>{5-60}.</p><p>{5-60}.</p></div>', 0), ('<ul class="replies"><li>{4-40}.</li><li>{4-40}.</li></ul>', 0)],
    "foot": [('<footer>&copy; {1-3} &middot; {3-20}.</footer>', 0), ('<footer><p>{3-30}.</p><a href="#">{1-2}</a></footer>', 0),
             ('<div class="footer">&copy; {2-20}</div>', 0)],
    "text": [('<p>{5-120}.</p>', 1), ('<p>{20-90}. <a href="#">{1-4}</a> {4-20}.</p>', 1), ('<p><b>{3-40}.<br>', 1), ('<p>{1-12}.</p>', 1),
             ('<p>{1-8}</p>', 1), ('<h2>{2-8}</h2>', 1), ('<ul><li>{2-18}</li><li>{2-18}.</li></ul>', 1), ('<blockquote>{6-40}.</blockquote>', 1),
             ('<p>{15-200}. {10-50}.</p>', 1), ('<pre>{5-40}</pre>', 1), ('<table><tr><td>{1-5}</td><td>{1-5}</td></tr></table>', 1),
             ('<div>{10-80}.</div>', 1), ('<p>', 1)],
}
_HOMES = [("<article>", "</article>", 8), ("<main>", "</main>", 2), ("<main><article>", "</article></main>", 2),
          ('<div class="content">', "</div>", 2), ('<div id="post-body">', "</div>", 1), ('<article class="post">', "</article>", 2),
          ("<div>", "</div>", 1)]


def labelled_pages(words: list[str], pages: int = PAGES) -> list[tuple[list[list[int]], list[int]]]:
    """Block features and labels of training pages in the layouts above."""
    rng = np.random.default_rng(42)
    words = words or ["text"]
    share = np.array([h[2] for h in _HOMES], float)

    def fill(part):
        def stretch(m):
            n = rng.integers(int(m[1]), int(m[2]) + 1)
            some = [words[i] for i in rng.integers(0, len(words), n)]
            return html.escape(" ".join(some).capitalize(), quote=False)
        return re.sub(r"\{(\d+)-(\d+)\}", stretch, part)

    def some(kind, chance):
        return [("", _PARTS[kind][rng.integers(len(_PARTS[kind]))][0])] if rng.random() < chance else []

    out = []
    for _ in range(pages):
        opening, closing, _n = _HOMES[rng.choice(len(_HOMES), p=share / share.sum())]
        body = [("main", fill("<h1>{2-12}</h1>"))] if rng.random() < 0.8 else []
        for _ in range(int(rng.integers(0 if rng.random() < 0.1 else 1, 14))):
            body.append(("main", fill(_PARTS["text"][rng.integers(len(_PARTS["text"]))][0])))
            if rng.random() < 0.06:
                kind = ("ad", "side", "form", "notice")[rng.integers(4)]
                body += [("", fill(some(kind, 1)[0][1]))]
        if rng.random() < 0.15:
            body += [("", fill(some("comments", 1)[0][1]))]
        before = some("head", .4) + some("menu", .9) + some("notice", .25) + some("ad", .6) + some("side", .15) + some("form", .15)
        after = some("ad", .2) + some("side", .3) + some("comments", .35) + some("form", .2) + some("menu", .1) + some("foot", .9) + some("notice", .1)
        if rng.random() < 0.2:
            before = []
        if rng.random() < 0.2:
            after = []
        # a mark in the words tells the blocks of the main text apart
        page = "".join(fill(p) for _, p in before) + opening
        page += "".join(re.sub(r">([^<]+)", f">{MARK}\\1", p) if kind else p for kind, p in body) + closing
        page = "<html><head><title>t</title></head><body>" + page + "".join(fill(p) for _, p in after) + "</body></html>"
        found = blocks_of(page)
        labels = [int(MARK in b.text) for b in found]
        for b in found:
            b.text = b.text.replace(MARK, "") or "."
        if found:
            out.append((features(found), labels))
    return out


def sample_words(pages: DataFrame, most: int = SAMPLE, html_col: str = "html") -> list[str]:
    """Words of the texts of a bounded sample of pages."""
    rows = lowest(pages.select(F.col(f"`{html_col}`").alias("html")).filter("html is not null"), F.xxhash64("html"),
                  pages.count(), most, ["html"]).collect()
    return sorted({w for r in rows for b in blocks_of(r["html"]) for w in b.text.split() if len(w) < 20})


def fit(pages: DataFrame, html_col: str = "html") -> dict:
    return train(labelled_pages(sample_words(pages, html_col=html_col)))


def main_text(model: dict, page: str) -> str:
    found = blocks_of(page)
    return "\n\n".join(b.text for b, s in zip(found, viterbi(model, features(found)), strict=True) if s)


def extract(pages: DataFrame, model: dict, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    def rows(batch, texts):
        return {"page_id": batch.column("page_id"), "url": batch.column("url"),
                "text": [main_text(model, t.decode("utf-8", "replace")) for t in texts]}
    own = tables(pages, page_id=id_col, url=url_col, html=html_col).withColumn("page_id", F.col("page_id").cast("long"))
    return arrow_map(own, rows, "page_id long, url string, text string", most=4 << 20, text="html").withColumn(
        "n_chars", F.length("text").cast("long"))
