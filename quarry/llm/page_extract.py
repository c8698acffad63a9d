"""Main text of web pages by a linear-chain conditional random field over the page's leaf blocks.

A page's mark-up is read into leaf blocks: runs of text between block-level tags, with the tags, classes and ids
that enclose them.  Each block has sparse features (enclosing tags, words of their classes and ids, what the
text looks like); a two-label chain (main text or not) with a weight per feature and label and per pair of
neighbouring labels is trained by maximum likelihood on labelled pages and decoded by Viterbi.

Labelled pages are a bounded sample of the given pages whose main text is marked by ``article`` or ``main``,
and the same blocks set into other layouts (``LAYOUTS``), so that pages without such marks are covered.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.words import slices, tidy

#: Marked pages that training reads whole, about (a hash of id and page picks them), and layouts made of each.
TRAIN_PAGES = 200
LAYOUTS_EACH = 4
STEPS, RATE, PENALTY = 200, 0.15, 5e-4

_BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table "
                   "tbody td tfoot th thead tr ul br head iframe object label".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no mark-up; what stands in xmp is shown as it is, the rest not at all.  Formulas and drawings are
#: mark-up like any other, but for their sources and descriptions.
_RAW = ("script", "style", "title", "textarea", "noscript", "template", "iframe", "xmp", "noembed", "noframes", "annotation", "annotation-xml", "desc", "metadata")
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:(?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+))>""", re.S)
_ATTR = re.compile(r"""(?:^|[\s"'])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in _RAW}
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_CLOSES_P = _BLOCK - {"br", "label", "button", "option", "optgroup", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "html", "body", "head", "select"}


class Block:
    __slots__ = ("text", "path", "names", "linked")

    def __init__(self, text: str, path: tuple[str, ...], names: frozenset[str], linked: int):
        self.text, self.path, self.names, self.linked = text, path, names, linked


def leaf_blocks(source: str | None) -> list[Block]:
    """The page's leaf blocks in order, white space single and references decoded; raw-text elements
    (scripts, styles, the title) hold none, but for ``xmp``.  Unclosed and stray tags are borne; the time goes with the
    page's length, as no tag is looked for after the last ``>``."""
    blocks: list[Block] = []
    stack: list[tuple[str, frozenset[str]]] = []               # each open element and all names of it and around it
    open_: Counter[str] = Counter()
    held: list[str] = []
    linked = 0
    links = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            blocks.append(Block(text, tuple(t for t, _ in stack if t in _BLOCK), stack[-1][1] if stack else frozenset(), linked))
        held.clear()
        linked = 0

    def pop_to(i: int) -> None:
        nonlocal links
        for t, _ in stack[i:]:
            links -= t == "a"
            open_[t] -= 1
        del stack[i:]

    source = source or ""
    at, stop = 0, (source or "").rfind(">") + 1
    while True:
        m = _TAG.search(source, at, stop)
        to = m.start() if m else source.find("<!--", at)
        text = source[at:to if to >= 0 else len(source)]
        if text:
            held.append(text)
            if links > 0:
                linked += len(text.strip())
        if not m:
            break
        at = m.end()
        if not m[2]:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                break                                          # a comment that never ends
            continue
        tag = m[2].lower()
        if tag in _RAW_END:
            if not m[1]:
                if tag in ("textarea", "iframe", "xmp"):
                    flush()
                end = _RAW_END[tag].search(source, at)
                if tag == "xmp":
                    held.append(html.escape(source[at:end.start() if end else len(source)]))
                    flush()
                at = end.end() if end else len(source)
            continue
        if tag in _BLOCK:
            flush()
        if m[1]:
            for i in range(len(stack) - 1, -1, -1) if open_[tag] else ():
                if stack[i][0] == tag:
                    pop_to(i)
                    break
            continue
        if tag in _VOID or m[0].endswith("/>") and tag not in _BLOCK:
            continue
        if tag in _CLOSES_P:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    pop_to(i)
                    break
                if stack[i][0] in _BLOCK:
                    break
        if tag == "li":
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "li":
                    pop_to(i)
                    break
                if stack[i][0] in ("ul", "ol", "menu"):
                    break
        names = stack[-1][1] if stack else frozenset()
        if m[3]:
            own = {p.lower() for k in _ATTR.finditer(m[3]) for p in _PART.findall(k[2])}
            names = names if own <= names else names | own
        links += tag == "a"
        open_[tag] += 1
        stack.append((tag, names))
    flush()
    return blocks


#: Words of classes and ids that name what is not main text, as one feature, and such tags.
_ASIDE_NAMES = frozenset("ad ads advert adverts advertisement advertising aside banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer "
                         "discussion footer form gdpr login masthead menu modal nav navbar navigation newsletter notice notices overlay pagination popup "
                         "promo promoted recommended related replies search share sharing sidebar sign signup social sponsor sponsored subscribe subscription "
                         "tags toolbar widget".split())
_MAIN_NAMES = frozenset("article body content entry main markdown post prose story text".split())
_ASIDE_TAGS = frozenset("aside button dialog fieldset footer form label legend menu nav option search select".split())
_HINTS = re.compile(r"©|copyright|cookie|subscribe|newsletter|log ?in|sign ?(?:up|in)|share|repl(?:y|ies)|comment|advert|sponsor|privacy|all rights", re.I)


def features(blocks: list[Block]) -> list[list[str]]:
    """The sparse features of each block of a page."""
    out = []
    for b in blocks:
        words = b.text.count(" ") + 1
        own = [f"t:{t}" for t in set(b.path)]
        own += [f"n:{x}" for x in b.names]
        if b.names & _ASIDE_NAMES:
            own.append("aside name")
        if b.names & _MAIN_NAMES:
            own.append("main name")
        if not _ASIDE_TAGS.isdisjoint(b.path):
            own.append("aside tag")
        own.append(f"leaf:{b.path[-1] if b.path else '-'}")
        own.append(f"size:{min(8, int(math.log2(words)))}")
        share = b.linked / max(1, len(b.text))
        own.append(f"link:{0 if share < 0.1 else 1 if share < 0.5 else 2}")
        own.append("stop" if b.text[-1] in ".!?:。\"”" else "open")
        if _HINTS.search(b.text):
            own.append("hint")
        own.append("bias")
        out.append(own)
    return out


class ChainField:
    """A two-label linear-chain conditional random field over sparse features."""

    def __init__(self, index: dict[str, int], weight: np.ndarray, move: np.ndarray):
        self.index, self.weight, self.move = index, weight, move      # move: from, to; row 2: at the start

    @classmethod
    def fit(cls, pages: list[tuple[list[list[str]], list[int]]], steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY) -> ChainField:
        """Maximum likelihood (with a squared penalty) by Adam over all pages, forward-backward in each step."""
        pages = [p for p in pages if p[0]]
        index = {f: i for i, f in enumerate(sorted({f for x, _ in pages for block in x for f in block}))}
        n, longest = len(pages), max((len(x) for x, _ in pages), default=0)
        weight, move = np.zeros((len(index), 2)), np.zeros((3, 2))
        if not n:
            return cls(index, weight, move)
        page, place, feat = (np.array(x) for x in zip(*((i, t, index[f]) for i, (x, _) in enumerate(pages) for t, block in enumerate(x) for f in block), strict=True))
        gold = np.zeros((n, longest), np.int64)
        live = np.zeros((n, longest), bool)
        for i, (_, y) in enumerate(pages):
            gold[i, :len(y)], live[i, :len(y)] = y, True
        rows = np.arange(n)
        m = [np.zeros_like(weight), np.zeros_like(move)]
        v = [np.zeros_like(weight), np.zeros_like(move)]
        one = np.eye(2)
        for step in range(1, steps + 1):
            emit = np.zeros((n, longest, 2))
            np.add.at(emit, (page, place), weight[feat])
            alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
            alpha[:, 0] = emit[:, 0] + move[2]
            for t in range(1, longest):
                alpha[:, t] = emit[:, t] + np.logaddexp(alpha[:, t - 1, :1] + move[0], alpha[:, t - 1, 1:] + move[1])
            for t in range(longest - 2, -1, -1):
                nxt = emit[:, t + 1] + beta[:, t + 1]
                beta[:, t] = np.where(live[:, t + 1, None], np.logaddexp(move[:2, 0] + nxt[:, :1], move[:2, 1] + nxt[:, 1:]), 0)
            end = alpha[rows, live.sum(axis=1) - 1]
            total = np.logaddexp(end[:, 0], end[:, 1])
            node = np.where(live[:, :, None], np.exp(alpha + beta - total[:, None, None]), 0)
            diff = np.where(live[:, :, None], one[gold], 0) - node
            grad_w = np.zeros_like(weight)
            np.add.at(grad_w, feat, diff[page, place])
            grad_m = np.zeros_like(move)
            grad_m[2] = diff[:, 0].sum(axis=0)
            for t in range(1, longest):
                on = live[:, t]
                pair = np.exp(alpha[on, t - 1, :, None] + move[:2][None] + (emit[on, t] + beta[on, t])[:, None, :] - total[on, None, None])
                seen = one[gold[on, t - 1]][:, :, None] * one[gold[on, t]][:, None, :]
                grad_m[:2] += (seen - pair).sum(axis=0)
            for k, (param, grad) in enumerate(((weight, grad_w / n - penalty * weight), (move, grad_m / n - penalty * move))):
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                param += rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        return cls(index, weight, move)

    def decode(self, page: list[list[str]]) -> list[int]:
        """The most probable labels of a page's blocks (Viterbi; ties go to label 0)."""
        if not page:
            return []
        get, w = self.index.get, self.weight.tolist()
        (m00, m01), (m10, m11), (s0, s1) = self.move.tolist()
        back: list[tuple[int, int]] = []
        a = b = 0.0
        for t, block in enumerate(page):
            e0 = e1 = 0.0
            for f in block:
                i = get(f)
                if i is not None:
                    e0 += w[i][0]
                    e1 += w[i][1]
            if not t:
                a, b = s0 + e0, s1 + e1
                continue
            from0, from1 = int(b + m10 > a + m00), int(b + m11 > a + m01)
            a, b = (b + m10 if from0 else a + m00) + e0, (b + m11 if from1 else a + m01) + e1
            back.append((from0, from1))
        now = int(b > a)
        out = [now]
        for choice in reversed(back):
            now = choice[now]
            out.append(now)
        return out[::-1]


# Layouts: outer mark-up around MAIN, with MENU, AD, FOOT and SIDE blocks; labels follow from what stands where.
LAYOUTS: tuple[str, ...] = (
    '<header class="site-header"><a>{menu}</a></header><nav class="menu"><ul>{menu_li}</ul></nav><div id="{main_name}">{main}</div>'
    '<aside class="sidebar widget">{side}</aside><footer>{foot}</footer>',
    '<div class="header top-bar">{menu_p}</div><div class="navbar navigation"><ul>{menu_li}</ul></div><div class="cookie-notice banner consent"><p>{side}</p><button>OK</button></div>'
    '<div class="{main_name}">{main}</div><div class="{comment_name}" id="{comment_name}"><h3>Comments</h3>{comment}</div><div class="footer copyright">{foot}</div>',
    '<nav role="navigation">{menu_p}</nav><main><div class="ad ads advertisement sponsored">{side}</div><h1>{title}</h1>{body}<div class="share social">{menu_p}</div></main>'
    '<form class="search login subscribe newsletter"><label>{side}</label><button>Send</button></form><footer class="site-footer">{foot}</footer>',
    '<header>{menu_p}</header><article class="story">{main}<section class="{comment_name}"><ul>{comment_li}</ul></section><div class="related recommended"><ul>{menu_li}</ul></div></article>'
    '<aside>{side_p}</aside><footer>{foot}</footer>',
    '<div id="menu"><ul>{menu_li}</ul></div><div class="alert notice warning"><p>{side}</p></div><table><tr><td class="sidebar">{side_p}</td><td class="{main_name}">{main}</td></tr></table>'
    '<div id="footer">{foot}</div>',
    '<nav><ul>{menu_li}</ul></nav><div class="{aside_name}">{side}</div><article>{main}<aside class="promo ad">{side}</aside>{body}<form><p>{side}</p></form></article>'
    '<div class="popup modal overlay newsletter"><p>{side}</p></div><section id="comments" class="reader-comments discussion">{comment}</section><footer>{foot}</footer>',
    '<header><h2>{menu}</h2></header><section class="notices"><p>{side}</p></section><article><header><h1>{title}</h1></header>{body}<footer>{foot}</footer></article>'
    '<div class="breadcrumb breadcrumbs pagination">{menu_p}</div><footer>{foot}</footer>',
    '<article>{body}</article><footer>{foot}</footer>',
    '<div class="{main_name}">{body}</div><div class="{aside_name}">{side_p}</div>',
    '<nav class="nav"><ul>{menu_li}</ul></nav><article>{main}</article><div class="comment replies">{comment}</div><div id="{aside_name}">{side_p}</div><footer>{foot}</footer>',
)
_LOREM = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua.".split()


def _marked(text: str, main: bool) -> str:
    """The escaped text with its label as a mark that blocks of a training page are told by."""
    return ("\x01" if main else "\x02") + html.escape(text)


def dressed(blocks: list[tuple[str, int]], rnd: random.Random) -> str:
    """A labelled page: the texts of a page's blocks (text, main or not) in a random layout."""
    main = [t for t, y in blocks if y] or [" ".join(rnd.choices(_LOREM, k=rnd.randrange(4, 60))) for _ in range(4)]
    rest = [t for t, y in blocks if not y] or [" ".join(rnd.choices(_LOREM, k=rnd.randrange(1, 12))) for _ in range(4)]
    no = lambda: _marked(rnd.choice(rest + main[:1]), False)  # noqa: E731  wording alone does not tell what is main
    many = lambda tag, some, a, b: "".join(f"<{tag}>{some()}</{tag}>" for _ in range(rnd.randrange(a, b)))
    sentence = lambda: _marked(" ".join(rnd.choice(main).split()[: rnd.randrange(3, 40)]), False)
    para = rnd.choice(["p", "p", "p", "div", "section"])
    names, asides = sorted(_MAIN_NAMES), sorted(_ASIDE_NAMES)

    def part(t: str) -> str:
        """A main block, at times of another kind, at times with an aside after it."""
        tag = rnd.choice(["h2", "h3", "li", "li", "blockquote", "div", "td"]) if rnd.random() < 0.25 else para
        if rnd.random() < 0.15:
            t = " ".join(t.split()[:rnd.randrange(1, 5)])
        odd = rnd.choice([f'<div class="{rnd.choice(asides)}">{sentence()}</div>', f"<aside>{sentence()}</aside>", f'<div class="{rnd.choice(asides)}"><p>{sentence()}</p></div>',
                          f"<form><p>{sentence()}</p><button>{no()}</button></form>", f"<nav>{no()}</nav>"]) if rnd.random() < 0.15 else ""
        own = f"<{tag}>{_marked(t, True)}" + ("" if rnd.random() < 0.1 else f"</{tag}>")
        return (f"<ul>{own}</ul>" if tag == "li" else own) + odd

    body = "".join(map(part, main[1:] or main))
    return rnd.choice(LAYOUTS).format(
        main_name=f"{rnd.choice(names)} {rnd.choice(['', 'wrap', 'area', 'inner', 'x'])}", aside_name=rnd.choice(asides), comment_name=rnd.choice(["comments", "comment", "replies", "discussion"]),
        menu=no(), menu_li=many("li", lambda: f"<a>{no()}</a>", 2, 8), menu_p=many("a", no, 1, 4), side=sentence(), side_p=many("p", sentence, 1, 4),
        title=_marked(main[0], True), main=f"<h1>{_marked(main[0], True)}</h1>{body}", body=body, foot=_marked(rnd.choice(["© ", ""]) + rnd.choice(rest), False),
        comment=many("p", sentence, 1, 5), comment_li=many("li", sentence, 1, 5))


def _told(source: str) -> tuple[list[list[str]], list[int]]:
    """Features and labels of a dressed page."""
    blocks = leaf_blocks(source)
    labels = [int("\x01" in b.text) for b in blocks]
    for b in blocks:
        b.text = b.text.replace("\x01", "").replace("\x02", "").strip() or "-"
    return features(blocks), labels


def by_marks(blocks: list[Block]) -> list[int] | None:
    """Labels of a page whose main text is marked: what is inside article or main but in none of their menus,
    headers' forms, asides and footers.  None if the page has no such mark."""
    if not any(t in b.path for b in blocks for t in ("article", "main")):
        return None
    out = []
    for b in blocks:
        inner = max((i for i, t in enumerate(b.path) if t in ("article", "main")), default=-1)
        out.append(int(inner >= 0 and not any(t in ("nav", "aside", "form", "footer") for t in b.path[inner:])
                       and not b.names & {"comments", "comment", "ad", "ads", "related", "share", "notice", "sidebar", "cookie"}))
    return out


def train(pages: DataFrame, train_pages: int = TRAIN_PAGES, page_col: str = "page_id", html_col: str = "html") -> ChainField:
    """A field fitted to about ``train_pages`` whole marked pages, copies under other ids being pages of their
    own; with no marked page, to the layouts alone."""
    rows = pages.select(F.col(page_col).alias("id"), F.col(html_col).alias("html")).where(F.col("html").rlike(r"(?i)<(article|main)[\s/>]"))
    n = rows.count()
    share = min(1.0, train_pages / max(1, n))
    place = F.xxhash64(F.col("id").cast("string"), F.lit("|"), "html")
    drawn = (rows.withColumn("place", place).where(F.pmod("place", F.lit(1 << 40)) / (1 << 40) < share)
             .groupBy("place").agg(F.min("html").alias("html")).orderBy("place").limit(4 * train_pages))
    told: list[tuple[list[list[str]], list[int]]] = []
    rnd = random.Random(11)
    texts: list[list[tuple[str, int]]] = []
    for source in sorted(r["html"] for r in drawn.collect()):
        blocks = leaf_blocks(source)
        labels = by_marks(blocks)
        if labels:
            told.append((features(blocks), labels))
            texts.append([(b.text, y) for b, y in zip(blocks, labels, strict=True)])
    for blocks in texts or [[]] * 50:
        for _ in range(LAYOUTS_EACH):
            told.append(_told(dressed(blocks, rnd)))
    return ChainField.fit(told)


def extract_text(source: str | None, field: ChainField) -> str:
    blocks = leaf_blocks(source)
    return " ".join(b.text for b, y in zip(blocks, field.decode(features(blocks)), strict=True) if y)


def extract_pages(pages: DataFrame, field: ChainField | None = None, page_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page id, url, text, n_chars)``, one row per row of ``pages``; text is empty for a null or empty page
    and for one without main text.  Repeated rows are pages of their own; pages are read whole.  Without a
    ``field``, one is trained on a bounded sample of the table."""
    field = train(pages, page_col=page_col, html_col=html_col) if field is None else field
    base = pages.select(F.col(page_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    held = pages.sparkSession.sparkContext.broadcast((field.index, field.weight, field.move))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ChainField(*held.value)
        for batch in batches:
            for part in slices(batch):
                texts = [extract_text(x, own) for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                                                 names=["id", "url", "text", "n_chars"])

    return base.mapInArrow(run, f"id {kind}, url string, text string, n_chars long").withColumnRenamed("id", page_col)
