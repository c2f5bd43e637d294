"""Main text of a web page by the maximum-scoring run of its tokens.

A page is a sequence of tokens, words and tags. A word scores the log odds,
from labelled pages, that a word in its place (enclosing elements, their class
and id words, links, the length of its block) is main text; a tag scores
against, more so the more often it stands outside the main text. One linear
scan finds the contiguous run of the greatest sum: the content region. Blocks
within the region whose words score against (an advert or a form inside the
article) are left out, and the region grows to the ends of the element that
holds it.

The weights are fitted by logistic regression on labelled pages, (html, parts)
with ``parts`` telling of each text block if it is main text; ``labelled()``
makes a bounded set of them from a rule, and ``train`` takes any.

Blocks: block-level elements part the text; ``br`` and inline elements do not.
Character references are decoded, white space within a block becomes one
space, blocks are joined by a blank line. Defined cases: null, empty or purely
decorative html gives the empty text; unclosed elements run to the end of
their parent, scripts and other raw text to that of the page, an unclosed or
self-closed svg or math is empty; a null id is kept; repeated rows give repeated
rows; of runs that score alike the first is taken; very long pages are taken whole,
in time linear in their length; only the named columns are read, so further columns
with any names do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

import html as html_lib
import math
import random
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import released

# Element classes of HTML.
DROPPED = ("script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "math", "head", "title",
           "textarea", "select", "button", "option")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr br img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset("address article aside blockquote details dir div dl fieldset figure footer form h1 h2 h3 h4 h5 "
                     "h6 header hr main menu nav ol p pre section table ul".split())

# Elements left out before the tags are read; of the raw ones no tag but their own end tag is one.
RAW = frozenset("script style textarea title iframe".split())
SKIPPED = (*sorted(RAW), "noscript", "template", "svg", "object", "canvas", "math", "select", "button")
_MARK = re.compile(r"<!--|<!\[CDATA\[|\]\]>|<[!?]|<(" + "|".join(SKIPPED) + r")(?=[\s/>])", re.I)
_END = {e: re.compile(rf"</{e}(?=[\s/>])", re.I) for e in SKIPPED}
_OPEN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Block:
    __slots__ = ("context", "linked", "tags", "text", "words")

    def __init__(self, context):
        self.context, self.text, self.words, self.linked, self.tags = context, [], 0, 0, []


def _names(attributes: str) -> tuple[str, ...]:
    out = []
    for m in _ATTR.finditer(attributes):
        out += [w.lower() for w in _NAME.findall(m[2] or m[3] or m[4] or "")]
    return tuple(dict.fromkeys(out))


class _Ends:
    """Where tags end, in time linear in the page: a ``>`` outside quotes, until a
    quote is open to the end of the page; from there on quotes tell nothing."""

    def __init__(self, page: str):
        self.page, self.quotes = page, True

    def after(self, pos: int) -> int:
        """The position after the tag's end, sought from ``pos``; 0 if no tag ends there."""
        at = pos
        while self.quotes:
            m = _STOP.search(self.page, at)
            if m is None:
                break
            if m[0] == ">":
                return m.end()
            at = self.page.find(m[0], m.end()) + 1
            if not at:
                break
        self.quotes = False
        return self.page.find(">", pos) + 1


def _skipped(page: str) -> str:
    """The page with a space for each comment, declaration and skipped element.

    A self-closed element that is not raw is empty. Without an end tag a raw
    element runs to the end of the page, of svg and math only the tag goes, and
    another's tag stays: its text ends with its parent. Each end tag is sought
    to the end of the page once at most.
    """
    out, pos, at, open_ended, ends = [], 0, 0, set(), _Ends(page)
    while m := _MARK.search(page, at):
        end = m.end()
        if m[0] == "<!--":
            end = page.find("-->", end) + 3
            end = end if end > 2 else len(page)
        elif m[0] in ("<!", "<?"):
            end = page.find(">", end) + 1 or len(page)
        elif m[1]:
            name, end = m[1].lower(), ends.after(end)
            if not end:                      # no tag ends any more
                break
            if name in RAW or page[end - 2] != "/":
                close = None if name in open_ended else _END[name].search(page, end)
                closed = page.find(">", close.end()) + 1 if close else 0
                if closed:
                    end = closed
                elif name in RAW:
                    end = len(page)
                else:
                    open_ended.add(name)
                    if name not in ("svg", "math"):
                        at = end
                        continue
        out += (page[pos:m.start()], " ")
        pos = at = end
    out.append(page[pos:])
    return "".join(out)


def _tags(page: str):
    """(start, end, closing, name, attributes) of every tag, in order."""
    ends, at = _Ends(page), 0
    while m := _OPEN.search(page, at):
        at = ends.after(m.end())
        if not at:
            return
        yield m.start(), at, bool(m[1]), m[2].lower(), page[m.end():at - 1]


def blocks_of(page: str) -> list[Block]:
    """The page's text blocks in order, with their context and the tags before them."""
    page = _skipped(page) if "<" in page else page
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], int]] = []
    tags: list[str] = []
    block = None
    pos = 0

    def say(raw: str):
        nonlocal block, tags
        if any(e[0] in DROPPED for e in stack):
            return
        if block is None:
            if not raw.strip():
                return
            block = Block(tuple(stack))
            block.tags, tags = tags, []
            out.append(block)
        block.text.append(raw)
        n = len(raw.split())
        block.words += n
        if any(e[0] == "a" for e in stack):
            block.linked += n

    for start, end, closing, tag, attributes in _tags(page):
        if start > pos:
            say(page[pos:start])
        pos = end
        tags.append(tag)
        if tag not in INLINE:
            block = None
        elif tag == "br" and block is not None:
            block.text.append(" ")
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        elif tag not in VOID and not attributes.endswith("/"):
            if tag in CLOSES_P or tag == "li":       # an open p (or li) ends here, and what it holds
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == ("li" if tag == "li" else "p"):
                        del stack[k:]
                        break
                    if stack[k][0] in CLOSES_P:
                        break
            stack.append((tag, _names(attributes) if "=" in attributes else (), start))
    if pos < len(page):
        say(page[pos:])
    return out


def around_all(blocks: list[Block]) -> set[int]:
    """The forms that hold every block of the page: they tell nothing of one."""
    held = [{e[2] for e in b.context if e[0] == "form"} for b in blocks]
    return set.intersection(*held) if held else set()


def features(b: Block, whole: set[int] = frozenset()) -> list[str]:
    """What is known of a block's place, as names, but for the elements ``whole``."""
    f = ["bias"]
    inside = set()
    context = [e for e in b.context if e[2] not in whole] if whole else b.context
    for tag, names, _ in context:
        if tag not in INLINE:
            inside.add("in " + tag)
        inside.update("name " + n for n in names)
    # the nearest three elements tell more than what holds the whole page
    close = [e for e in context if e[0] not in INLINE][-3:]
    inside.update("near " + e[0] for e in close)
    f += sorted(inside)
    own = next((e[0] for e in reversed(context) if e[0] not in INLINE), "body")
    f.append("tag " + own)
    f.append("long" if b.words >= 12 else "short" if b.words < 4 else "middling")
    if 2 * b.linked > b.words:
        f.append("mostly link")
    return f


def text_of(b: Block) -> str:
    return " ".join(html_lib.unescape("".join(b.text)).split())


def train(pages) -> tuple[dict[str, float], dict[str, float]]:
    """(word weights, tag costs) from (html, [is main of each block]) pages."""
    rows, seen = [], {True: Counter(), False: Counter()}
    for page, main in pages:
        blocks = blocks_of(page)
        whole = around_all(blocks)
        for b, y in zip(blocks, main, strict=True):
            rows.append((features(b, whole), y, min(b.words, 20)))
            seen[y].update(b.tags)
    w: Counter = Counter()
    scale: Counter = Counter()
    for _ in range(8):                   # logistic regression with per-feature steps
        for f, y, n in rows:
            p = 1 / (1 + math.exp(-max(-30, min(30, sum(w[x] for x in f)))))
            g = (p - y) * min(1.0, n / 8)
            for x in f:
                scale[x] += g * g
                w[x] -= 0.5 * g / math.sqrt(1e-2 + scale[x])
    costs = {t: min(3.0, max(0.1, math.log((seen[False][t] + 1) / (seen[True][t] + 1)) + 0.5))
             for t in {*seen[True], *seen[False]}}
    return dict(w), costs


# Class and id words seen on pages, of main text, of other parts, and of neither.
_MAIN_NAMES = "article content post entry story main body text page detail artikel inhalt beitrag contenu contenido articulo".split()
_NEUTRAL = "wrapper wrap container row col inner outer grid box block section layout left right center wide clearfix module component".split()
_OTHER = {
    "nav": "nav menu navigation breadcrumb breadcrumbs topnav navbar", "header": "header masthead top banner logo",
    "footer": "footer bottom copyright legal imprint colophon impressum", "aside": "sidebar aside related widget rail recommended popular trending",
    "div": "ad ads advert advertisement adsbygoogle sponsor sponsored promo promotion teaser banner notice alert cookie cookies consent gdpr popup "
           "modal overlay warning message newsletter subscribe signup share social toolbar tags comments comment replies "
           "reply respondent discussion disqus sidebar menu nav footer header related login search pagination pager skip "
           "breadcrumb breadcrumbs copyright disclaimer kommentare kommentar werbung anzeige seitenleiste hinweis kopfzeile fusszeile "
           "commentaires commentaire publicite avis entete comentarios comentario publicidad anuncio aviso cabecera",
    "section": "comments comment reader responses replies discussion related recommended newsletter notice promo ads kommentare commentaires comentarios",
    "ul": "menu nav links tags share social pagination", "form": "form search login subscribe comment newsletter contact",
}


def labelled(n: int = 600, seed: int = 7):
    """A bounded set of labelled pages: ``n`` layouts drawn by a rule.

    Main text stands in named, neutrally named or bare elements, under any number
    of neutral wrappers, on some pages all within one form; other parts carry
    names in several languages or stand in elements of their own.
    """
    r = random.Random(seed)
    say = lambda lo, hi: " ".join("".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 9)))
                                  for _ in range(r.randint(lo, hi)))

    def name(words):
        return f' {r.choice(("class", "class", "id"))}="{r.choice(words)}{r.choice(("", "", "-box", "-1", " wide"))}"'

    def neutral():
        made = "".join(r.choice("bcdfghjkmpqvwxz") for _ in range(r.randint(3, 8)))
        return r.choice(("", name([*_NEUTRAL, f"col-{r.randint(1, 12)}"]), f' class="{made}"'))

    def wrapped(inner, most):
        for _ in range(r.randint(0, most)):
            t = r.choice(("div", "div", "div", "section"))
            inner = f"<{t}{neutral()}>{inner}</{t}>"
        return inner

    def other():
        tag = r.choice(list(_OTHER))
        attr = name(_OTHER[tag].split()) if tag in ("div", "section", "ul") or r.random() < 0.5 else ""
        kind, k = r.random(), r.randint(1, 6)
        if tag in ("nav", "ul") or kind < 0.25:
            items, inner = k, "".join(f'<li><a href="/{i}">{say(1, 3)}</a></li>' for i in range(k))
            return f"<{tag}{attr}>" + (inner if tag == "ul" else wrapped(f"<ul>{inner}</ul>", 1)) + f"</{tag}>", [False] * items
        if kind < 0.6:
            return f"<{tag}{attr}>{say(2, 40)}</{tag}>", [False]
        head = f"<h3>{say(1, 4)}</h3>" if r.random() < 0.5 else ""
        return (f"<{tag}{attr}>{wrapped(head + ''.join(f'<p>{say(3, 60)}</p>' for _ in range(k)), 1)}</{tag}>",
                [False] * (k + bool(head)))

    for _ in range(n):
        parts = [other() for _ in range(r.randint(1, 4))]
        wrap = r.choice(("article", "article", "main", "div", "div", "section", ""))
        attr = r.choice((name(_MAIN_NAMES), name(_MAIN_NAMES), neutral())) if wrap in ("div", "section") else \
            name(_MAIN_NAMES) if wrap and r.random() < 0.3 else ""
        inner, labels = (f"<h1>{say(2, 9)}</h1>", [True]) if r.random() < 0.8 else ("", [])
        for _ in range(r.randint(1, 9)):
            kind = r.random()
            if kind < 0.80:
                t = r.choice(("p", "p", "p", "p", "p", "blockquote", "pre", "h2", "h3"))
                inner += f"<{t}>{say(1, 70) if t not in ('h2', 'h3') else say(1, 6)}</{t}>"
                labels.append(True)
            elif kind < 0.9:
                k = r.randint(1, 5)
                inner += "<ul>" + "".join(f"<li>{say(2, 20)}</li>" for _ in range(k)) + "</ul>"
                labels += [True] * k
            else:
                piece, no = other()
                inner += piece
                labels += no
        parts.append((wrapped(f"<{wrap}{attr}>{wrapped(inner, 1)}</{wrap}>" if wrap else inner, 2), labels))
        parts += [other() for _ in range(r.randint(1, 4))]
        body = "".join(p for p, _ in parts)
        body = r.choice((body, body, body, f"<div{neutral()}>{body}</div>", f'<form method="post" id="{r.choice(("form1", "page", "aspnet"))}">{body}</form>'))
        yield "<html><body>" + body + "</body></html>", [y for _, ys in parts for y in ys]


def main_region(scores: list[float]) -> tuple[int, int]:
    """[first, end) of the run of the greatest positive sum, by one scan; empty
    if there is none, the first of equals."""
    best, region, total, first = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, first = 0.0, i
        total += s
        if total > best:
            best, region = total, (first, i + 1)
    return region


def _holder(context) -> tuple[int, ...]:
    """The elements around a block, without its own."""
    return tuple(e[2] for e in context if e[0] not in INLINE)[:-1]


def grown(blocks: list[Block], odds: list[float], first: int, end: int) -> list[int]:
    """The region's blocks that score for main text, and those beyond it in the
    innermost element that holds them all (for the page's body: its direct
    children), so that an advert within the article does not part it."""
    inside = [k for k in range(len(blocks)) if first <= 2 * k + 1 < end and odds[k] > 0]
    if not inside:
        return []
    holder = _holder(blocks[inside[0]].context)
    for k in inside[1:]:
        other = _holder(blocks[k].context)
        n = 0
        while n < min(len(holder), len(other)) and holder[n] == other[n]:
            n += 1
        holder = holder[:n]
    known, top = set(inside), len(holder) <= 2          # top: html and body at most

    def held(b: Block) -> bool:
        own = _holder(b.context)
        return own == holder if top else own[:len(holder)] == holder

    return [k for k, b in enumerate(blocks) if k in known or odds[k] > 0 and held(b)]


def extract(page: str | None, model) -> str:
    weights, costs = model
    blocks = blocks_of(page or "")
    whole = around_all(blocks)
    odds = [max(-4.0, min(4.0, sum(weights.get(x, 0.0) for x in features(b, whole)))) for b in blocks]
    scores = []                          # the tags before a block, then its words
    for b, o in zip(blocks, odds, strict=True):
        scores += [-sum(costs.get(t, 0.3) for t in b.tags), o * b.words]
    return "\n\n".join(t for k in grown(blocks, odds, *main_region(scores)) if (t := text_of(blocks[k])))


def _extractor(model):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([extract(h.as_py(), model) for h in b.column(2)], pa.string())],
                names=["page_id", "url", "text"])
    return run


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              model=None) -> DataFrame:
    """One row per page: page_id, url, text."""
    model = model or train(labelled())
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html")).mapInArrow(released(_extractor(model)), "page_id long, url string, text string")
