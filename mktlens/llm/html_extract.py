"""Main text of HTML pages by tree scoring.

Method: paragraphs pass points for their length and commas to their ancestors,
each container's points are discounted by the share of its text that is link
text, and the best container is kept together with siblings that look like
more of the article.  Elements that can't be article text (menus, headers,
footers, sidebars, notices, adverts, forms, comments, scripts) are cut first,
at any size; a form or an element with such a name stays if it holds the article
or the only paragraphs.

A page is one row and is handled alone, so pages spread evenly and nothing is
shuffled.

Defined cases: a NULL, empty or tagless-empty page gives an empty text; ties
go to the container that comes first; unclosed and misnested tags are closed
where the next block starts; extra columns pass through ``with_main_text``.
"""

from __future__ import annotations

import html as entities
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# HTML element groups.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe template".split())
RAW_END = {tag: re.compile(f"</{tag}", re.IGNORECASE | re.ASCII) for tag in RAW}
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
            "footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
CUT = set("head nav footer aside button select option input label textarea dialog menu svg canvas object embed audio video map math".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
# Words that name something other than the article in a class or id.
ASIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner breadcrumb breadcrumbs "
    "comment comments commentlist disqus cookie cookies consent gdpr footer masthead menu modal nav navbar navigation newsletter "
    "notice notices notification alert pager pagination popup related recommended recommendations replies reply respond share "
    "sharing sidebar signup social subscribe subscription toolbar widget login search skip copyright disclaimer outbrain taboola".split())
CLOSES_P = BLOCK - {"body", "html"}
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}}
SCOPES = {"ul", "ol", "dl", "table", "article", "section", "div", "body", "main"}

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    __slots__ = ("children", "commas", "links", "parent", "raw", "score", "size", "tag")

    def __init__(self, tag: str, raw: str, parent: Node | None):
        self.tag, self.raw, self.parent, self.children, self.score = tag, raw, parent, [], 0.0

    def attributes(self) -> dict[str, str]:
        return {m[1].lower(): next((g for g in m.groups()[1:] if g is not None), "") for m in ATTRIBUTE.finditer(self.raw)}

    def walk(self):
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo += [c for c in reversed(node.children) if isinstance(c, Node)]


def parse(page: str) -> Node:
    root = Node("#root", "", None)
    # the open elements, and the depths of those of each tag; no tag searches the path
    path, depths = [root], {}
    last = lambda name: depths[name][-1] if depths.get(name) else 0

    def close(depth: int) -> None:
        while len(path) > depth:
            tag = path.pop().tag
            for name in (tag, "#block") if tag in BLOCK else (tag,):
                depths[name].pop()

    at = position = 0
    while m := TOKEN.search(page, position):
        if m.start() > at:
            path[-1].children.append(entities.unescape(page[at:m.start()]))
        at = position = m.end()
        closing, tag, raw = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            at_depth = last(tag)
            if at_depth and (tag in BLOCK or at_depth > last("#block")):
                close(at_depth)
            continue
        if tag in CLOSES_P:
            at_depth = last("p")
            if at_depth and at_depth == max(last("#block"), last("td"), last("th")):
                close(at_depth)
        if tag in CLOSED_BY:
            at_depth = max(map(last, CLOSED_BY[tag]))
            if at_depth > max(map(last, SCOPES)):
                close(at_depth)
        top = path[-1]
        node = Node(tag, raw, top)
        top.children.append(node)
        if tag in RAW:
            # searched in the page itself: its lower case may be longer
            end = RAW_END[tag].search(page, at)
            stop = page.find(">", end.start()) if end else -1
            at = position = len(page) if stop < 0 else stop + 1
        elif tag not in VOID and not raw.endswith("/"):
            for name in (tag, "#block") if tag in BLOCK else (tag,):
                depths.setdefault(name, []).append(len(path))
            path.append(node)
    if at < len(page):
        path[-1].children.append(entities.unescape(page[at:]))
    return root


def _measure(node: Node, depth: int = 0) -> tuple[int, int]:
    """Sets the text and link text lengths, and the commas, of every element."""
    order = [*node.walk()]
    for n in order:
        n.size = sum(len(" ".join(c.split())) for c in n.children if isinstance(c, str))
        n.commas = sum(c.count(",") for c in n.children if isinstance(c, str))
        n.links = 0
    for n in reversed(order):
        if n.tag == "a":
            n.links = n.size
        if n.parent:
            n.parent.size += n.size
            n.parent.links += n.links
            n.parent.commas += n.commas
    return node.size, node.links


def _named_aside(node: Node) -> bool:
    a = node.attributes()
    if "hidden" in a or a.get("aria-hidden") == "true" or a.get("role", "").lower() in ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", "")):
        return True
    return any(p.lower() in ASIDE_WORDS for p in NAME_PART.findall(f"{a.get('class', '')} {a.get('id', '')}"))


def _scored(node: Node) -> bool:
    own_text = node.tag == "div" and not any(isinstance(c, Node) and c.tag in BLOCK for c in node.children)
    return (node.tag in ("p", "pre", "td", "blockquote") or own_text) and node.size >= 25


def _prune(root: Node) -> None:
    """Cuts the elements that can't be article text."""
    order = [*root.walk()]
    holds = {n for n in order if n.tag in ("article", "main")}
    for n in reversed(order):
        if n in holds and n.parent:
            holds.add(n.parent)
    inside: set[Node] = set()
    todo = [root]
    while todo:
        node = todo.pop()
        if node.tag in ("article", "main") or node.parent in inside:
            inside.add(node)
        node.children = [c for c in node.children if isinstance(c, str) or c.tag not in CUT and c.tag not in RAW
                         and not (c.tag == "header" and node not in inside and c not in holds)]
        todo += [c for c in node.children if isinstance(c, Node)]
    _measure(root)
    _prune_named(root)


def _prune_named(root: Node) -> None:
    """Cuts forms and named elements of any size, unless one holds the article
    or, if nothing marks one, is a wrapper: half of the text in a form, or with
    all titles.  If this leaves neither article text nor a paragraph to score,
    the paragraphs with the fewest cut elements around them stay."""
    order = [*root.walk()]
    named = {n for n in order if n.tag == "form" or n.raw and n.tag not in ("html", "body", "main", "#root", "header") and _named_aside(n)}
    if not named:
        return
    nested: set[Node] = set()
    for n in order:
        if n.parent and (n.parent.tag == "article" or n.parent in nested):
            nested.add(n)
    # an article that its name or, as HTML has it, an outer article makes a comment is not the article
    holds = {n for n in order if (n.tag == "main" or n.tag == "article" and n not in named) and n not in nested}
    marked = bool(holds)
    titles = dict.fromkeys(order, 0)
    for n in reversed(order):
        titles[n] += n.tag == "h1"
        if n.parent:
            titles[n.parent] += titles[n]
            if n in holds:
                holds.add(n.parent)
    wraps = lambda n: not marked and 2 * n.size >= root.size and (n.tag == "form" or titles[n] == titles[root] > 0)
    cut = {n for n in named if n not in holds and not wraps(n)}
    around, plain, written, fewest = {root: 0}, {}, False, None
    for n in order[1:]:
        around[n] = around[n.parent] + (n in cut)
        # text of an article that is neither heading nor link
        plain[n] = (n.tag in ("article", "main") or plain.get(n.parent, False)) and n.tag not in HEADINGS and n.tag != "a"
        written = written or plain[n] and not around[n] and any(isinstance(c, str) and c.strip() for c in n.children)
        if _scored(n) and (fewest is None or around[n] < fewest):
            fewest = around[n]
    if fewest and not written:
        saved: set[Node] = set()
        for n in order:
            up = n if _scored(n) and around[n] == fewest else None
            while up and up not in saved:
                saved.add(up)
                up = up.parent
        cut -= saved
    for n in order:
        n.children = [c for c in n.children if isinstance(c, str) or c not in cut]


def _density(node: Node) -> float:
    return node.links / node.size if node.size else 0.0


def _text(node: Node) -> str:
    out: list[str] = []
    todo: list = [*reversed(node.children)]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            out.append(" ")
            todo += [" ", *reversed(x.children)]
    return " ".join("".join(out).split())


def best_container(root: Node) -> tuple[Node | None, float]:
    for n in root.walk():
        if _scored(n):
            points = 1 + n.commas + min(n.size // 100, 3)
            up, level = n.parent, 1
            while up and up.tag != "#root" and level <= 4:
                up.score += points / (1, 1, 2, 6, 9)[level]
                up, level = up.parent, level + 1
    best, most = None, 0.0
    for n in root.walk():
        value = n.score * (1 - _density(n))
        if value > most:
            best, most = n, value
    return best, most


def blocks(parts: list[Node]) -> list[str]:
    """Texts of the block elements under ``parts``, in page order."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append(text)

    for part in parts:
        todo: list = [part]
        while todo:
            x = todo.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                held.append(x)
            elif x.tag in BLOCK:
                flush()
                todo += [None, *reversed(x.children)]
            elif x.tag in ("br", "td", "th"):
                todo += [" ", *reversed(x.children), " "]
            else:
                todo += reversed(x.children)
        flush()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    _measure(root)
    _prune(root)
    _measure(root)
    best, most = best_container(root)
    if best is None:
        # nothing long enough to score: the marked article, or all that is left
        best = next((n for n in root.walk() if n.tag in ("article", "main")), root)
    up = best
    while up and up.tag not in ("article", "main"):
        up = up.parent
    best = up or best
    kept = [best]
    if best.parent and best.tag not in ("body", "html", "main"):
        kept = []
        for s in best.parent.children:
            if not isinstance(s, Node):
                continue
            more = s.score * (1 - _density(s)) >= max(10, 0.2 * most) and s.tag not in ("article", "main")
            words = s.tag == "p" and (s.size > 80 and _density(s) < 0.25 or 0 < s.size <= 80 and s.links == 0 and _text(s).endswith("."))
            if s is best or most and (more or words) or s.tag == "h1":
                kept.append(s)
    for part in kept:
        for n in [*part.walk()]:
            if n.tag in ("ul", "ol", "dl", "table") and n.parent and _density(n) > 0.6:
                n.parent.children.remove(n)
    return "\n\n".join(blocks(kept))


def plain_text(page: str | None) -> str:
    """All visible text, a block per line."""
    if not page:
        return ""
    root = parse(page)
    for n in [*root.walk()]:
        n.children = [c for c in n.children if isinstance(c, str) or c.tag not in RAW and c.tag != "head"]
    return "\n".join(blocks([root]))


@F.pandas_udf(StringType())
def _main_text(pages: pd.Series) -> pd.Series:
    return pages.map(main_text, na_action=None).astype(object)


def with_main_text(pages: DataFrame) -> DataFrame:
    """``pages`` with a column ``text``: the main text of ``html``."""
    return pages.withColumn("text", _main_text("html"))


def op1_html_extraction(pages: DataFrame) -> DataFrame:
    return with_main_text(pages.select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
