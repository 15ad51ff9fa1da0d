"""Main text of web pages by composite text density.

For every block of the page's tree: its characters per tag, adjusted by how many of its characters
and tags belong to links. Of the tags inside a block only links count, so that emphasis does not make
a paragraph look sparse; the text a block holds itself counts as a child of its own. A node's density sum is the sum of its children's densities. The node with the
largest density sum is the core of the article; the smallest density on the path from it to the body
is the threshold a branch has to reach, and in every branch that does the subtree with the largest
density sum is content. Elements that by their name, role or class are not part of an article are
left out of the tree, unless they hold the main element, all articles or most of the page's text: such a
wrapper stays, and the densities decide on what is in it. A compound name counts by each of its words
(comment-list, site-footer), but for what stands behind a negation or a "has" (no-comments, has-sidebar).
"""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_left
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.shared import text_of

# Fixed values, from the HTML standard and common naming.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body html caption dd dt legend li summary tbody td tfoot th thead tr".split())
#: An element of the key ends when one of the values starts inside it.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
#: By name of the element that starts: those it ends.
ENDS = {n: [k for k, v in ENDED_BY.items() if n in v] + ["p"] * (n in CLOSES_P) for n in CLOSES_P.union(*ENDED_BY.values())}
SCOPES = frozenset("article aside body div html main nav ol section table td th ul".split())
LEFT_OUT = frozenset("aside button dialog footer form head input label menu nav select".split()) | RAW
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
NAMES = frozenset(
    "ad ads adslot advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus "
    "footer gdpr masthead menu menus modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion "
    "related replies reply responses share sharing sidebar sidenav signup skip social sponsor sponsored subscribe toolbar widget".split()
)
#: Of these, what readers say: no article, however many article elements and how much text it holds.
SPOKEN = frozenset("comment comments disqus replies reply responses".split())
#: What follows these in a name is said of the element, not its own name: has-sidebar, content-with-menu.
NEGATIONS = frozenset("has hide hides no non not show shows with without".split())
NEVER_LEFT_OUT = frozenset("html body main".split())
NEVER_ARTICLE = LEFT_OUT - {"form"} | {"footer", "header"}
#: Elements whose content is no markup, and those a page shows no text of.
TEXT_ONLY = RAW - frozenset("svg math object template".split())
SILENT = RAW | {"head", "select"}
STOPS = frozenset("article main body".split())

#: A tag without < in it. Nothing is matched twice: a tag that does not end fails once, at the next <.
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)>")
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
MARK = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)
SPLIT = re.compile(r"[^a-z0-9]+")
HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


class Link(str):
    """Text inside a link."""


class Node:
    """A block. items: its own texts and the blocks in it, in page order."""

    __slots__ = ("name", "items", "links", "chars", "tags", "link_chars", "link_tags", "density", "density_sum", "kept")

    def __init__(self, name: str):
        self.name, self.items, self.links = name, [], 0
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.density_sum = 0.0
        self.kept = False

    @property
    def nodes(self) -> list[Node]:
        return [x for x in self.items if isinstance(x, Node)]


class Tag:
    """start and end: its place in the page. closed: the number of the tag that ends the element, if one does."""

    __slots__ = ("start", "end", "name", "closing", "attributes", "closed")

    def __init__(self, start: int, end: int, name: str, closing: bool, attributes: str):
        self.start, self.end, self.name, self.closing, self.attributes, self.closed = start, end, name, closing, attributes, None


class Page:
    """A page's tags, found in one pass from its begin to its end; nothing is looked at again for each tag.

    Comments, declarations and elements without markup (scripts, say) are tags with an empty name. A tag that the
    page breaks off in is left out with all behind it.
    """

    def __init__(self, text: str):
        self.text, self.tags, self.plain = text, [], False
        at = search = 0
        while (lt := text.find("<", search)) >= 0:
            tag = self._tag(lt)
            search = lt + 1
            if tag is None:
                continue
            self.tags.append(tag)
            at = search = tag.end
        self.rest = at
        open_: dict[str, list[int]] = {}
        for i, tag in enumerate(self.tags):
            if tag.closing:
                if open_.get(tag.name):
                    self.tags[open_[tag.name].pop()].closed = i
            elif tag.name and tag.name not in VOID:
                open_.setdefault(tag.name, []).append(i)
        self.stops = [i for i, t in enumerate(self.tags) if t.name in STOPS or (t.closing and t.name == "html")]
        self.shown: tuple | None = None

    def _tag(self, lt: int) -> Tag | None:
        text, size = self.text, len(self.text)
        if text.startswith("<!--", lt):
            end = text.find("-->", lt + 4)
            return Tag(lt, end + 3 if end >= 0 else size, "", False, "")
        if text[lt + 1 : lt + 2] in ("!", "?"):
            end = text.find(">", lt)
            return Tag(lt, end + 1 if end >= 0 else size, "", False, "")
        found = TAG.match(text, lt)
        if found:
            closing, name, attributes, end = found[1], found[2], found[3], found.end()
        else:
            found = NAME.match(text, lt)
            if not found:
                return None
            end = self._end(found.end())
            if end < 0:
                return Tag(lt, size, "", False, "")
            closing, name, attributes = found[1], found[2], text[found.end() : end - 1]
        name = name.lower()
        if name in TEXT_ONLY and not closing:
            after = _CLOSERS.setdefault(name, re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*+>?", re.I)).search(text, end)
            return Tag(lt, after.end() if after else size, "", False, "")
        return Tag(lt, end, name, bool(closing), attributes)

    def _end(self, at: int) -> int:
        """Behind the > that ends a tag; one in a quoted value does not. If none does, any is taken, from then on for
        all tags of the page, so that the page is not read again and again."""
        text, start = self.text, at
        while not self.plain:
            found = MARK.search(text, at)
            if not found:
                self.plain = True
            elif found[0] == ">":
                return found.end()
            else:
                at = found.end()
                if text[max(at - 20, start) : at - 1].rstrip().endswith("="):
                    close = text.find(found[0], at)
                    if close < 0:
                        self.plain = True
                    else:
                        at = close + 1
        return text.find(">", start) + 1 or -1

    def element_end(self, i: int) -> tuple[int, bool]:
        """The number of the tag behind the element that tag i begins, and whether an end tag ends it. One that never
        ends goes no further than the begin or end of an article, main or body."""
        if self.tags[i].closed is not None:
            return self.tags[i].closed + 1, True
        at = bisect_left(self.stops, i + 1)
        return (self.stops[at] if at < len(self.stops) else len(self.tags)), False

    def _shown(self) -> tuple:
        """Numbers of the tags that begin articles and mains, and shown characters before each tag."""
        if self.shown is None:
            articles, mains, sums, hidden, last = [], [], [0], 0, 0
            for i, tag in enumerate(self.tags):
                text = self.text[last : tag.start] if i >= hidden else ""
                sums.append(sums[-1] + sum(map(len, text.split())))
                last = tag.end
                if tag.closing or i < hidden:
                    continue
                if tag.name in SILENT:
                    hidden = self.element_end(i)[0]
                elif tag.name == "main":
                    mains.append(i)
                elif tag.name == "article" and SPOKEN.isdisjoint(_named(tag.attributes)):
                    articles.append(i)
            sums.append(sums[-1] + sum(map(len, self.text[last:].split())))
            self.shown = articles, mains, sums
        return self.shown

    def wraps_article(self, i: int, end: int, spoken: bool) -> bool:
        """Whether an element to be left out by name, role or class holds the main element or all the articles; or,
        where the page marks none, most of its text (those whose own tag says that they are none do not count).
        What readers say counts only if the page has next to nothing else, and no article beside it."""
        articles, mains, sums = self._shown()
        inside = lambda places: bisect_left(places, end) - bisect_left(places, i)
        share = sums[min(end, len(sums) - 1)] - sums[i + 1]
        if inside(mains):
            return True
        if spoken:
            return 20 * share > 19 * sums[-1] and inside(articles) == len(articles)
        if mains or articles:
            return bool(articles) and inside(articles) == len(articles)
        return self.tags[i].name not in NEVER_ARTICLE and 2 * share > sums[-1]


_CLOSERS: dict[str, re.Pattern] = {}


def _named(attributes: str) -> set[str]:
    """The words of an element's class, id and role that say what it is: comment-list names list and comment,
    has-sidebar and content-with-menu no sidebar and no menu."""
    found: set[str] = set()
    if not attributes:
        return found
    for key, *values in ATTRIBUTE.findall(attributes):
        for name in entities.unescape("".join(values)).split():
            words = SPLIT.split(HUMP.sub("-", name).lower())
            if key.lower() == "role":
                found.update({"menu" if name.lower() in ROLES else ""})
                continue
            for n, word in enumerate(words):
                if word in NEGATIONS:
                    words = words[:n]
                    break
            found.update(words)
    return found


def _left_out(tag: Tag, names: set[str], inside_article: bool, inside_code: bool) -> bool:
    if tag.name in NEVER_LEFT_OUT:
        return False
    if tag.name in LEFT_OUT or (tag.name == "header" and not inside_article):
        return True
    if tag.attributes and HIDDEN.search(tag.attributes):
        return True
    if tag.name == "article":
        return not SPOKEN.isdisjoint(names)
    return not inside_code and (not NAMES.isdisjoint(names) or {"site", "header"} <= names)


def parse(text: str) -> Node:
    """The tree of what may be content. Unclosed and stray tags are mended as browsers do for
    paragraphs, lists and tables; a page that breaks off is closed at its end."""
    page, root = Page(text), Node("html")
    stack, at, number = [("html", root, False)], 0, 0  # name, the block around, inside a link; place, next tag
    open_: dict[str, list[int]] = defaultdict(list)  # by name, and for all scopes: places in the stack
    open_["*"].append(0)

    def close(i: int) -> None:
        for name, *_ in stack[i:]:
            open_[name].pop()
            if name in SCOPES:
                open_["*"].pop()
        del stack[i:]

    def push(name: str, node: Node, linked: bool) -> None:
        open_[name].append(len(stack))
        if name in SCOPES:
            open_["*"].append(len(stack))
        stack.append((name, node, linked))

    def end_implied(name: str) -> None:
        """End the innermost element that cannot hold one of this name, unless a scope is between."""
        places = [open_[x][-1] for x in ENDS.get(name, ()) if open_[x]]
        if places and max(places) >= open_["*"][-1]:
            close(max(places))

    while number <= len(page.tags):
        tag = page.tags[number] if number < len(page.tags) else None
        if part := text[at : tag.start if tag else len(text)]:
            _, node, linked = stack[-1]
            node.items.append(Link(part) if linked else part)
        if tag is None:
            break
        at, number = tag.end, number + 1
        name = tag.name
        if not name:
            continue
        if tag.closing:
            if open_[name] and (name in SCOPES or open_[name][-1] > open_["*"][-1]):  # else it ends nothing
                close(open_[name][-1])
            continue
        if name in ("html", "body"):
            if name == "body" and not open_["body"]:
                close(1)
                push("body", _child(root, "body"), False)
            continue
        end_implied(name)
        empty = tag.attributes.endswith("/")
        _, node, linked = stack[-1]
        names = _named(tag.attributes)
        if name in VOID:
            node.items.append(" ") if name != "hr" else _child(node, name)
        elif _left_out(tag, names, bool(open_["article"] or open_["main"]), bool(open_["pre"] or open_["code"])):
            if empty and name not in RAW:
                continue
            end, whole = page.element_end(number - 1)
            may_wrap = whole and name not in RAW and not HIDDEN.search(tag.attributes)
            if may_wrap and page.wraps_article(number - 1, end, not SPOKEN.isdisjoint(names)):
                push(name, _child(node, name) if name in BLOCK else node, linked)
            else:
                number = end
                at = page.tags[end - 1].end if whole else page.tags[end].start if end < len(page.tags) else len(text)
        elif name in BLOCK:
            push(name, _child(node, name), linked)
        else:
            node.links += name == "a"
            if not empty:
                push(name, node, linked or name == "a")
    return root


def _child(parent: Node, name: str) -> Node:
    node = Node(name)
    parent.items.append(node)
    return node


def _squeezed(text: str) -> str:
    return " ".join(entities.unescape(text).split())


def _density(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Characters per tag, weighed by the characters and tags per those of links. share: that of
    links among the body's characters, which sets how hard a link-heavy block is marked down."""
    if not chars:
        return 0.0
    t, lc, lt = max(tags, 1), max(link_chars, 1), max(link_tags, 1)
    base = math.log(chars * lc / max(chars - link_chars, 1) + share * chars + math.e)
    return chars / t * max(math.log(chars / lc * (t / lt)) / base, 0.0)


def measure(root: Node) -> None:
    """Densities, bottom up without recursion, so that depth is no limit."""
    order = _below(root)
    own: dict[Node, tuple[int, int]] = {}
    for node in reversed(order):
        texts = [(len(_squeezed(x)), isinstance(x, Link)) for x in node.items if isinstance(x, str)]
        own[node] = sum(n for n, _ in texts), sum(n for n, linked in texts if linked)
        kids = node.nodes
        node.chars = own[node][0] + sum(k.chars for k in kids)
        node.link_chars = own[node][1] + sum(k.link_chars for k in kids)
        node.tags = node.links + sum(k.tags + 1 for k in kids)
        node.link_tags = node.links + sum(k.link_tags for k in kids)
    body = next((n for n in order if n.name == "body"), root)
    share = body.link_chars / max(body.chars, 1)
    for node in reversed(order):
        node.density = _density(node.chars, node.tags, node.link_chars, node.link_tags, share)
        itself = _density(own[node][0], node.links, own[node][1], node.links, share)
        node.density_sum = itself + sum(k.density for k in node.nodes)


def _mark(root: Node) -> None:
    measure(root)
    order, parents, todo = [], {}, [root]
    while todo:  # page order
        node = todo.pop()
        order.append(node)
        for k in node.nodes:
            parents[k] = node
        todo.extend(reversed(node.nodes))
    body = next((n for n in order if n.name == "body"), root)
    core = max(_below(body), key=lambda n: n.density_sum)
    least, node = core.density, core
    while node is not body and node in parents:
        node = parents[node]
        least = min(least, node.density)
    best: dict[Node, Node] = {}
    for node in reversed(order):
        top = node
        for k in node.nodes:
            if best[k].density_sum > top.density_sum:
                top = best[k]
        best[node] = top
    todo = [body]
    while todo:
        node = todo.pop()
        if node.density >= least and node.chars:
            best[node].kept = True
        todo.extend(node.nodes)


def _below(top: Node) -> list[Node]:
    out, todo = [], [top]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(reversed(node.nodes))
    return out


def main_text(page: str | None) -> str:
    """The article's blocks in page order, one per line; empty if there is none."""
    if not page:
        return ""
    root = parse(page)
    _mark(root)
    blocks: list[str] = []
    run: list[str] = []

    def end() -> None:
        if text := _squeezed("".join(run)):
            blocks.append(text)
        run.clear()

    todo: list = [(root, False)]
    while todo:
        item, kept = todo.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            if kept:
                run.append(item)
        else:
            kept = kept or item.kept
            end()
            todo.append((None, False))
            todo.extend((x, kept) for x in reversed(item.items))
    end()
    return "\n".join(blocks)


def main_text_of(html: Column) -> Column:
    @F.pandas_udf("string")
    def many(pages: pd.Series) -> pd.Series:
        return pages.map(main_text)

    return many(html)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    A null or empty page, or one without text, has an empty text. Ids and urls are passed on as they
    are, null or repeated. An empty table gives an empty result. Columns not named are not read.
    """
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), main_text_of(text_of(html_col)).alias("text"))
    return own.withColumn("n_chars", F.length("text").cast("long"))
