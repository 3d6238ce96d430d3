"""Main text of web pages by wrapper induction.

Pages of a host are made by the same programs. Each page is a DOM tree with equal siblings folded into one repeated node.
The trees that occur on a host are grouped by simple tree matching into layouts, the most frequent tree of each being its
leader; a tree belongs to the first leader that it is much like. A text that stands at the same node of the leader on nearly
all pages of a layout whose texts differ is part of the template, and so is one on nearly all pages of the host, aligned
with the most frequent tree of all. What varies is content. The tree's own marks (navigation, adverts, forms, comments and
the like) tell which of the varying slots are no article.

Trees are counted over all pages before they are compared, and texts as hashes at aligned nodes; only the leaders and the
constant texts, one row per host, meet the pages again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martwright.llm.ship import lean, lean_group, shipped
from martwright.llm.store import stored

#: A text is constant if this share of the distinct pages of a layout, or of the host, has it at the same node.
CONSTANT_SHARE = 0.9
#: So many distinct pages induce a wrapper ...
LEAST_PAGES = 2
#: ... but with fewer than these, pages that share most of their texts are taken for versions of one page, and what
#: article marks hold is no template.
SURE_PAGES = 5
VERSION_SHARE = 2 / 3
#: The article's holder is looked for from the root down: an element that holds this share of the varying text of its
#: parent, over all pages of the layout, is gone into.
HELD = 0.75
#: Distinct trees of a host that meet in one task, about; a host with more has them dealt over several. That is done again
#: with the leaders found as long as this share of them is left at most.
SHAPES = 2000
MOST_LEFT = 0.9
#: Trees are of one layout if this share of their nodes is aligned.
ALIKE = 0.75

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template annotation annotation-xml".split())
_SKIPPED = frozenset(
    "head script style title noscript iframe template canvas object audio video select option datalist button"
    " textarea nav footer aside input".split()
)
#: Skipped too, but not in an article.
_SKIPPED_OUTSIDE = frozenset("header svg menu label".split())
#: Tags that are evidence as words in class, id and role are: a form may well hold the whole page.
_MARKED = frozenset("form fieldset dialog".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rt rp s samp small span strike"
    " strong sub sup time tt u var wbr img br math mi mn mo ms mtext mspace mrow msup msub msubsup mfrac msqrt mroot mover"
    " munder munderover mstyle mpadded semantics".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr main menu nav ol p pre section table ul".split()
)
_KNOWN = (_VOID | _RAW | _SKIPPED | _SKIPPED_OUTSIDE | _MARKED | _CLOSES_P) | frozenset(
    "html body li dt dd tr td th thead tbody tfoot caption legend summary math figcaption".split()
)
#: Elements that an element of the same group ends, up to the nearest of the others.
_SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
#: Words in class, id and role that mark what is no article.
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsored sponsor promo promotion cookie cookies consent gdpr"
    " notice alert popup modal overlay sidebar side menu nav navbar navigation breadcrumb breadcrumbs header masthead"
    " footer comment comments commentlist disqus reply replies respond share sharing social related recommended"
    " newsletter subscribe subscription signup login search widget toolbar pagination pager copyright".split()
)
_COMMENTS = frozenset("comment comments commentlist disqus reply replies respond".split())
#: The marks that count in class and role of an article's own parts, unless they are one of _TEXTS. Ids there are anchors.
_MARKS_INSIDE = _COMMENTS | frozenset(
    "ad ads advert adverts advertisement advertising sponsored sponsor promo promotion gdpr sidebar nav navbar navigation"
    " breadcrumb breadcrumbs share sharing social recommended newsletter subscribe subscription signup toolbar pagination"
    " pager".split()
)
_TEXTS = frozenset(
    "p h1 h2 h3 h4 h5 h6 hgroup header blockquote pre figure figcaption table caption thead tbody tfoot tr td th dl dt dd li"
    " address".split()
)
#: Words that make a name tell how the page is, not what the element is: with-sidebar, comments-open.
_STATES = frozenset("no not with without has have is layout open opened closed enabled disabled status on off".split())
#: A marked element with more than this share of the varying text is no menu or advert, and one with so much no comments.
MOST = 0.5
MOST_COMMENTS = 0.9
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|([^<]+|<)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in _RAW}
_WORD = re.compile(r"[a-z]+")
#: Elements that hold parts of a page of any kind. Those that differ in what they hold are told apart when equal siblings
#: are folded: only links, only a text of its own, or other elements.
_HOLDERS = frozenset("div section article main center form nav header footer aside custom".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup header".split())


@dataclass
class Block:
    text: str
    node: int
    skipped: bool
    main: bool
    linked: bool
    #: Number of the innermost marked element around it, or -1.
    marked: int = -1


@dataclass
class Marked:
    """An element whose marks are evidence that it is no article."""

    comments: bool
    inside: bool
    #: The next marked element around it, or -1.
    around: int = -1
    has_article: bool = False
    has_main: bool = False


@dataclass
class Page:
    """The folded tree (parent and label of each node, parents first) and the blocks of text in page order."""

    parents: list[int] = field(default_factory=lambda: [-1])
    labels: list[str] = field(default_factory=lambda: ["#"])
    blocks: list[Block] = field(default_factory=list)
    marked: list[Marked] = field(default_factory=list)

    def marks_around(self, block: Block) -> Iterator[int]:
        """Numbers of the marked elements around a block, innermost first."""
        i = block.marked
        while i >= 0:
            yield i
            i = self.marked[i].around


def _marks(attributes: str) -> tuple[set[str], set[str], set[str]]:
    """Marks in class, id and role: all, those that tell what the element is, and of these the ones not from the id."""
    marks: set[str] = set()
    own: set[str] = set()
    styled: set[str] = set()
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        for token in (a or b or c).lower().split():
            words = _WORD.findall(token)
            found = _MARKS.intersection(words)
            marks |= found
            if found and not _STATES.intersection(words):
                own |= found
                if name.lower() != "id":
                    styled |= found
                elif found <= _COMMENTS and len(words) <= 2:
                    styled |= found
    return marks, own, styled


def _fold(page: Page, parents: list[int], labels: list[str]) -> None:
    """The page's tree from its elements (parents first): equal siblings are one node."""
    n = len(parents)
    texts, links, holds = [0] * n, [0] * n, [False] * n
    for block in page.blocks:
        texts[block.node] += 1
        links[block.node] += block.linked
    for node in range(n - 1, 0, -1):
        parent = parents[node]
        texts[parent] += texts[node]
        links[parent] += links[node]
        holds[parent] = True
    folded: dict[tuple[int, str], int] = {}
    place = [0] * n
    for node in range(1, n):
        label = labels[node]
        if label.partition(".")[0] in _HOLDERS and texts[node]:
            label += "~links" if links[node] == texts[node] else "" if holds[node] else "~text"
        key = place[parents[node]], label
        place[node] = folded.setdefault(key, len(page.labels))
        if place[node] == len(page.labels):
            page.labels.append(label)
            page.parents.append(key[0])
    for block in page.blocks:
        block.node = place[block.node]


def parse(html: str) -> Page:
    page = Page()
    parents, labels = [-1], ["#"]
    # open elements: tag, element, inside something skipped, inside the article, inside a link, innermost marked element
    stack: list[tuple[str, int, bool, bool, bool, int]] = [("#", 0, False, False, False, -1)]
    pieces: list[str] = []
    linked = True
    at: tuple[int, bool, bool] = (0, False, False)
    around: int | None = None

    def flush() -> None:
        nonlocal linked, around
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                page.blocks.append(Block(text, at[0], at[1], at[2], linked, -1 if around is None else around))
            pieces.clear()
        linked = True
        around = None

    def shared(a: int, b: int) -> int:
        """The innermost marked element around both."""
        while a != b:
            if a < b:  # numbers grow inwards
                a, b = b, a
            a = page.marked[a].around
        return a

    def push(tag: str, marks: set[str], own: set[str], styled: set[str]) -> None:
        _, node, skipped, main, link, marked = stack[-1]
        if tag not in _INLINE:
            parents.append(node)
            labels.append(".".join([tag if tag in _KNOWN else "custom", *sorted(marks)]))
            node = len(parents) - 1
        skipped = skipped or tag in _SKIPPED or (tag in _SKIPPED_OUTSIDE and not main)
        if main:
            evidence = set() if tag in _TEXTS else styled & _MARKS_INSIDE
        else:
            evidence = set() if tag in ("html", "body", "main", "article") else own
        if evidence or tag in _MARKED:
            page.marked.append(Marked(bool(evidence & _COMMENTS), main, marked))
            marked = len(page.marked) - 1
        # a comment that is an article by its tag is not the page's article, nor skipped where nothing else is one
        if tag == "main" or tag == "article" and not own & _COMMENTS:
            i = marked
            while i >= 0 and not (page.marked[i].has_article and (page.marked[i].has_main or tag != "main")):
                page.marked[i].has_article = True
                page.marked[i].has_main |= tag == "main"
                i = page.marked[i].around
            main = True
        stack.append((tag, node, skipped, main, link or tag == "a", marked))

    def pop_to(depth: int) -> None:
        if any(entry[0] not in _INLINE for entry in stack[depth:]):
            flush()
        del stack[depth:]

    position = 0
    while position < len(html):
        match = _TOKEN.match(html, position)
        if match is None:
            pieces.append(html[position])
            position += 1
            continue
        position = match.end()
        closing, tag, attributes, text = match.groups()
        if text is not None:
            top = stack[-1]
            if not pieces:
                at = (top[1], top[2], top[3])
            if not text.isspace():
                if not top[4]:
                    linked = False
                # an inline element does not mark the whole block
                around = top[5] if around is None else shared(around, top[5])
            pieces.append(text)
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    pop_to(depth)
                    break
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            continue
        if tag in _CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == "p":
                    pop_to(depth)
                    break
                if stack[depth][0] in _CLOSES_P and stack[depth][0] != "p":
                    break
        elif tag in _SIBLINGS:
            ended, borders = _SIBLINGS[tag]
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in borders:
                    break
                if stack[depth][0] in ended:
                    pop_to(depth)
                    break
        if tag in _RAW:  # no part of any block, and its end tag then closes nothing
            close = _RAW_ENDS[tag].search(html, position)
            position = close.start() if close else len(html)
            continue
        if tag not in _INLINE:
            flush()
        push(tag, *(_marks(attributes) if attributes and "=" in attributes else (set(), set(), set())))
    flush()
    _fold(page, parents, labels)
    return page


def match_trees(left: Page, right: Page) -> list[int]:
    """Simple tree matching: for each node of ``left`` the node of ``right`` that it is aligned with, or -1."""
    a_children, b_children = _children(left.parents), _children(right.parents)
    #: Of pairs of nodes with one label: the size of their best matching, and the pairs of children in it.
    done: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}
    waiting = [(0, 0)] if left.labels[0] == right.labels[0] else []
    while waiting:
        a, b = waiting[-1]
        xs, ys = a_children[a], b_children[b]
        below = [(x, y) for x in xs for y in ys if left.labels[x] == right.labels[y] and (x, y) not in done]
        if below and (a, b) not in done:
            waiting += below
            continue
        waiting.pop()
        if (a, b) in done:
            continue
        weight = [[done[x, y][0] if (x, y) in done else 0 for y in ys] for x in xs]
        best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i in range(len(xs)):
            for j in range(len(ys)):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + weight[i][j])
        pairs, i, j = [], len(xs), len(ys)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((xs[i], ys[j]))
        done[a, b] = 1 + best[len(xs)][len(ys)], pairs
    found = [-1] * len(left.labels)
    agreed = [(0, 0)] if (0, 0) in done else []
    while agreed:
        a, b = agreed.pop()
        found[a] = b
        agreed += done[a, b][1]
    return found


def _children(parents: list[int]) -> list[list[int]]:
    children: list[list[int]] = [[] for _ in parents]
    for node, parent in enumerate(parents):
        if parent >= 0:
            children[parent].append(node)
    return children


def alike(nodes: list[int], other: int) -> float:
    """Share of the nodes of two trees that are aligned; ``other`` is the second tree's number of nodes."""
    return 2 * sum(n >= 0 for n in nodes) / (len(nodes) + other)


def written_tree(page: Page) -> str:
    return json.dumps([page.parents, page.labels], separators=(",", ":"))


def read_tree(tree: str) -> Page:
    return Page(*json.loads(tree))


def digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def first_alike(page: Page, leaders: list[Page]) -> tuple[int, list[int]]:
    """The first of ``leaders`` that the tree of ``page`` is much like and its alignment, or -1."""
    size = len(page.labels)
    for i, leader in enumerate(leaders):
        other = len(leader.labels)
        if 2 * min(size, other) >= ALIKE * (size + other):
            nodes = match_trees(page, leader)
            if alike(nodes, other) >= ALIKE:
                return i, nodes
    return -1, []


def _tag(label: str) -> str:
    return re.split(r"[.~]", label, maxsplit=1)[0]


def content_slots(tree: Page, mass: dict[int, int]) -> set[int]:
    """The nodes of a layout that hold its content, from the characters that vary at each node over all pages.

    Beside an element that holds most of what varies, other slots (adverts, footers, teasers) vary little or are short on
    every page. So the holder is the deepest element on the way of ``HELD`` from the root; it and all in it are content,
    and so are the headings beside an element on that way. Nothing varies: no node.
    """
    children = _children(tree.parents)
    total = [mass.get(node, 0) for node in range(len(tree.labels))]
    for node in range(len(total) - 1, 0, -1):  # parents come first
        total[tree.parents[node]] += total[node]
    if not total[0]:
        return set()
    at, found = 0, set()
    while True:
        below = [c for c in children[at] if _tag(tree.labels[c]) in _HOLDERS or _tag(tree.labels[c]) in ("html", "body")]
        best = max(below, key=lambda c: total[c], default=0)
        if not best or total[best] < HELD * total[at]:
            break
        found |= {c for c in children[at] if c != best and _tag(tree.labels[c]) in _HEADINGS}
        at = best
    inside = [False] * len(total)
    for node in range(len(total)):
        inside[node] = node == at or node in found or (node > 0 and inside[tree.parents[node]])
    return {node for node in range(len(total)) if inside[node]}


class Wrapper:
    """What is known of a host: the leaders of its layouts, the constant texts at their nodes, and the nodes with content."""

    def __init__(self, written: str) -> None:
        groups = sorted(json.loads(written), key=lambda g: g["layout"])
        self.groups = [(g["pages"], set(zip(g.get("nodes") or (), g.get("texts") or (), strict=True))) for g in groups]
        self.leaders = [read_tree(g["tree"]) for g in groups]
        masses = [dict(zip(g.get("slots") or (), g.get("masses") or (), strict=True)) for g in groups]
        self.content = [content_slots(tree, mass) for tree, mass in zip(self.leaders, masses, strict=True)]
        #: The first group is that of all pages.
        self.whole = bool(groups) and groups[0]["layout"] < 0
        self.known: dict[tuple, list[tuple[int, list[int]]]] = {}

    def alignments(self, page: Page) -> list[tuple[int, list[int]]]:
        """The groups that the page belongs to, with the leader's node for each of its own."""
        shape = (tuple(page.parents), tuple(page.labels))
        found = self.known.get(shape)
        if found is None:
            if len(self.known) >= 500:
                self.known.clear()
            found = self.known[shape] = [(0, match_trees(page, self.leaders[0]))] if self.whole else []
            i, nodes = first_alike(page, self.leaders[self.whole :])
            if i >= 0:
                found.append((i + self.whole, nodes))
        return found

    def entries_of(self, page: Page) -> list[int]:
        """For each block 0 if it is part of the template, or -1."""
        entries = [-1] * len(page.blocks)
        for group, nodes in self.alignments(page):
            pages, constant = self.groups[group]
            slots = {node for node, _ in constant}
            at = [
                i
                for i, b in enumerate(page.blocks)
                if not b.skipped and nodes[b.node] in slots and (nodes[b.node], digest(b.text)) in constant
            ]
            if pages < SURE_PAGES:
                own = [b for b in page.blocks if not b.skipped]
                same = sum(len(page.blocks[i].text) for i in at)
                if len(at) > VERSION_SHARE * len(own) and same > VERSION_SHARE * sum(len(b.text) for b in own):
                    continue
                at = [i for i in at if not page.blocks[i].main]
            for i in at:
                entries[i] = 0
        return entries


    def content_of(self, page: Page) -> list[bool] | None:
        """For each block whether it is in the content of the page's layout; None if no layout tells.

        A node that the leader lacks is content if its parent is.
        """
        for group, nodes in reversed(self.alignments(page)):
            content = self.content[group]
            if content:
                inside = [False] * len(nodes)
                for node, aligned in enumerate(nodes):
                    inside[node] = aligned in content if aligned >= 0 else node > 0 and inside[page.parents[node]]
                return [inside[b.node] for b in page.blocks]
        return None


_MOST_WRAPPERS = 200


def _wrapper(cache: dict[str, Wrapper], written: str) -> Wrapper:
    if written not in cache:
        if len(cache) >= _MOST_WRAPPERS:
            cache.clear()
        cache[written] = Wrapper(written)
    return cache[written]


def judged(page: Page, varying: list[Block]) -> tuple[list[Block], set[int]]:
    """The blocks of ``varying`` that are in nothing marked, and the marked elements around the article.

    Marks are no evidence against an element that holds the article's tag, where no other has it, or most of the text.
    """
    if not page.marked:
        return varying, set()
    weight = [0] * len(page.marked)
    whole = article = 0
    plain = False
    for b in varying:
        if b.main or not b.linked:
            size = len(b.text)
            whole += size
            article += size if b.main else 0
            plain = plain or b.main and all(page.marked[i].inside for i in page.marks_around(b))
            if b.marked >= 0:
                weight[b.marked] += size
    for i in range(len(page.marked) - 1, -1, -1):  # numbers grow inwards
        if page.marked[i].around >= 0:
            weight[page.marked[i].around] += weight[i]
    kept, around = set(), set()
    for i, element in enumerate(page.marked):
        share = weight[i] / ((article if element.inside else whole) or 1)
        most = share >= MOST_COMMENTS if element.comments else share > MOST
        if element.has_main and not element.inside or most and (element.inside or not plain):
            kept.add(i)
            around.add(i)
        elif element.has_article and not (element.inside or plain or element.comments):
            kept.add(i)  # maybe teasers beside an article without a tag: its own tags do not rule out the rest
    return [b for b in varying if kept.issuperset(page.marks_around(b))], around


def main_text(page: Page, entries: list[int], constant: set[int], content: list[bool] | None = None) -> str:
    """The varying blocks in the layout's content, without what marks tell is no part of the article.

    Where the layout says nothing, or the page marks an article outside of what the layout holds for content, the marks
    decide on the whole page.
    """
    blocks = [b for b, entry in zip(page.blocks, entries, strict=True) if not b.skipped and entry not in constant]
    if content is not None:
        held = {id(b) for b, inside in zip(page.blocks, content, strict=True) if inside}
        inner = [b for b in blocks if id(b) in held]
        if any(b.main for b in inner) or inner and not any(b.main for b in blocks):
            blocks = inner
    blocks, around = judged(page, blocks)
    main = [b for b in blocks if b.main and around.issuperset(i for i in page.marks_around(b) if not page.marked[i].inside)]
    if main or any(b.main and not b.skipped and b.marked < 0 for b in page.blocks):
        blocks = main
    else:
        blocks = [b for b in blocks if not b.linked or b.main]
    return "\n".join(b.text for b in blocks)


def host(url: Column) -> Column:
    """Host part of a URL, lower-cased; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


_SEEN = pa.schema(
    [
        pa.field("host", pa.string()),
        pa.field("shape", pa.int64()),
        pa.field("tree", pa.string()),
        pa.field("content", pa.int64()),
        pa.field("nodes", pa.list_(pa.int32())),
        pa.field("texts", pa.list_(pa.int64())),
        pa.field("sizes", pa.list_(pa.int64())),
    ]
)
_MOST_SHAPES = 100_000


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each page the host, hashes of its tree, of all its texts and of each at its node, with the characters there that
    are neither links nor readers' comments; a tree once for a host and task."""
    sent: set[tuple[str, int]] = set()
    for batch in batches:
        rows = []
        for name, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = parse(html)
            blocks = [b for b in page.blocks if not b.skipped]
            tree = written_tree(page)
            shape = digest(tree)
            sizes: dict[tuple[int, int], int] = {}
            for b in blocks:
                comment = any(page.marked[i].comments for i in page.marks_around(b))
                key = b.node, digest(b.text)
                sizes[key] = sizes.get(key, 0) + (0 if b.linked or comment else len(b.text))
            entries = sorted(sizes)
            rows.append(
                {
                    "host": name,
                    "shape": shape,
                    "tree": None if (name, shape) in sent else tree,
                    "content": digest("\n".join(b.text for b in judged(page, blocks)[0])),
                    "nodes": [n for n, _ in entries],
                    "texts": [t for _, t in entries],
                    "sizes": [sizes[e] for e in entries],
                }
            )
            if len(sent) >= _MOST_SHAPES:
                sent.clear()
            sent.add((name, shape))
        yield pa.RecordBatch.from_pylist(rows, schema=_SEEN)


_LAYOUT = pa.schema(
    [
        pa.field("host", pa.string()),
        pa.field("shape", pa.int64()),
        pa.field("layout", pa.int32()),
        pa.field("tree", pa.string()),
        pa.field("aligned", pa.list_(pa.int32())),
    ]
)


_LEADER = pa.schema([pa.field("host", pa.string()), pa.field("shape", pa.int64()), pa.field("n", pa.int64()), pa.field("tree", pa.string())])


def _by_frequency(table: pa.Table) -> list[dict]:
    return sorted(table.select(["shape", "n", "tree"]).to_pylist(), key=lambda r: (-r["n"], r["shape"]))


def _leaders(table: pa.Table) -> pa.Table:
    """Of some trees of a host those that are like none that is more frequent."""
    leaders: list[Page] = []
    out = []
    for row in _by_frequency(table):
        page = read_tree(row["tree"])
        if first_alike(page, leaders)[0] < 0:
            leaders.append(page)
            out.append({"host": table.column("host")[0].as_py(), **row})
    return pa.Table.from_pylist(out, schema=_LEADER)


def _assigned(trees: pa.Table, leaders: pa.Table) -> pa.Table:
    """The groups of some trees of a host, given all its leaders: all trees (-1) and, if there are several, the layouts.

    ``tree`` is a group's leader, in the leader's row.
    """
    if not trees.num_rows:
        return _LAYOUT.empty_table()
    name, known = trees.column("host")[0].as_py(), _by_frequency(leaders)
    pages = [read_tree(r["tree"]) for r in known]
    out = []
    for r in trees.select(["shape", "tree"]).to_pylist():
        page = read_tree(r["tree"])
        row = {"host": name, "shape": r["shape"]}
        layout, nodes = first_alike(page, pages)
        whole = nodes if layout == 0 else match_trees(page, pages[0])
        out.append(row | {"layout": -1, "tree": r["tree"] if r["shape"] == known[0]["shape"] else None, "aligned": whole})
        if len(pages) > 1 and layout >= 0:
            out.append(row | {"layout": layout, "tree": r["tree"] if r["shape"] == known[layout]["shape"] else None, "aligned": nodes})
    return pa.Table.from_pylist(out, schema=_LAYOUT)


def _salted(trees: DataFrame) -> DataFrame:
    """Trees of a host dealt into as many groups as it needs for ``SHAPES`` in each, about: (host, salt, salts, ...)."""
    salts = trees.groupBy("host").agg(F.ceil(F.count("*") / SHAPES).cast("int").alias("salts"))
    return trees.join(salts, "host").withColumn("salt", F.pmod(F.xxhash64("shape"), F.col("salts")).cast("int"))


def layouts_of(trees: DataFrame) -> DataFrame:
    """(host, shape, layout, tree, aligned) of the trees (host, shape, n, tree), n being the pages of a tree.

    Leaders are looked for in groups of bounded size, then among the leaders found, until each host has one group or
    its leaders are no fewer than before; then each tree is compared with its host's leaders, in groups again.
    """
    found = trees
    while True:
        count, most = found.groupBy("host").count().agg(F.sum("count"), F.max("count")).first()
        done = not most or most <= SHAPES
        dealt = found.withColumn("salt", F.lit(0)) if done else _salted(found).drop("salts")
        leaders = dealt.groupBy("host", "salt").applyInArrow(lean_group(_leaders), "host string, shape long, n long, tree string")
        found = stored(leaders)
        if done:
            break
        if found.count() > MOST_LEFT * count:  # nearly every tree is a layout of its own
            found = stored(found.groupBy("host").applyInArrow(lean_group(_leaders), "host string, shape long, n long, tree string"))
            break
    own = _salted(trees)
    sent = found.join(own.groupBy("host").agg(F.max("salts").alias("salts")), "host")
    sent = sent.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    return (
        own.drop("salts")
        .groupBy("host", "salt")
        .cogroup(sent.groupBy("host", "salt"))
        .applyInArrow(lean_group(_assigned), "host string, shape long, layout int, tree string, aligned array<int>")
    )


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache: dict[str, Wrapper] = {}
    for batch in batches:
        texts = []
        for html, written in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist(), strict=True):
            page = parse(html)
            wrapper = _wrapper(cache, written) if written else None
            entries = wrapper.entries_of(page) if wrapper else [-1] * len(page.blocks)
            texts.append(main_text(page, entries, {0}, wrapper.content_of(page) if wrapper else None))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for every row of ``pages`` (page_id, url, html).

    ``text`` has the article's blocks in page order, joined by a line end; it is empty if there is none or html is null.
    Pages without a host in their url are one host. Repeated rows and null ids stay, other columns are dropped; pages
    with equal texts count once for a host's template.
    """
    rows = pages.select(
        "page_id", "url", host(F.col("url")).alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    )
    shipped(rows)
    seen = rows.select("host", "html").mapInArrow(
        lean(_seen),
        "host string, shape long, tree string, content long, nodes array<int>, texts array<long>, sizes array<long>",
    )
    seen = stored(seen)
    distinct = seen.groupBy("host", "content").agg(F.min(F.struct("shape", "nodes", "texts", "sizes")).alias("page"))
    distinct = stored(distinct.select("host", "page.*"))
    trees = seen.where(F.col("tree").isNotNull()).groupBy("host", "shape").agg(F.max("tree").alias("tree"))
    shapes = distinct.groupBy("host", "shape").agg(F.count("*").alias("n")).join(trees, ["host", "shape"])
    layouts = stored(layouts_of(stored(shapes.select("host", "shape", "n", "tree"))))
    leaders = layouts.where(F.col("tree").isNotNull()).select("host", "layout", "tree")
    members = distinct.join(layouts.drop("tree"), ["host", "shape"])
    group = ["host", "layout"]
    sizes = members.groupBy(*group).agg(F.count("*").alias("pages")).where(F.col("pages") >= LEAST_PAGES)
    groups = stored(leaders.join(sizes, group))
    nodes = F.transform("nodes", lambda n: F.element_at("aligned", n + 1))
    at = F.arrays_zip(nodes.alias("node"), F.col("texts").alias("text"), F.col("sizes").alias("size"))
    entries = members.select(*group, F.explode(at).alias("entry")).select(*group, "entry.*").where(F.col("node") >= 0)
    counts = (
        entries.groupBy(*group, "node", "text")
        .agg(F.count("*").alias("n"), F.sum("size").alias("size"))
        .where(F.col("n") >= LEAST_PAGES)
    )
    constant = stored(counts.join(groups.drop("tree"), group).where(F.col("n") >= CONSTANT_SHARE * F.col("pages")))
    texts = (
        constant.groupBy(*group)
        .agg(F.array_sort(F.collect_list(F.struct("node", "text"))).alias("constant"))
        .select(*group, F.col("constant.node").alias("nodes"), F.col("constant.text").alias("texts"))
    )
    # characters that vary: all at a node but those of its constant texts
    sums = entries.select(*group, "node", "size").union(constant.select(*group, "node", (-F.col("size")).alias("size")))
    varying = (
        sums.groupBy(*group, "node")
        .agg(F.sum("size").alias("mass"))
        .where("mass > 0")
        .groupBy(*group)
        .agg(F.array_sort(F.collect_list(F.struct("node", "mass"))).alias("slots"))
        .select(*group, F.col("slots.node").alias("slots"), F.col("slots.mass").alias("masses"))
    )
    about = groups.join(texts, group, "left").join(varying, group, "left")
    parts = F.struct("layout", "pages", "tree", "nodes", "texts", "slots", "masses")
    wrappers = stored(about.groupBy("host").agg(F.to_json(F.array_sort(F.collect_list(parts))).alias("wrapper")))
    kinds = {name: pages.schema[name].dataType.simpleString() for name in ("page_id", "url")}
    return (
        rows.join(wrappers, "host", "left")
        .select("page_id", "url", "html", "wrapper")
        .mapInArrow(lean(_extracted), f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    )
