"""Web pages as block texts in a skeleton tree, and simple tree matching of skeletons.

A skeleton has the block elements of a page.  Neighbouring siblings with the same
label are one node, so a list or a run of paragraphs is one slot however long it is.
"""

from __future__ import annotations

import html
import re

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|[^>])*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(?i)\b(class|id|role|itemprop|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes", "template", "svg", "math"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = set(
    "html head body article aside nav section header footer main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption"
    " thead tbody tfoot tr td th blockquote pre form fieldset figure figcaption address details summary dialog menu hr"
    " option select button center hgroup search".split()
)
# What a start tag closes on its own, up to the element that bounds the search.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

_DROPPED_TAGS = {"nav", "footer", "aside", "header", "form", "button", "select", "option", "dialog", "menu", "head", "search"}
_DROPPED_WORDS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr"
    " notice notices alert popup modal overlay sidebar side menu nav navbar navigation breadcrumb breadcrumbs footer header"
    " masthead comment comments disqus respond reply replies share sharing social related recommended newsletter subscribe"
    " subscription login signup search widget toolbar pagination pager skip hidden".split()
)
# Names of an advert within a line, or of its box, and of what is not shown.
_INLINE = re.compile(
    r"(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?)"
    r"(?:[-_:](?:0|banner|block|box|container|label|slot|unit|wrap|wrapper))*|hidden"
)
_DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu"}
_MAIN_WORDS = {"article-body", "articlebody", "article-content", "post-content", "entry-content", "post-body", "main-content", "story-body"}


class Node:
    __slots__ = ("label", "children", "cursor", "number")

    def __init__(self, label: str):
        self.label, self.children, self.cursor, self.number = label, [], -1, -1

    def enter(self, label: str) -> Node:
        """The child for the next element with this label: that of its run, or a new one."""
        children, at = self.children, self.cursor
        if not (at >= 0 and children[at].label == label):
            at = next((k for k in range(at + 1, len(children)) if children[k].label == label), -1)
            if at < 0:
                at = self.cursor + 1
                children.insert(at, Node(label))
        self.cursor = at
        children[at].cursor = -1
        return children[at]


def _label(tag: str, attributes: str) -> str:
    """Tag, role and the words of class and id; digits count as one and the same."""
    marks = set()
    if attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            value = "".join(values).lower()
            if name.lower() == "hidden":
                marks.add(".hidden")
            elif name.lower() == "role":
                marks.add("@" + value)
            else:
                marks.update("." + re.sub(r"\d+", "0", w) for w in value.split())
    return re.sub(r"[()\s]", "", tag + "".join(sorted(marks)))


def _marks(label: str) -> tuple[str, list[str], list[str]]:
    tag, *marks = re.split(r"(?=[.@])", label)
    return tag, [m[1:] for m in marks if m[0] == "."], [m[1:] for m in marks if m[0] == "@"]


def is_dropped(label: str) -> bool:
    """Whether an element is a menu, header, footer, sidebar, notice, advert, form or comment."""
    tag, words, roles = _marks(label)
    if tag in _DROPPED_TAGS or any(r in _DROPPED_ROLES for r in roles):
        return True
    return any(part in _DROPPED_WORDS for word in words for part in re.split(r"[-_:]+", word))


def is_named(label: str) -> bool:
    """Whether a whole word of class or id, but for its number, says that an element is no article."""
    return any(re.sub(r"[-_:]*0$", "", word) in _DROPPED_WORDS for word in _marks(label)[1])


# Names of reader comments, one or all of them; "comments-open" and the like are none.
_COMMENT = re.compile(
    r"(?:user[-_]?|reader[-_]?|post[-_]?)?(?:comments?|repl(?:y|ies)|responses)"
    r"(?:[-_:]?(?:0|area|block|body|box|container|content|entry|item|list|section|text|thread|wrap|wrapper))*[-_:]?0?"
)


def is_comment(label: str) -> bool:
    """Whether a class or id names a reader comment or a block of them."""
    tag, words, _ = _marks(label)
    return tag != "body" and any(_COMMENT.fullmatch(word) for word in words)


def is_inline_advert(label: str) -> bool:
    """Whether an element within a line is an advert or hidden by its name; any other is text of its line."""
    return any(_INLINE.fullmatch(word) for word in _marks(label)[1])


def is_plainly_dropped(label: str) -> bool:
    """``is_dropped`` by tag, role or a whole word of class or id, not by a part of a word."""
    tag, _, roles = _marks(label)
    named = is_named(label) or is_comment(label) or is_inline_advert(label)
    return named or tag in _DROPPED_TAGS or any(r in _DROPPED_ROLES for r in roles)


def landmark(label: str) -> int:
    """How clearly an element is the article: 3, 2, 1, or 0 for not at all."""
    tag, words, roles = _marks(label)
    if tag == "article" or "articlebody" in words:
        return 3
    if tag == "main" or "main" in roles:
        return 2
    return int(any(w in _MAIN_WORDS for w in words))


def parse(page: str) -> tuple[Node, list[tuple[int, str]]]:
    """The skeleton of a page, numbered in page order, and its blocks (node, text).

    Character references are decoded, white space in a block becomes one blank, and
    blocks without text are left out.  Tags that are not closed, a page that breaks off
    and tags that close nothing are taken as browsers do, roughly.
    """
    root = Node("")
    stack: list[tuple[str, Node]] = [("", root)]
    found: list[tuple[Node, str]] = []
    pieces: list[str] = []

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                found.append((stack[-1][1], text))
            pieces.clear()

    def close(tags: set[str], within: set[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in tags:
                flush()
                del stack[k:]
                return
            if stack[k][0] in within:
                return

    at = 0
    while True:
        markup = _MARKUP.search(page, at)
        if markup is None:
            pieces.append(page[at:])
            break
        pieces.append(page[at : markup.start()])
        at = markup.end()
        if markup["tag"] is None:
            continue
        tag = markup["tag"].lower()
        if markup["end"]:
            if tag == "br":
                pieces.append(" ")
            elif tag in _BLOCK or any(name == tag for name, _ in stack):
                close({tag}, set())
            continue
        if tag in _RAW:
            ending = re.compile(f"</{tag}", re.IGNORECASE).search(page, at)
            at = len(page) if ending is None else ending.end()
            at = len(page) if ending is None else page.find(">", at) + 1 or len(page)
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                pieces.append(" ")
            continue
        label = _label(tag, markup["attributes"]) if tag in _BLOCK or markup["attributes"] else tag
        if tag not in _BLOCK and not (markup["attributes"] and is_inline_advert(label)):
            continue
        flush()
        if tag in _CLOSES:
            close(*_CLOSES[tag])
        if tag in _BLOCK:
            close({"p"}, {"article", "section", "div", "td", "th", "li", "blockquote", "body", "button", "form", "aside"})
        if not markup["attributes"].endswith("/") or tag in _BLOCK:
            stack.append((tag, stack[-1][1].enter(label)))
    flush()
    order(root)
    return root, [(node.number, text) for node, text in found]


def order(root: Node) -> list[Node]:
    """All nodes in page order, numbered."""
    out, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        node.number = len(out)
        out.append(node)
        waiting.extend(reversed(node.children))
    return out


def write(root: Node) -> str:
    """A skeleton as text: a label, and its children in parentheses."""
    out: list[str] = []
    waiting: list = [root]
    while waiting:
        node = waiting.pop()
        if isinstance(node, str):
            out.append(node)
            continue
        out.append(node.label + "(")
        waiting.append(")")
        waiting.extend(reversed(node.children))
    return "".join(out)


def read(text: str) -> Node:
    top = Node("")
    stack = [top]
    for label, bracket in re.findall(r"([^()]*)([()])", text):
        if bracket == "(":
            node = Node(label)
            stack[-1].children.append(node)
            stack.append(node)
        else:
            stack.pop()
    root = top.children[0] if top.children else top
    order(root)
    return root


def _size(a: Node, b: Node, known: dict) -> int:
    """Simple tree matching: the most nodes of two trees that match, order and parents kept."""
    if a.label != b.label:
        return 0
    # From the bottom up: a pair waits until all pairs of its children are known.
    waiting = [(a, b)]
    while (a.number, b.number) not in known:
        x, y = waiting[-1]
        below = [(c, d) for c in x.children for d in y.children if c.label == d.label and (c.number, d.number) not in known]
        if below:
            waiting.extend(below)
        else:
            known[x.number, y.number] = _table(x, y, known)[-1][-1] + 1
            waiting.pop()
    return known[a.number, b.number]


def _table(a: Node, b: Node, known: dict) -> list[list[int]]:
    table = [[0] * (len(b.children) + 1)]
    for x in a.children:
        above, row = table[-1], [0]
        for k, y in enumerate(b.children):
            row.append(max(above[k + 1], row[k], above[k] + _size(x, y, known)))
        table.append(row)
    return table


def matches(a: Node, b: Node, known: dict | None = None) -> list[tuple[Node, Node]]:
    """The pairs of a largest matching of two numbered trees with the same root label."""
    known = {} if known is None else known
    out, waiting = [], [(a, b)]
    while waiting:
        x, y = waiting.pop()
        out.append((x, y))
        table = _table(x, y, known)
        i, j = len(x.children), len(y.children)
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                waiting.append((x.children[i], y.children[j]))
    return out


def merge(template: Node, page: Node) -> Node:
    """The template with what the page has besides, each new node behind its last matched sibling."""
    twin = {id(y): x for x, y in matches(template, page)}
    waiting = [page]
    while waiting:
        y = waiting.pop()
        x = twin[id(y)]
        at = 0
        for child in y.children:
            if id(child) in twin:
                at = next(k for k, c in enumerate(x.children) if c is twin[id(child)]) + 1
                waiting.append(child)
            else:
                x.children.insert(at, child)
                at += 1
    order(template)
    return template


def kept(skeleton: Node, constant: set[int], filled: set[int] | None = None) -> list[bool]:
    """Per node in page order, whether its blocks belong to the article.

    ``constant`` are the nodes whose text is the same all over the host; they go wherever
    they are.  ``filled`` are the nodes that have text on some page, or all.  Elements that are no article by tag, class or role go, unless the article is
    inside them.  Of what is left, only what the page marks as article counts, if it marks any.
    """
    nodes = order(skeleton)
    parent = [-1] * len(nodes)
    for node in nodes:
        for child in node.children:
            parent[child.number] = node.number
    rank = [landmark(node.label) for node in nodes]
    dropped = [is_dropped(node.label) for node in nodes]
    # What is marked inside a comment, or as one, marks no article.
    comment = [is_comment(node.label) for node in nodes]
    for k in range(1, len(nodes)):
        comment[k] = comment[k] or comment[parent[k]]
        if comment[k]:
            rank[k], dropped[k] = 0, True
    # In what is marked a part of a word is not enough to be no article.
    marked = [False] * len(nodes)
    for k in range(1, len(nodes)):
        up = parent[k]
        marked[k] = marked[up] or (rank[up] > 0 and not dropped[up])
        if marked[k] and rank[k] == 0 and not comment[k]:
            dropped[k] = is_plainly_dropped(nodes[k].label)
    # The highest mark above each node, whether something above is dropped, and the highest
    # mark of the page that no dropped element is or holds.
    above, hidden, plain = [0] * len(nodes), [False] * len(nodes), 0
    for k in range(1, len(nodes)):
        up = parent[k]
        above[k], hidden[k] = max(above[up], rank[up]), hidden[up] or dropped[up]
    for k, found in enumerate(rank):
        if not (dropped[k] or hidden[k]):
            plain = max(plain, found)
    # An article that is marked as something else, too, counts only if it is in no article and there
    # is no plainer one; a comment that says so in a whole word counts in nothing that is marked.
    for k, found in enumerate(rank):
        if dropped[k] and (found == 1 or found > max(plain, above[k]) and not (above[k] and is_named(nodes[k].label))):
            dropped[k] = False
    for number, found in enumerate(rank):
        if found >= 2 and found > plain and found > above[number] and not dropped[number]:
            up = parent[number]
            while up >= 0 and rank[up] < 2:
                dropped[up] = dropped[up] and _marks(nodes[up].label)[0] in ("aside", "footer", "nav", "head")
                up = parent[up]
    gone, inside = [False] * len(nodes), [0] * len(nodes)
    for node in nodes:
        k, up = node.number, parent[node.number]
        inside[k] = max(rank[k], inside[up] if up >= 0 else 0)
        # The header of an article is part of it.
        heading = up >= 0 and inside[up] and _marks(node.label)[0] == "header"
        gone[k] = (up >= 0 and gone[up]) or (dropped[k] and not heading)
    varying = [k for k in range(len(nodes)) if not gone[k] and k not in constant]
    best = max((inside[k] for k in varying if filled is None or k in filled), default=0)
    out = [False] * len(nodes)
    for k in varying:
        out[k] = inside[k] >= best
    return out
