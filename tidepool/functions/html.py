"""A small scoped-selector walker over HTML text (per-row helper).

Used inside ``mapInPandas`` tasks by ``operators.web``: Spark partitions the
pages, each task parses its rows with Python's ``html.parser`` (no third
party parser is available). Supported selectors: ``tag``, ``#id``,
``.class``, ``tag.class``, ``tag[attr]``, ``[attr]`` and one adjacent
sibling step ``A + B``. Unclosed tags, void elements and ``</p>`` inside
``<script>`` strings are tolerated.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

# Fixed value: HTML void elements (never have children or end tags).
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose boundary separates words in an element's text.
BREAK_TAGS = frozenset(
    "address article aside blockquote br dd div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split())


@dataclass
class Node:
    tag: str
    attrs: dict
    parent: "Node | None" = None
    children: list = field(default_factory=list)  # Node or str

    def elements(self):
        return [c for c in self.children if isinstance(c, Node)]

    def iter_descendants(self):
        stack = list(reversed(self.elements()))
        while stack:
            n = stack.pop()
            yield n
            stack.extend(reversed(n.elements()))

    def text(self) -> str:
        parts: list[str] = []
        stack = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                parts.append(n)
            elif n.tag not in ("script", "style"):
                if n.tag in BREAK_TAGS:
                    parts.append(" ")
                stack.extend(reversed(n.children))
        return " ".join("".join(parts).split())


# Fixed values of the HTML tree-building rules used for implied end tags:
# elements whose start closes an open <p>, elements that close an open
# element of the same group, and the scope boundaries those searches stop at.
CLOSES_P = frozenset(
    "address article aside blockquote details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table "
    "ul li dd dt".split())
SAME_GROUP = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"),
              "th": ("td", "th"), "tr": ("tr",), "option": ("option",)}
SCOPE_STOP = frozenset("applet caption html table td th marquee object template button".split())
LIST_STOP = SCOPE_STOP | {"ol", "ul"}
TABLE_STOP = frozenset({"table", "template", "html"})


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.cur = self.root

    def _close_open(self, names, stop) -> None:
        """Close the nearest open element named in ``names`` unless a scope
        boundary in ``stop`` comes first (implied end tag)."""
        n = self.cur
        while n is not None and n.parent is not None:
            if n.tag in names:
                self.cur = n.parent
                return
            if n.tag in stop:
                return
            n = n.parent

    def handle_starttag(self, tag, attrs):
        if tag in SAME_GROUP:
            if tag == "li":
                stop = LIST_STOP
            elif tag in ("td", "th", "tr"):
                stop = TABLE_STOP
            else:
                stop = SCOPE_STOP
            self._close_open(SAME_GROUP[tag], stop)
        if tag in CLOSES_P:
            self._close_open(("p",), SCOPE_STOP)
        node = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur)
        self.cur.children.append(node)
        if tag not in VOID_TAGS:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        node = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur)
        self.cur.children.append(node)

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def handle_data(self, data):
        self.cur.children.append(data)


def parse(html: str | None) -> Node:
    b = _TreeBuilder()
    if html:
        b.feed(html)
        b.close()
    return b.root


_SIMPLE = re.compile(r"^(?P<tag>[a-zA-Z][\w-]*)?(?P<rest>(?:[#.][\w-]+|\[[\w-]+\])*)$")


def _matcher(simple: str):
    m = _SIMPLE.match(simple.strip())
    if not m:
        raise ValueError(f"unsupported selector {simple!r}")
    tag = (m.group("tag") or "").lower()
    ids = re.findall(r"#([\w-]+)", m.group("rest"))
    classes = re.findall(r"\.([\w-]+)", m.group("rest"))
    attrs = re.findall(r"\[([\w-]+)\]", m.group("rest"))

    def ok(n: Node) -> bool:
        if tag and n.tag != tag:
            return False
        if ids and n.attrs.get("id") not in ids:
            return False
        if classes:
            have = set(n.attrs.get("class", "").split())
            if not all(c in have for c in classes):
                return False
        return all(a in n.attrs for a in attrs)
    return ok


def iter_select(scope: Node, selector: str):
    """Descendants of ``scope`` matching ``selector``, lazily, in document order."""
    if "+" in selector:
        left, right = (x.strip() for x in selector.split("+", 1))
        lm, rm = _matcher(left), _matcher(right)
        for n in scope.iter_descendants():
            if lm(n) and n.parent is not None:
                sibs = n.parent.elements()
                i = next(j for j, x in enumerate(sibs) if x is n)
                if i + 1 < len(sibs) and rm(sibs[i + 1]):
                    yield sibs[i + 1]
        return
    m = _matcher(selector)
    for n in scope.iter_descendants():
        if m(n):
            yield n


def select_all(scope: Node, selector: str) -> list[Node]:
    """Descendants of ``scope`` matching ``selector``, in document order."""
    return list(iter_select(scope, selector))


def select_first(scope: Node, selector: str) -> Node | None:
    """First match; the walk stops there."""
    return next(iter_select(scope, selector), None)


@dataclass(frozen=True)
class Rule:
    """Extraction rule: a chain of scope steps, then the item selector.

    ``scope`` is a tuple of steps; each step is a tuple of alternative
    selectors, the first that exists wins; a missing step gives no items.
    ``fallback`` is a second chain used only when no alternative of the
    first step exists. With ``items_from_root`` the scope must exist but
    items are selected from the whole document.
    """

    scope: tuple = ()
    items: str = "a"
    fallback: tuple | None = None
    items_from_root: bool = False


def _resolve_chain(root: Node, chain: tuple) -> Node | None:
    cur = root
    for step in chain:
        nxt = None
        for alt in step:
            nxt = select_first(cur, alt)
            if nxt is not None:
                break
        if nxt is None:
            return None
        cur = nxt
    return cur


def extract(html: str | None, rule: Rule) -> list[dict]:
    """Items of ``rule`` as dicts with ``text`` and every attribute."""
    root = parse(html)
    scope = None
    if rule.scope and rule.fallback is not None:
        first_step = rule.scope[0]
        if not any(select_first(root, alt) is not None for alt in first_step):
            scope = _resolve_chain(root, rule.fallback)
        else:
            scope = _resolve_chain(root, rule.scope)
    else:
        scope = _resolve_chain(root, rule.scope)
    if scope is None:
        return []
    base = root if rule.items_from_root else scope
    out = []
    for n in select_all(base, rule.items):
        d = dict(n.attrs)
        d["text"] = n.text()
        out.append(d)
    return out


_TOKEN = re.compile(r"^[A-Za-z0-9_-]+$")


def _selector_token(selector: str) -> tuple[str, str] | None:
    """``("attr", text)`` or ``("tag", name)`` that must appear in any page
    where ``selector`` matches; None when no safe token exists."""
    simple = selector.split("+", 1)[0].strip()
    m = _SIMPLE.match(simple)
    if not m:
        return None
    ids = re.findall(r"#([\w-]+)", m.group("rest"))
    classes = re.findall(r"\.([\w-]+)", m.group("rest"))
    tok = (ids or classes or [None])[0]
    if tok is not None:
        return ("attr", tok) if _TOKEN.match(tok) else None
    tag = (m.group("tag") or "").lower()
    return ("tag", tag) if tag and _TOKEN.match(tag) else None


def required_tokens(rule: Rule) -> list[tuple[str, str]] | None:
    """Tokens of which at least one must be in a page for ``rule`` to yield
    items (the first scope step's alternatives, and the fallback's); None
    when the rule has no scope or a selector gives no safe token."""
    if not rule.scope:
        return None
    steps = [rule.scope[0]] + ([rule.fallback[0]] if rule.fallback else [])
    out = []
    for step in steps:
        for alt in step:
            t = _selector_token(alt)
            if t is None:
                return None
            out.append(t)
    return out
