"""Per-page helper: a forgiving element tree and the selector subset.

Runs inside Arrow batches on the executors; `operators.nodes` is the Spark side.
Selectors are descendant chains of `tag`, `.class`, `#id`, `:last-child` and
`:nth-child(n)`, ended by nothing (outer HTML), `::text`, ` ::text` or
`::attr(x)`, and XPath of the form `//*[@class='c']//span[n]/text()`.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass
from html import unescape
from html.entities import html5
from operator import attrgetter

# Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Block elements that end an open paragraph.
BLOCK = frozenset(("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main "
                   "nav ol p pre section table ul").split())
_TABLE = frozenset(["table"])
# A start tag ends an open element of the first set unless one of the second set lies between.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), _TABLE),
    "tbody": (frozenset(["thead", "tbody", "tfoot"]), _TABLE),
    "tfoot": (frozenset(["thead", "tbody", "tfoot"]), _TABLE),
    "option": (frozenset(["option"]), frozenset(["select"])),
    **{tag: (frozenset(["p"]), frozenset(["td", "th", "table", "button"])) for tag in BLOCK},
}


# Elements whose content is plain text up to their end tag.
RAW_TEXT = {"script": False, "style": False, "title": True, "textarea": True}

_ATTRIBUTE = r"""[^\s/>][^\s/=>]*+(?:\s*+=\s*+(?:'[^']*+'|"[^"]*+"|(?!['"])[^>\s]*+))?"""
_TOKEN = re.compile(
    rf"[^<]++|<([A-Za-z][^\s/>]*+)((?:[\s/]*+{_ATTRIBUTE})*+[\s/]*+)>|</([A-Za-z][^\s/>]*+)[^>]*+>"
    r"|<([A-Za-z][^\s/>]*+)([^>]*+)>|<!--(?:.*?-->|.*)|<[!?/][^A-Za-z>][^>]*>?|<", re.S)
_NAME_VALUE = re.compile(r"""([^\s/>][^\s/=>]*)(?:\s*=\s*('[^']*'|"[^"]*"|[^>\s]*))?""")

_REFERENCE = re.compile(r"&(?:#(?:[0-9]+|[xX][0-9a-fA-F]+);?|([A-Za-z][A-Za-z0-9]*)(;?)(?=(=?)))")
_INDEX = attrgetter("index")


def _decoded(m):
    name, end, equals = m[1], m[2], m[3]
    known = name is None or (name + ";" in html5 if end else name in html5 and not equals)
    return unescape(m[0]) if known else m[0]


def attribute_value(text):
    """References decoded as attributes have it: a name without its semicolon stays if `=` or a letter follows."""
    return _REFERENCE.sub(_decoded, text) if "&" in text else text


class Node:
    __slots__ = ("tag", "raw", "parent", "kids", "start", "end", "index", "stop", "_places", "_attrs", "_classes")

    def __init__(self, tag, raw, parent, start, index):
        self.tag, self.raw, self.parent, self.start, self.index = tag, raw, parent, start, index
        self.kids = []
        self._places = self._attrs = self._classes = None

    def place(self):
        """Position among the sibling elements, among those of the same tag, and whether it is the last."""
        places = self.parent._places
        if places is None:
            places = self.parent._places = {}
            same, kids = {}, [k for k in self.parent.kids if type(k) is Node]
            for n, kid in enumerate(kids, 1):
                same[kid.tag] = same.get(kid.tag, 0) + 1
                places[kid.index] = (n, same[kid.tag], n == len(kids))
        return places[self.index]

    @property
    def attrs(self):
        if self._attrs is None:
            self._attrs = {}
            for name, value in _NAME_VALUE.findall(self.raw) if self.raw else ():
                if value[:1] in ("'", '"') and value[-1:] == value[:1]:
                    value = value[1:-1]
                self._attrs.setdefault(name.lower(), attribute_value(value))
        return self._attrs

    @property
    def classes(self):
        if self._classes is None:
            self._classes = self.attrs.get("class", "").split()
        return self._classes

    def texts(self, deep):
        """Texts directly in this element, or all below it, in document order."""
        if not deep:
            yield from [k for k in self.kids if type(k) is Text]
            return
        stack = self.kids[::-1]
        while stack:
            item = stack.pop()
            if type(item) is Text:
                yield item
            elif item is not None:
                stack.extend(reversed(item.kids))


class Text:
    __slots__ = ("source", "literal")

    def __init__(self, source, literal=False):
        self.source, self.literal = source, literal

    @property
    def value(self):
        return self.source if self.literal or "&" not in self.source else unescape(self.source)


class Tree:
    """Elements of one page in document order; a subtree is a slice of `nodes`."""

    def __init__(self, source):
        self.source, self.nodes, self.by_tag, self._named = source, [], {}, None
        self.open = {}  # open elements by tag, the innermost last
        self.root = self.at = Node("", "", None, 0, 0)
        self.nodes.append(self.root)
        match, place, size = _TOKEN.match, 0, len(source)
        while place < size:
            m = match(source, place)
            start, place, group = place, m.end(), m.lastindex
            if group is None:
                if source[start] != "<" or place == start + 1:
                    self._text(source[start:place])
                else:
                    self.at.kids.append(None)  # two texts around a comment stay two texts
            elif group == 3:
                self._close(m[3].lower(), start, place)
            else:
                place = self._open(m[group - 1].lower(), m[group], start, place)
        self._leave(self.root, size)

    @property
    def named(self):
        """Elements by `#id` and `.class`."""
        if self._named is None:
            self._named = {}
            for node in self.nodes:
                if node.raw:
                    attrs = node.attrs
                    if "id" in attrs:
                        self._named.setdefault("#" + attrs["id"], []).append(node)
                    if "class" in attrs:
                        for name in set(node.classes):
                            self._named.setdefault("." + name, []).append(node)
        return self._named

    def _text(self, source):
        kids = self.at.kids
        if kids and type(kids[-1]) is Text:
            kids[-1].source += source
        else:
            kids.append(Text(source))

    def _leave(self, node, end):
        """Close everything up to and including `node`."""
        inner, stop = self.at, len(self.nodes)
        while inner is not node:
            self.open[inner.tag].pop()
            inner.end, inner.stop, inner = end, stop, inner.parent
        if node is not self.root:
            self.open[node.tag].pop()
        node.end, node.stop = end, stop
        self.at = node.parent

    def _innermost(self, names):
        found = None
        for name in names:
            nodes = self.open.get(name)
            if nodes and (found is None or nodes[-1].index > found.index):
                found = nodes[-1]
        return found

    def _find(self, names, fence=frozenset()):
        """The innermost open element of `names` if no open one of `fence` lies inside it."""
        node = self._innermost(names)
        if node is None:
            return None
        wall = self._innermost(fence)
        return node if wall is None or wall.index < node.index else None

    def _open(self, tag, raw, start, place):
        if tag in ENDS:
            old = self._find(*ENDS[tag])
            if old is not None:
                self._leave(old, start)
        at, nodes = self.at, self.nodes
        node = Node(tag, raw, at, start, len(nodes))
        at.kids.append(node)
        nodes.append(node)
        if tag in self.by_tag:
            self.by_tag[tag].append(node)
        else:
            self.by_tag[tag] = [node]
        if tag in VOID:
            node.end, node.stop = place, len(nodes)
            return place
        self.at = node
        if tag in self.open:
            self.open[tag].append(node)
        else:
            self.open[tag] = [node]
        if tag in RAW_TEXT:
            close = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(self.source, place)
            end = close.start() if close else len(self.source)
            if end > place:
                node.kids.append(Text(self.source[place:end], literal=not RAW_TEXT[tag]))
            return end
        return place

    def _close(self, tag, start, end):
        node = self.at
        if node.tag == tag:  # the usual case: nothing inside is left open
            self.open[tag].pop()
            node.end, node.stop, self.at = end, len(self.nodes), node.parent
            return
        node = self._find((tag,))
        if node is not None:
            self._leave(node, start)
            node.end = end


@dataclass(frozen=True)
class Step:
    """Conditions on one element of a descendant chain."""

    tag: str = ""
    ids: tuple = ()
    classes: tuple = ()
    equals: tuple = ()
    nth: int = 0
    nth_type: int = 0
    last: bool = False

    def accepts(self, node):
        if self.tag and node.tag != self.tag:
            return False
        for i in self.ids:
            if node.attrs.get("id") != i:
                return False
        for c in self.classes:
            if c not in node.classes:
                return False
        for k, v in self.equals:
            if node.attrs.get(k) != v:
                return False
        if self.nth or self.nth_type or self.last:
            nth, nth_type, last = node.place()
            return (not self.nth or self.nth == nth) and (not self.nth_type or self.nth_type == nth_type) and (
                not self.last or last)
        return True


@dataclass(frozen=True)
class Selector:
    steps: tuple
    take: str  # "html", "text", "deep" or "@name"

    def tokens(self):
        """Attribute values a page must contain for this selector to match."""
        return sorted({v for s in self.steps for v in (*s.ids, *s.classes, *(v for _, v in s.equals))})

    def _matches(self, node, scope):
        if not self.steps[-1].accepts(node):
            return False
        for step in self.steps[-2::-1]:
            while True:
                if node is scope:
                    return False
                node = node.parent
                if node.parent is None:
                    return False
                if step.accepts(node):
                    break
        return True

    def nodes(self, tree, scope):
        """Matches in document order among `scope` and everything below it."""
        if not self.steps:
            return [scope]
        last = self.steps[-1]
        if last.ids:
            found = tree.named.get("#" + last.ids[0], ())
        elif last.classes:
            found = tree.named.get("." + last.classes[0], ())
        elif last.tag:
            found = tree.by_tag.get(last.tag, ())
        else:
            found = tree.nodes[1:]
        if scope is not tree.root:
            found = found[bisect_left(found, scope.index, key=_INDEX):bisect_left(found, scope.stop, key=_INDEX)]
        return [n for n in found if self._matches(n, scope)]

    def values(self, tree, scope=None):
        found = self.nodes(tree, scope or tree.root)
        if self.take == "html":
            return [tree.source[n.start:n.end] for n in found]
        if self.take[0] == "@":
            return [n.attrs[self.take[1:]] for n in found if self.take[1:] in n.attrs]
        deep = self.take == "deep"
        if deep and len(found) > 1:  # elements inside one another share their texts
            return [t.value for t in {id(t): t for n in found for t in n.texts(True)}.values()]
        return [t.value for n in found for t in n.texts(deep)]


_CSS_PART = re.compile(r"([A-Za-z][\w-]*|\*)|#([\w-]+)|\.([\w-]+)|:nth-child\((\d+)\)|(:last-child)")
_XPATH_STEP = re.compile(r"//([A-Za-z][\w-]*|\*)(?:\[@([\w-]+)='([^']*)'\]|\[(\d+)\])?")


def compile_selector(text: str) -> Selector:
    return _compile_xpath(text) if text.startswith("//") else _compile_css(text)


def _compile_css(text):
    body, mark, ending = text.partition("::")
    take = "html"
    if mark and ending == "text":
        take = "deep" if body.endswith(" ") else "text"
    elif mark:
        take = "@" + re.fullmatch(r"attr\(([\w-]+)\)", ending)[1]
    steps = []
    for compound in body.split():
        parts = list(_CSS_PART.finditer(compound))
        if "".join(m[0] for m in parts) != compound:
            raise ValueError(f"unsupported selector: {text!r}")
        tag = next((m[1] for m in parts if m[1]), "")
        steps.append(Step(
            tag="" if tag == "*" else tag.lower(),
            ids=tuple(m[2] for m in parts if m[2]),
            classes=tuple(m[3] for m in parts if m[3]),
            nth=next((int(m[4]) for m in parts if m[4]), 0),
            last=any(m[5] for m in parts),
        ))
    return Selector(tuple(steps), take)


def _compile_xpath(text):
    body, take = text, "html"
    if m := re.search(r"/(text\(\)|@([\w-]+))$", text):
        body, take = text[:m.start()], "text" if m[2] is None else "@" + m[2]
    parts = list(_XPATH_STEP.finditer(body))
    if "".join(m[0] for m in parts) != body:
        raise ValueError(f"unsupported selector: {text!r}")
    return Selector(tuple(
        Step(tag="" if m[1] == "*" else m[1].lower(), equals=((m[2], m[3]),) if m[2] else (),
             nth_type=int(m[4] or 0))
        for m in parts), take)
